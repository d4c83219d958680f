"""Putting frames together, previews and ordered reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.keys import dense_ids


def distinct_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Every non-null value found in any of the columns, once, in one scan."""
    values = df.select(F.explode(F.array(*columns)).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()


def stack_frames(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def in_order(df: DataFrame, condition: Column, order_by: Sequence[str], position: str) -> DataFrame:
    """Rows of one partition key in clustering order, with their position.

    The position keeps the order when the rows travel on, and is found by a
    range shuffle, so the key may hold any number of rows.
    """
    return dense_ids(df.where(condition), position, order_by)
