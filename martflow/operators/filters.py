"""Row filters. Plain predicates, so that scans can push them down."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(*conditions: Column) -> Column:
    return reduce(and_, conditions)


def of_kind(df: DataFrame, column: str, kind: Any) -> DataFrame:
    return df.where(F.col(column) == F.lit(kind))


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.where(all_of(*[F.col(c).isNotNull() for c in columns]))


def not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither null nor empty."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def after(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows dated strictly after ``day`` (``yyyy-MM-dd``)."""
    return df.where(F.col(column) > F.lit(day).cast("date"))


def lookup(df: DataFrame, keys: Mapping[str, Any], columns: list[str] | None = None) -> DataFrame:
    """Rows whose key columns have exactly these values."""
    found = df.where(all_of(*[F.col(c) == F.lit(v) for c, v in keys.items()]))
    return found.select(*columns) if columns else found
