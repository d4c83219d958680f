"""Projections and whole-list column changes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.text import to_int


def select_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns named, under new names (source → output)."""
    return df.select(*[F.col(source).alias(output) for source, output in names.items()])


def rename_and_drop(
    df: DataFrame, renames: Mapping[str, str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Rename and drop columns, leaving all others in place."""
    return df.drop(*drop).withColumnsRenamed(dict(renames or {}))


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Keep columns by position, in the order given."""
    return df.select(*[F.col(f"`{df.columns[i]}`") for i in positions])


def change_columns(
    df: DataFrame, columns: Iterable[str], change: Callable[[Column], Column]
) -> DataFrame:
    """Apply one expression to each named column, in a single projection."""
    return df.withColumns({c: change(F.col(c)) for c in columns})


def cast_to_int(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return change_columns(df, columns, to_int)


def process(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a dataset through callbacks, each seeing the whole dataset."""
    for step in steps:
        df = df.transform(step)
    return df
