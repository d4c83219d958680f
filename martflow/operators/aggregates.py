"""Grouping, distinct rows, pivots and top-k reports.

Every aggregate here is combined before its shuffle, so a frequent group
sends one partial row per task rather than all its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def time_interval(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_time"), F.max(column).alias("last_time"))


def group_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    """Non-null occurrences of each value, so the null group shows 0."""
    return df.groupBy(column).agg(F.count(column).alias(name))


def top_groups(df: DataFrame, column: str, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return group_counts(df, column, name).orderBy(F.desc(name), F.asc_nulls_last(column)).limit(k)


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean per group of a measure that may be text."""
    return df.groupBy(*keys).agg(F.avg(F.col(value).try_cast("double")).alias(name))


def mixed_measures(
    df: DataFrame, keys: Sequence[str], means: Mapping[str, str], sums: Mapping[str, str]
) -> DataFrame:
    """Means of some columns and sums of others, renamed (column → output)."""
    return df.groupBy(*keys).agg(
        *[F.avg(F.col(f"`{c}`").try_cast("double")).alias(out) for c, out in means.items()],
        *[F.sum(F.col(f"`{c}`").try_cast("double")).alias(out) for c, out in sums.items()],
    )


def first_row(values: Sequence[str], order_by: Sequence[str]) -> Column:
    """The values of the first row in a stated order, as one struct.

    Rows equal in that order are told apart by the values themselves.
    """
    return F.min(F.struct(*order_by, *[v for v in values if v not in order_by]))


def first_per_group(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Values of each group's first row; all of them from the same row."""
    picked = df.groupBy(*keys).agg(first_row(values, order_by).alias("_row"))
    return picked.select(*keys, *[f"_row.{v}" for v in values])


def mean_and_first(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    name: str,
    described: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """The mean of a measure with descriptive columns of each group's first row."""
    grouped = df.groupBy(*keys).agg(
        F.avg(F.col(measure).try_cast("double")).alias(name),
        first_row(described, order_by).alias("_row"),
    )
    return grouped.select(*keys, name, *[f"_row.{v}" for v in described])


def pivot_first(
    df: DataFrame, keys: Sequence[str], category: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """Categories as columns (category → output), each with its smallest value.

    One aggregation over stated categories: no job to discover them and a
    schema that does not depend on the data.
    """
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[
            F.min(F.when(F.col(f"`{category}`") == c, F.col(f"`{value}`"))).alias(out)
            for c, out in names.items()
        ]
    )


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over all (chosen) columns."""
    return (df.select(*columns) if columns else df).distinct()


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool = True
) -> DataFrame:
    """The last (or first) row of each key in a stated order.

    Rows equal in that order are told apart by their remaining columns, so the
    answer never depends on how the input is partitioned.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ordered = [c for c in order_by if c not in keys]
    if not (ordered or rest):
        return df.distinct()
    pick = F.max if latest else F.min
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*ordered, *rest)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
