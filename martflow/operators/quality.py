"""Checks that return a report, and a gate that raises on a bad one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.operators.combine import stack_frames
from martflow.session import materialize


class QualityError(ValueError):
    """A data quality check failed."""


def nonempty_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table and whether it passes (has any row)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    return stack_frames(*counts)


def enforce(report: DataFrame) -> DataFrame:
    """Raise if any line of a report (one per table or rule) did not pass.

    Returns the report with its lines settled, so that looking at it does not
    run the checks again.
    """
    lines = report.collect()
    failed = sorted({line["table_name"] for line in lines if not line["passed"]})
    if failed:
        raise QualityError(f"data quality check failed: {', '.join(failed)}")
    return report.sparkSession.createDataFrame(lines, report.schema)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "nulls")


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values per column that are present but do not fit the type they are cast to."""
    counted = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.trim(F.col(c)).try_cast(t).isNull()).alias(c)
            for c, t in types.items()
        ]
    )
    return counted.unpivot([], list(types), "column_name", "rejects")


def column_types(df: DataFrame) -> DataFrame:
    """Name and type of every column."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, type string")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per column."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    moments = numbers.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    per_column = moments.unpivot([], list(columns), "column_name", "m").select("column_name", "m.*")
    quartiles = exact_quantiles(numbers, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return per_column.join(quartiles, "column_name", "left")


def exact_quantiles(numbers: DataFrame, fractions: Mapping[str, float]) -> DataFrame:
    """Interpolated quantiles of every column of doubles, at any size.

    Equal values are counted before the shuffle. The counts are sorted by a
    range shuffle, each range knows how many values lie before it, and only
    the ranges that hold a wanted rank are looked into.
    """
    pairs = numbers.unpivot([], numbers.columns, "column_name", "v")
    counts = (
        pairs.where(F.col("v").isNotNull())
        .groupBy("column_name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange("column_name", "v")
        .withColumn("part", F.spark_partition_id())
    )
    counts = materialize(counts, "value-counts")
    # One row per column and range: small whatever the data's size.
    ranges = counts.groupBy("column_name", "part").agg(F.sum("n").alias("range_n"))
    by_column = Window.partitionBy("column_name")
    earlier = by_column.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "column_name",
        "part",
        F.coalesce(F.sum("range_n").over(earlier), F.lit(0)).alias("before"),
        F.sum("range_n").over(by_column).alias("total"),
        "range_n",
    )
    ranks = {name: F.lit(q) * (F.col("total") - 1) for name, q in fractions.items()}
    wanted = [round_to(rank) for rank in ranks.values() for round_to in (F.floor, F.ceil)]
    holds_one = [(F.col("before") <= r) & (r < F.col("before") + F.col("range_n")) for r in wanted]
    ranges = ranges.where(reduce(or_, holds_one)).drop("range_n")
    upto = Window.partitionBy("column_name", "part").orderBy("v")
    placed = counts.join(F.broadcast(ranges), ["column_name", "part"]).select(
        "column_name",
        "v",
        "total",
        (F.col("before") + F.sum("n").over(upto) - F.col("n")).alias("lo"),
        (F.col("before") + F.sum("n").over(upto) - 1).alias("hi"),
    )

    def value_at(rank):
        # Ranks lo..hi hold this value; exactly one row contains a given rank.
        return F.max(F.when((F.col("lo") <= rank) & (F.col("hi") >= rank), F.col("v")))

    aggregates, outputs = [], [F.col("column_name")]
    for name, rank in ranks.items():
        aggregates += [
            value_at(F.floor(rank)).alias(f"{name}_below"),
            value_at(F.ceil(rank)).alias(f"{name}_above"),
            F.max(rank - F.floor(rank)).alias(f"{name}_part"),
        ]
        below, above = F.col(f"{name}_below"), F.col(f"{name}_above")
        outputs.append((below + (above - below) * F.col(f"{name}_part")).alias(name))
    return placed.groupBy("column_name").agg(*aggregates).select(*outputs)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary key check: repeated keys, rows holding them, rows with a null key."""
    has_null = F.greatest(*[F.col(k).isNull().cast("int") for k in (*keys, keys[0])]) == 1
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = ~has_null & (F.col("n") > 1)
    return per_key.agg(
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("rows_in_repeated_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("rows_with_null_key"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign key check: child keys without a parent, with their row counts.

    Keys are counted before they are matched, so the shuffle carries one row
    per key. A null refers to nothing and is no violation.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("child_rows"))
    return used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def not_null_violations(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Nulls in columns declared to have none, per table and column."""
    return stack_frames(
        *[
            null_counts(df, columns).select(
                F.lit(name).alias("table_name"), "column_name", "nulls", (F.col("nulls") == 0).alias("passed")
            )
            for name, (df, columns) in tables.items()
        ]
    )


def source_target_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows in the source, in the target and missing from it, per table."""
    lines = []
    for name, (source, target) in pairs.items():
        both = stack_frames(
            source.agg(F.count(F.lit(1)).alias("s")).withColumn("t", F.lit(0).cast("bigint")),
            target.agg(F.count(F.lit(1)).alias("t")).withColumn("s", F.lit(0).cast("bigint")),
        )
        lines.append(
            both.agg(F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows")).select(
                F.lit(name).alias("table_name"),
                "source_rows",
                "target_rows",
                (F.col("source_rows") - F.col("target_rows")).alias("difference"),
            )
        )
    return stack_frames(*lines)
