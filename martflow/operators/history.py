"""Dimensions with history: intervals of equal attributes, and facts joined as of a time.

A key may have a third of all rows, so nothing here orders all rows of a key
in one task. Time is cut into buckets of nearly equal numbers of rows; rows
are ordered within a key and bucket, and what must pass from one bucket to
the next, one row per key and bucket, is ordered per key. There are at most
``MAX_BUCKETS`` of these.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.operators.buckets import Buckets, even, even_buckets
from martflow.session import materialize

# Rows a bucket of time should hold, and most buckets.
BUCKET_ROWS = 2_000_000
MAX_BUCKETS = 1000


def time_buckets(rows: DataFrame, at: str, buckets: int | None = None) -> Buckets:
    """A function from a moment to the number of its bucket, growing with time.

    ``buckets`` is by default as many as ``BUCKET_ROWS`` asks for. Moments
    beyond those of ``rows`` fall into the outermost buckets. Null has no bucket.
    """
    if buckets is None:
        n = rows.agg(F.count(at)).first()[0]
        buckets = min(MAX_BUCKETS, -(-n // BUCKET_ROWS))
    return even_buckets(rows, {at: buckets})[at]


def versions(
    rows: DataFrame,
    keys: Sequence[str],
    at: str,
    attributes: Sequence[str],
    order_by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """One row per key and stretch of time in which its attributes stay the same.

    Columns: ``keys``, ``attributes``, ``valid_from``, ``valid_to`` (the start
    of the next stretch, null for the last) and ``is_current``. Of rows of one
    key and moment the last counts, in the order of ``order_by`` and then of
    the attributes. Null attributes are values like others. Rows with a null
    key or moment have no place in a history and are left out.
    """
    placed = rows.where(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in (*keys, at)]))
    bucket = time_buckets(placed, at, buckets)
    last = F.max(F.struct(*[f"_o.`{c}`" for c in order_by], "_is"))
    rows_of = placed.select(
        *keys, F.col(at).alias("_at"), bucket(F.col(at)).alias("_bucket"),
        *([F.struct(*order_by).alias("_o")] if order_by else []), F.struct(*attributes).alias("_is"),
    )
    if even(bucket):
        # No bucket is large, so rows go at once to where they are ordered: one shuffle, one sort. Where many
        # rows share a moment, a bucket can be; then each task first combines those of its input.
        rows_of = rows_of.repartition(*keys, "_bucket")
    seen = rows_of.groupBy(*keys, "_bucket", "_at").agg(last.getField("_is").alias("_is"))

    # Within a bucket: the first row, and every row unlike the one before it.
    here = Window.partitionBy(*keys, "_bucket").orderBy("_at")
    before = F.lag(F.struct("_is")).over(here)
    changes = seen.withColumn("_before", before)
    changes = changes.where(F.col("_before").isNull() | ~F.col("_before._is").eqNullSafe(F.col("_is")))
    changes = materialize(changes.withColumn("_first", F.col("_before").isNull()).drop("_before"), "changes")

    # Between buckets: whether the first row is a change too, and when the next bucket has one.
    by_time = F.struct("_at", "_is")
    summary = changes.groupBy(*keys, "_bucket").agg(
        F.min(by_time).alias("_start"), F.max(by_time).alias("_last"), F.min(F.when(~F.col("_first"), F.col("_at"))).alias("_second")
    )
    forth = Window.partitionBy(*keys).orderBy("_bucket")
    # Growing frames in both directions: a shrinking one would be summed anew for each row.
    back = Window.partitionBy(*keys).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.lag("_last").over(forth)
    changed = summary.withColumn("_new", earlier.isNull() | ~earlier["_is"].eqNullSafe(F.col("_start._is")))
    starts = F.when(F.col("_new"), F.col("_start._at")).otherwise(F.col("_second"))
    linked = changed.withColumn("_starts", starts).withColumn("_next", F.min("_starts").over(back))
    linked = linked.select(*keys, "_bucket", "_new", "_next")

    points = changes.join(linked, [*keys, "_bucket"]).where(~F.col("_first") | F.col("_new"))
    until = F.coalesce(F.lead("_at").over(here), F.col("_next"))
    return points.withColumn("_to", until).select(
        *keys, *[F.col(f"_is.`{c}`").alias(c) for c in attributes],
        F.col("_at").alias("valid_from"), F.col("_to").alias("valid_to"), F.col("_to").isNull().alias("is_current"),
    )


def as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    since: str = "valid_from",
    buckets: int | None = None,
) -> DataFrame:
    """Facts with ``columns`` of the latest row of ``history`` that starts at or before them.

    Every fact stays once; one without a key or moment, or before its key's
    first row, gets nulls. Rows of the history that start at one moment must
    not share a key. Neither side is repeated to meet the other: facts and
    versions are sorted together by key and bucket of time, and the version
    that is valid as a bucket begins is handed on to it.
    """
    bucket = time_buckets(facts, at, buckets)
    kept = [c for c in facts.columns]
    fact = F.struct(*[F.col(f"`{c}`") for c in kept])
    version = F.struct(*[F.col(f"`{c}`") for c in columns])
    key = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    whole = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in (*keys, at)])
    timed = facts.select(
        *key, F.col(f"`{at}`").alias("_at"), F.when(whole, bucket(F.col(f"`{at}`"))).alias("_bucket"),
        F.lit(2).alias("_order"), fact.alias("_fact"),
    )
    known = history.where(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in (*keys, since)])).select(
        *key, F.col(f"`{since}`").alias("_at"), bucket(F.col(f"`{since}`")).alias("_bucket"),
        F.lit(1).alias("_order"), version.alias("_version"),
    )

    # The version that each bucket of a key ends with, handed on to the buckets with facts.
    ends = known.groupBy(*names, "_bucket").agg(F.max_by("_version", "_at").alias("_last"))
    needs = timed.where("_bucket IS NOT NULL").select(*names, "_bucket").distinct()
    both = ends.unionByName(needs.withColumn("_needs", F.lit(True)), allowMissingColumns=True)
    per_bucket = both.groupBy(*names, "_bucket").agg(F.first("_last", True).alias("_last"), F.max("_needs").alias("_needs"))
    earlier = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = per_bucket.withColumn("_version", F.last("_last", True).over(earlier)).where("_needs AND _version IS NOT NULL")
    handed = handed.select(*names, "_bucket", F.lit(0).alias("_order"), "_version")

    rows = timed.unionByName(known, allowMissingColumns=True).unionByName(handed, allowMissingColumns=True)
    so_far = Window.partitionBy(*names, "_bucket").orderBy((F.col("_order") > 0), "_at", "_order")
    valid = F.last("_version", True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_valid", F.when(F.col("_bucket").isNotNull(), valid)).where("_order = 2")
    return found.select("_fact.*", *[F.col(f"_valid.`{c}`").alias(c) for c in columns])
