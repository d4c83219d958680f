"""Tables kept up to date by a key that does not say where its rows lie.

Rows are put into a fixed number of directories by a hash of the key. An
upsert touches the buckets of its keys alone: the others keep their files.
Of the touched buckets only rows that may have a key of the delivery are
joined to it; the rest goes from the scan to the new files without a shuffle,
so a bucket that grew large is still read and written by as many tasks as its
files have splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.pruning import PRUNE_FROM, estimated_bytes, split_rows
from martflow.session import materialize
from martflow.sinks.writers import Merge, write_parquet
from martflow.sources.readers import read_partitioned

BUCKET = "key_bucket"
LAYOUT = "_layout"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; null keys have one like others."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A new table below ``path``, in ``buckets`` directories by the hash of its keys.

    The number is part of the table and cannot change; as many as one delivery
    should not touch all of. ``path`` must be unused.
    """
    write_parquet(df.withColumn(BUCKET, bucket_of(keys, buckets)), path, [BUCKET], mode="errorifexists")
    layout = df.sparkSession.range(1).select(F.lit(buckets).alias("buckets"), F.array(*map(F.lit, keys)).alias("keys"))
    layout.coalesce(1).write.parquet(f"{path}/{LAYOUT}")


def read_bucketed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_partitioned(spark, path, f"{schema}, {BUCKET} int").drop(BUCKET)


def merge_buckets(
    spark: SparkSession, path: str, schema: str, incoming: DataFrame, merge: Merge, prune_from: int = PRUNE_FROM
) -> None:
    """Merge a delivery into the buckets its keys fall into.

    ``merge(target, incoming)`` is one of the upserts on the table's keys; it
    is given only target rows that may have one of the delivery's keys, which
    changes no result; where the keys of the touched buckets are smaller than
    ``prune_from`` bytes, all their rows. Touched buckets are staged before they are replaced, so
    a merge that fails may be repeated. The numbers of touched buckets, never
    more than the table has, are put into the plan as literals.
    """
    layout = spark.read.parquet(f"{path}/{LAYOUT}").first()
    keys, bucket = list(layout["keys"]), bucket_of(layout["keys"], layout["buckets"])
    delivery = materialize(incoming, "delivery")
    touched = [r[0] for r in delivery.select(bucket).distinct().collect()]
    if not touched:
        return
    current = read_partitioned(spark, path, f"{schema}, {BUCKET} int").where(F.col(BUCKET).isin(touched))
    if estimated_bytes(current.select(*keys)) >= prune_from:
        held, rest = split_rows(current, delivery, keys)
    else:
        held, rest = current, current.limit(0)
    changed = merge(held.drop(BUCKET), delivery).withColumn(BUCKET, bucket)
    # Gathered, so that a bucket gets one more file and not one per task.
    changed = changed.hint("rebalance", BUCKET)
    staged = materialize(rest.unionByName(changed.select(*rest.columns)), "merged-buckets")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def upsert_bucketed(
    spark: SparkSession, path: str, schema: str, incoming: DataFrame, upsert: Merge, *args: Sequence[str],
    prune_from: int = PRUNE_FROM,
) -> DataFrame:
    """``merge_buckets`` with an upsert of ``operators.upsert`` and its arguments after the keys; the table it leaves."""
    keys = list(spark.read.parquet(f"{path}/{LAYOUT}").first()["keys"])
    merge_buckets(spark, path, schema, incoming, lambda target, new: upsert(target, new, keys, *args), prune_from)
    spark.catalog.refreshByPath(path)
    return read_bucketed(spark, path, schema)
