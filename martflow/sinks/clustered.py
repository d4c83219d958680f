"""Tables that can be looked up by any of several keys.

A table partitioned or sorted by one key is read whole when it is asked for
another. Here rows are put into files by the interleaved bits of all keys, so
that each file spans a small part of every key's range, and a table of the
files, with the least and greatest value of every key, says which of them a
lookup has to open. No directory of the table is listed, and files that are
not in the table of files, as a failed write leaves them, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.buckets import even_buckets
from martflow.session import folder_exists

FILES = "_files"

# Bits by which the parts of a key outnumber those that files alone would need.
SPARE_BITS = 2
MOST_BITS = 60


def interleaved(parts: Sequence[Column], bits: int) -> Column:
    """The bits of several numbers in turn, the highest of each first."""
    n = len(parts)
    placed = [
        F.shiftleft(F.shiftright(part, i).bitwiseAND(F.lit(1)).cast("long"), i * n + (n - 1 - j))
        for i in range(bits)
        for j, part in enumerate(parts)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), placed)


def with_place(df: DataFrame, keys: Sequence[str], files: int, name: str) -> DataFrame:
    """The rows with their place along a curve on which rows near in all keys lie near each other.

    Each key counts by the rank of its value, so skewed keys do not crowd it.
    Nulls are the least of their key.
    """
    bits = min(MOST_BITS // len(keys), math.ceil(math.log2(max(2, files)) / len(keys)) + SPARE_BITS)
    buckets = even_buckets(df, {k: (1 << bits) - 1 for k in keys})
    parts = {f"{name}{i}": F.coalesce(buckets[k](F.col(f"`{k}`")) + 1, F.lit(0)).cast("int") for i, k in enumerate(keys)}
    return df.withColumns(parts).withColumn(name, interleaved([F.col(p) for p in parts], bits)).drop(*parts)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int, append: bool = False) -> None:
    """Write ``df`` in about ``files`` files that each span little of every key.

    ``path`` must be unused unless rows are appended; appended rows are
    clustered among themselves. Rows of one place, as of a frequent
    combination of keys, may fill several files. Readers see the new rows when
    the table of files has been written, which is the last step.
    """
    spark = df.sparkSession
    ties = {"_tie": F.xxhash64(*df.columns), "_copy": F.spark_partition_id()}
    order = ["_place", *ties]
    placed = with_place(df, keys, files, "_place").withColumns(ties)
    laid = placed.repartitionByRange(files, *order).sortWithinPartitions("_place", *keys).drop(*order)
    known = spark.read.parquet(f"{path}/{FILES}").select("file") if append and folder_exists(spark, f"{path}/{FILES}") else None
    laid.write.mode("append" if append else "errorifexists").parquet(path)
    ranges = [f(F.col(f"`{k}`")).alias(f"{k}_{n}") for k in keys for n, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(f"`{k}`").isNull()).alias(f"{k}_nulls") for k in keys]
    rows = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"))
    if known is not None:
        rows = rows.join(F.broadcast(known), F.col("_file") == F.col("file"), "left_anti")
    listed = rows.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ranges, *nulls)
    listed.coalesce(1).write.mode("append").parquet(f"{path}/{FILES}")


def _may_hold(key: str, wanted: Any) -> Column:
    """Whether a file may hold a value, or one of a range (low, high; None is open)."""
    low, high = F.col(f"`{key}_min`"), F.col(f"`{key}_max`")
    if wanted is None:
        return F.col(f"`{key}_nulls`") > 0
    if not isinstance(wanted, tuple):
        return (low <= F.lit(wanted)) & (high >= F.lit(wanted))
    ends = [high >= F.lit(wanted[0])] if wanted[0] is not None else []
    ends += [low <= F.lit(wanted[1])] if wanted[1] is not None else []
    return reduce(and_, ends, low.isNotNull())


def _holds(key: str, wanted: Any) -> Column:
    value = F.col(f"`{key}`")
    if wanted is None:
        return value.isNull()
    if not isinstance(wanted, tuple):
        return value == F.lit(wanted)
    ends = [value >= F.lit(wanted[0])] if wanted[0] is not None else []
    ends += [value <= F.lit(wanted[1])] if wanted[1] is not None else []
    return reduce(and_, ends, value.isNotNull())


def lookup_clustered(spark: SparkSession, path: str, schema: Any, wanted: Mapping[str, Any]) -> DataFrame:
    """Rows in which every key of ``wanted`` has the value, or lies in the range (low, high).

    Any of the keys may be asked for, in any combination. Only files whose
    ranges admit such rows are opened; their names are all that is collected.
    """
    files = spark.read.parquet(f"{path}/{FILES}").where(reduce(and_, [_may_hold(k, v) for k, v in wanted.items()], F.lit(True)))
    names = [f"{path}/{r.file}" for r in files.select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*names).where(reduce(and_, [_holds(k, v) for k, v in wanted.items()], F.lit(True)))


def read_clustered(spark: SparkSession, path: str, schema: Any) -> DataFrame:
    """All rows of the table."""
    return lookup_clustered(spark, path, schema, {})
