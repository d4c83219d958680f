"""Surrogate and hash keys, and the running totals they rest on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.text import joined_text
from martflow.session import materialize


def md5_key(*values: Column) -> Column:
    """A hash key over the text of the natural key."""
    return F.md5(joined_text(*values))


def unique_ids(df: DataFrame, name: str) -> DataFrame:
    """Unique, increasing, gappy ids without any shuffle.

    Number rows right before they are written: a shuffle in between could
    bring together ids from two runs of a task that was lost and repeated.
    """
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def dense_ids(
    df: DataFrame,
    name: str,
    order_by: Sequence[str] = (),
    start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Ids ``start, start+1, ...`` in the order of ``order_by``, at any size.

    One range shuffle sorts the rows; each row then knows its partition and
    its place in it. Only the row count of each partition, one number apiece,
    is brought together to give every partition its first id. Without
    ``order_by`` rows are numbered as they lie and nothing is shuffled.
    """
    placed = _ranged(df, order_by, partitions) if order_by else df
    place = F.monotonically_increasing_id()  # partition number above 33 bits of row number
    placed = placed.withColumn("_place", place).withColumns(
        {
            "_part": F.shiftright("_place", 33),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    # Written once, so that the rows counted are the rows numbered.
    placed = materialize(placed.drop("_place"), "dense-ids")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return placed.join(F.broadcast(_offsets(sizes)), "_part").select(
        (F.col("_before") + F.col("_row") + F.lit(start)).alias(name), *df.columns
    )


def _ranged(df: DataFrame, order_by: Sequence[str], partitions: int | None) -> DataFrame:
    """Rows sorted across partitions, with no run of equals bound to one of them.

    Rows equal in ``order_by`` are told apart by their other columns, and full
    copies by the input partition they are in. Both stay the same when a lost
    task is run again.
    """
    ties = {"_tie": F.xxhash64(*df.columns), "_copy": F.spark_partition_id()}
    order = [*order_by, *ties]
    tied = df.withColumns(ties)
    ranged = (
        tied.repartitionByRange(partitions, *order) if partitions else tied.repartitionByRange(*order)
    )
    return ranged.sortWithinPartitions(*order).drop(*ties)


def _offsets(sizes: DataFrame) -> DataFrame:
    """Rows before each partition. One input row per partition, never more."""
    everything_before = (
        Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.select(
        "_part", F.coalesce(F.sum("_n").over(everything_before), F.lit(0)).alias("_before")
    )
