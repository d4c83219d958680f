"""Keyed loads into tables that have no keys of their own.

Incoming rows are first reduced to one row per key with an explicit order of
arrival, then merged with the target. Each function returns rows; writing
them, and replacing a table that the plan reads, is the sinks' business.
Applying a merge twice gives what applying it once does, null keys included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators.aggregates import one_row_per_key
from martflow.operators.pruning import held_rows
from martflow.session import materialize


def absent_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    prune: bool = False,
) -> DataFrame:
    """Incoming rows to append: the first of each key the target lacks.

    Only the target's key columns are read. Null keys equal null keys.
    ``prune`` is for targets much larger than the delivery: the reduced
    delivery is written, and of the target only rows that may have its keys
    leave the scan; the first of ``keys`` should be the one the target's files
    are ordered by.
    """
    first = one_row_per_key(incoming, keys, order_by, latest=False)
    known = target.select(*keys)
    if prune:
        first = materialize(first, "delivery")
        known = held_rows(known, first, keys)
    return without_keys(first, known, keys).select(*target.columns)


def without_keys(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not among the ``known``; null keys equal null keys."""
    matched = [F.col(f"n.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in keys]
    return rows.alias("n").join(known.alias("t"), matched, "left_anti")


def upsert_do_nothing(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Insert-if-absent: existing rows stay, the first new row of a key wins."""
    return target.unionByName(absent_rows(target, incoming, keys, order_by))


def reduce_updates(
    incoming: DataFrame, keys: Sequence[str], update: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key: ``update`` columns of the last row, others of the first."""
    kept = [c for c in incoming.columns if c not in (*keys, *update, *order_by)]
    everything = [*order_by, *[c for c in incoming.columns if c not in (*keys, *order_by)]]
    return (
        incoming.groupBy(*keys)
        .agg(F.min(F.struct(*everything)).alias("_first"), F.max(F.struct(*everything)).alias("_last"))
        .select(
            *keys,
            *[F.col(f"_first.{c}").alias(c) for c in kept],
            *[F.col(f"_last.{c}").alias(c) for c in update],
        )
    )


def upsert_columns(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """Insert new keys; of known keys change only the ``update`` columns."""
    new = reduce_updates(incoming, keys, update, order_by)
    return _merged(target, new, keys, update)


def upsert_rows(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Last write wins: the latest incoming row of a key replaces the whole row."""
    new = one_row_per_key(incoming, keys, order_by).select(*target.columns)
    replaced = [c for c in target.columns if c not in keys]
    return _merged(target, new, keys, replaced)


def _merged(
    target: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Full outer join of two frames that are unique by key; null keys equal null keys."""
    t = target.withColumn("_t", F.lit(True)).alias("t")
    n = new.withColumn("_n", F.lit(True)).alias("n")

    def column(c: str):
        ours, theirs = F.col(f"t.{c}"), F.col(f"n.{c}")
        if c in keys:
            return F.coalesce(ours, theirs).alias(c)
        if c in update:
            return F.when(F.col("_n"), theirs).otherwise(ours).alias(c)
        return F.when(F.col("_t"), ours).otherwise(theirs).alias(c)

    matched = [F.col(f"t.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    return t.join(n, matched, "full").select(*[column(c) for c in target.columns])
