"""Mixing sources to target weights that change over the run.

Each source's share of the mix is its weight times a schedule over training
progress 0..1. The schedule's integral is the source's cumulative demand for
words; a document whose middle is a given word of its source is met when that
demand reaches it, so the inverse of the integral is its training position.
Sorting the copies of all sources by position, by range, is the curriculum:
``mixture`` numbers the copies in that order and gives each document the places
of its own, ``curriculum`` gives the documents themselves.

Cumulative words come from sums over hash buckets and a window inside each
bucket, so that no task holds a source. Whole documents are taken; the one
that best fills what is left of a target ends each source.

Defined results: null text has no words. A null source is a source, the last.
Sources without words have target 0. Documents without words have taken 0.
Rows that repeat an id are placed one after the other. Other columns are not
read. Reruns agree: order within a source is a hash of the id, then the id,
then the size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.keys import dense_ids
from martflow.llm.common import join_per_key
from martflow.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5  # words of the mix over words there are
CAP = 2.0  # epochs at most
# Schedules over progress, as (progress, factor) knots: rising, level, falling.
SCHEDULES = (
    ((0.0, 0.5), (0.6, 1.0), (1.0, 2.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 2.0), (0.4, 1.0), (1.0, 0.5)),
)
BUCKET_ROWS = 100_000
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP
) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``place`` and ``target``.

    Words are shared by weight; a target stops at ``cap`` times its source and
    what is left over is shared again by weight among the others. Equivalent:
    target = least(cap * size, level * weight) for one level. The level only
    rises while sources reach their caps, and each round is one aggregate.
    """
    ordered = sources.withColumn("_null", F.col("source").isNull())
    placed = dense_ids(ordered, "place", ["_null", "source"]).drop("_null")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = materialize(placed.withColumn("_weight", weight), "sources")
    most = F.col("source_size") * cap
    total = placed.agg(F.sum("source_size").alias("n")).first().n or 0
    goal, level = budget * total, 0.0
    while True:
        capped = (F.col("_weight") * level >= most).cast("int")
        sums = placed.agg(
            F.sum(most * capped).alias("full"),
            F.sum(F.col("_weight") * (1 - capped)).alias("open"),
        ).first()
        if not sums.open:
            break
        rises = max(0.0, goal - (sums.full or 0.0)) / sums.open
        if rises <= level:
            break
        level = rises
    target = F.least(most, F.col("_weight") * level) if level else F.lit(0.0)
    return placed.withColumn("target", target.cast("double")).drop("_weight")


def position(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The progress at which a schedule has used up ``share`` of its demand."""
    areas = [
        (t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)
    ]
    area, before, found = sum(areas), 0.0, None
    need = share * area
    for ((t0, w0), (t1, w1)), piece in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        left = F.greatest(need - before, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # The root of slope/2 x^2 + w0 x = left, in the form that also holds for slope 0.
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0)))
        value = F.least(F.lit(t0) + 2 * left / (F.lit(w0) + root), F.lit(t1))
        found = value if found is None else F.when(need > before, value).otherwise(found)
        before += piece
    return found


def _inverse(knots: Sequence[tuple[float, float]]):
    return lambda share: position(share, knots)


def _positioned(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    cap: float = CAP,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    seed: int = 7,
) -> DataFrame:
    """Per row: ``key``, ``source``, ``size``, ``source_size``, ``target``,
    ``taken`` (words), ``copies`` and ``positions`` (one per copy, rising).

    ``_hash``, ``_key`` (of the source) and ``_end`` (where the document ends in
    its source) come besides; the last two tell apart all rows that are taken.
    """
    rows = docs.select(
        F.col(key).alias("_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    ).withColumns(
        {
            "_hash": F.xxhash64("_id", F.lit(seed)),
            # A key that is never null.
            "_key": F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")),
        }
    )
    rows = materialize(rows, "sizes")
    total = rows.count()
    bits = max(4, math.ceil(math.log2(max(1, total) / BUCKET_ROWS)) + 4)
    rows = rows.withColumn("_bucket", F.shiftrightunsigned("_hash", 64 - bits))
    cells = materialize(
        rows.groupBy("_key", "_bucket").agg(
            F.first("source").alias("source"), F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows")
        ),
        "cells",
    )
    sources = cells.groupBy("_key").agg(F.first("source").alias("source"), F.sum("_words").alias("source_size"))
    plan = source_targets(sources, weights, budget, cap)
    whole = F.floor(F.col("target") / F.col("source_size") + 1e-9)
    plan = plan.withColumn("_epochs", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("int"))
    rest = F.greatest(F.col("target") - F.col("_epochs") * F.col("source_size"), F.lit(0.0))
    plan = materialize(plan.withColumn("_rest", rest).drop("source"), "plan")

    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0))).join(plan, "_key")
    placed = rows.join(starts.drop("source", "_words", "_rows"), ["_key", "_bucket"])
    upto = (
        Window.partitionBy("_key", "_bucket")
        .orderBy("_hash", "_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = placed.withColumn("_end", F.col("_start") + F.sum("size").over(upto))
    placed = materialize(placed.drop("_bucket", "_start"), "placed")

    # What a source's last, partial epoch still lacks after the documents that
    # fit, and the one document that fills it best, if any improves on none.
    fits = F.col("_end") <= F.col("_rest")
    gaps = placed.groupBy("_key").agg(
        F.first("_rest").alias("_r"),
        F.max(F.when(fits, F.col("_end"))).alias("_fit"),
        F.count(F.lit(1)).alias("_rows"),
    )
    gaps = materialize(gaps.select("_key", "_rows", (F.col("_r") - F.coalesce("_fit", F.lit(0))).alias("_gap")), "gaps")
    left = join_per_key(placed, gaps, ["_key"], "_rows", total)
    off = F.abs(F.col("size") - F.col("_gap"))
    last = (
        left.filter(~fits & (off < F.col("_gap")))
        .groupBy("_key")
        .agg(F.min(F.struct(off.alias("off"), F.col("_hash").alias("hash"), F.col("_end").alias("end"))).alias("_last"))
        .select("_key", "_last.end")
    )
    ends = gaps.join(last, "_key", "left").select("_key", "_rows", F.col("end").alias("_chosen"))
    ends = materialize(ends, "ends")
    chosen = join_per_key(placed, ends, ["_key"], "_rows", total)
    again = fits | F.coalesce((F.col("_end") == F.col("_chosen")) & (F.col("size") > 0), F.lit(False))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("_epochs") + again.cast("int"))
    at = F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda k: F.least(
            (k * F.col("source_size") + F.col("_end") - F.col("size") / 2) / F.col("target"), F.lit(1.0)
        ),
    )
    by_shape = None
    for i, knots in enumerate(schedules):
        shaped = F.transform("_shares", _inverse(knots))
        by_shape = shaped if by_shape is None else F.when(F.col("place") % len(schedules) == i, shaped).otherwise(by_shape)
    none = F.array().cast("array<double>")
    return (
        chosen.withColumn("copies", copies)
        .withColumn("_shares", F.when(F.col("copies") > 0, at).otherwise(none))
        .select(
            F.col("_id").alias(key),
            "source",
            "size",
            "source_size",
            "target",
            (F.col("copies") * F.col("size")).alias("taken"),
            "copies",
            by_shape.alias("positions"),
            "_hash",
            "_key",
            "_end",
        )
    )


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """Per row: ``key``, ``source``, ``size``, ``source_size``, ``target``,
    ``taken`` (words), ``copies``, ``positions`` (one per copy, rising) and
    ``places``: which of all copies, from 0, the run reads it as.

    The copies of all sources are sorted by position, by range, and numbered;
    copies that share a position are read by a hash of the id.
    """
    rows = materialize(_positioned(docs, key, text, **parameters), "mix")
    named = [c for c in rows.columns if c not in ("positions", "_hash", "_key", "_end")]
    met = rows.filter(F.col("copies") > 0).withColumn("_position", F.explode("positions")).drop("positions")
    read = dense_ids(met, "_place", ["_position", "_hash", key, "_key", "_end"])
    copy = F.sort_array(F.collect_list(F.struct("_place", "_position")))
    taken = read.groupBy("_key", "_end").agg(*[F.first(c).alias(c) for c in named], copy.alias("_copies"))
    left = rows.filter(F.col("copies") == 0).withColumn("places", F.array().cast("array<long>"))
    return taken.select(
        *named,
        F.col("_copies._position").alias("positions"),
        F.col("_copies._place").alias("places"),
    ).unionByName(left.select(*named, "positions", "places"))


def curriculum(docs: DataFrame, key: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """``docs`` as the run reads them: each row as often as it is taken, with
    its ``position``, sorted by position across partitions. A column of that
    name is replaced.

    Rows that repeat id and text all get the largest number of copies.
    """
    plan = (
        _positioned(docs, key, text, **parameters)
        .filter(F.col("copies") > 0)
        .groupBy(F.col(key).alias("_id"), F.col("size").alias("_size"))
        .agg(F.max_by("positions", "copies").alias("_positions"))
    )
    kept = [c for c in docs.columns if c != "position"]
    sized = docs.select(F.struct(*kept).alias("_row"), F.col(key).alias("_of"), word_count(F.col(text)).alias("_words"))
    met = sized.join(plan, F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size")))
    return (
        met.select("_row.*", F.explode("_positions").alias("position"))
        .repartitionByRange("position", F.xxhash64(key))
        .sortWithinPartitions("position")
    )
