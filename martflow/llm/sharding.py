"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, far more than shards. Bytes
are summed per slot, and a small versioned map says which shard holds which
slot. Rebalancing edits the map: slots move from full shards to empty ones and
no record is hashed anew. A slot above its fair share, which only many rows
with equal id and text can cause, is listed in the map by its pieces.

Slots and pieces are fixed in number, so the map and the sums it rests on stay
the same size whatever the input; they alone pass through the driver.

Defined results: null text weighs as empty text; null and repeated ids are
hashed like others, together with the text's checksum. No rows give an
untouched map and no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.session import materialize, scratch_path

SLOTS = 4096
PIECES = 16
OVERHEAD = 8  # bytes a record costs besides its text
WHOLE = -1  # piece of a map row that stands for the whole slot
MAP_SCHEMA = "version int, vslot int, piece int, shard int"


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS, pieces: int = PIECES) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``vslot`` and ``piece``.

    ``piece`` deals rows evenly by where they lie; write the frame before
    using it twice.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(key, text, *[c for c in docs.columns if c == "_row"])
        .withColumns({"size": (F.octet_length(body) + OVERHEAD).cast("long"), "text_crc32": F.crc32(body)})
        .withColumn("vslot", F.pmod(F.xxhash64(key, "text_crc32", "size"), F.lit(slots)).cast("int"))
        .withColumn("piece", F.pmod(F.monotonically_increasing_id(), F.lit(pieces)).cast("int"))
    )


def slot_sizes(rows: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(slot, piece) -> (bytes, rows). At most slots * pieces entries."""
    sums = rows.groupBy("vslot", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return {(r.vslot, r.piece): (r.bytes, r.n) for r in sums.collect()}


def first_map(shards: int, slots: int = SLOTS) -> dict[tuple[int, int], int]:
    """Slots dealt to shards in turn, before anything is known of their bytes."""
    return {(slot, WHOLE): slot % shards for slot in range(slots)}


def rebalanced(
    held: dict[tuple[int, int], int], sizes: dict[tuple[int, int], tuple[int, int]], shards: int
) -> dict[tuple[int, int], int]:
    """``held`` edited until no move or swap between the extreme shards helps.

    Shards beyond those in ``held`` start empty and are filled by moves.
    """
    whole: dict[int, int] = {}
    for (slot, _), (size, _) in sizes.items():
        whole[slot] = whole.get(slot, 0) + size
    heavy = sum(whole.values()) / (shards * 8)
    edited = {}
    weight = {}
    for (slot, piece), shard in held.items():
        if piece == WHOLE and whole.get(slot, 0) > heavy:
            for (s, p), (size, _) in sizes.items():
                if s == slot:
                    edited[slot, p], weight[slot, p] = shard, size
            continue
        edited[slot, piece] = shard
        weight[slot, piece] = whole.get(slot, 0) if piece == WHOLE else sizes.get((slot, piece), (0, 0))[0]
    load = [0] * shards
    units: list[set] = [set() for _ in range(shards)]
    for unit, shard in edited.items():
        load[shard] += weight[unit]
        units[shard].add(unit)
    for _ in range(len(edited) * 2):
        full, free = max(range(shards), key=lambda s: (load[s], s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[free]
        moves = [(abs(gap - 2 * weight[u]), u, None) for u in units[full] if 0 < weight[u] < gap]
        best = min(moves, default=None, key=lambda m: (m[0], m[1]))
        if best is None or best[0] > gap // 64:
            mine = sorted(units[full], key=lambda u: (weight[u], u))
            theirs = sorted(units[free], key=lambda u: (weight[u], u))
            swap = _best_swap(mine, theirs, weight, gap)
            if swap and (best is None or swap[0] < best[0]):
                best = swap
        if best is None or best[0] >= gap:
            break
        _, give, take = best
        for unit, source, target in ((give, full, free), (take, free, full)):
            if unit is not None:
                units[source].remove(unit)
                units[target].add(unit)
                load[source] -= weight[unit]
                load[target] += weight[unit]
                edited[unit] = target
    return edited


def _best_swap(mine: list, theirs: list, weight: dict, gap: int) -> tuple | None:
    """The exchange that brings two shards closest; both lists rise in weight."""
    best, at = None, 0
    for give in mine:
        while at + 1 < len(theirs) and abs(gap - 2 * (weight[give] - weight[theirs[at + 1]])) <= abs(
            gap - 2 * (weight[give] - weight[theirs[at]])
        ):
            at += 1
        if theirs and weight[give] > weight[theirs[at]]:
            left = abs(gap - 2 * (weight[give] - weight[theirs[at]]))
            if best is None or left < best[0]:
                best = (left, give, theirs[at])
    return best


def save_map(spark: SparkSession, path: str, version: int, held: dict[tuple[int, int], int]) -> None:
    """Store one version of the map; earlier versions stay."""
    rows = [(version, slot, piece, shard) for (slot, piece), shard in sorted(held.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}")


def with_shard(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows with the shard the map gives them. The map is fixed in size.

    A piece that the map does not list goes where the slot's first entry goes.
    """
    whole = held.groupBy("vslot").agg(F.min_by("shard", "piece").alias("_whole"))
    parts = held.filter(F.col("piece") != WHOLE).select("vslot", "piece", F.col("shard").alias("_part"))
    return (
        rows.join(F.broadcast(whole), "vslot", "left")
        .join(F.broadcast(parts), ["vslot", "piece"], "left")
        .withColumn("shard", F.coalesce("_part", "_whole"))
        .drop("_whole", "_part")
    )


def balanced_map(spark: SparkSession, rows: DataFrame, shards: int, slots: int = SLOTS):
    """Sizes and the map's path, holding version 1 (dealt in turn) and 2 (rebalanced)."""
    sizes = slot_sizes(rows)
    first = first_map(shards, slots)
    second = rebalanced(first, sizes, shards)
    path = scratch_path(spark, "slot-map")
    save_map(spark, path, 1, first)
    save_map(spark, path, 2, second)
    return sizes, second, path


def sharded(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``vslot`` and ``shard``; shards hold nearly equal bytes.

    Rows are written once with their pieces, which depend on where they lie,
    and read for the sums and for the result; they are not shuffled. Columns of
    those names are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("vslot", "shard")]
    rows = sized(docs.select(F.struct(*kept).alias("_row"), F.col(key).alias("_id"), F.col(text).alias("_text")), "_id", "_text")
    rows = materialize(rows.select("_row", "vslot", "piece", "size"), "slots")
    _, _, path = balanced_map(spark, rows, shards)
    return with_shard(rows, load_map(spark, path, 2)).select("_row.*", "vslot", "shard")


def shard_positions(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``size``, ``text_crc32``, ``vslot``, ``shard`` and its
    gapless ``slot`` in the shard.

    Rows are numbered inside each (slot, piece), and each of those starts where
    the ones before it in the shard end; no task ever holds a shard.
    """
    spark = docs.sparkSession
    rows = materialize(sized(docs, key, text).select(key, "size", "text_crc32", "vslot", "piece"), "records")
    sizes, held, path = balanced_map(spark, rows, shards)
    start, filled = [], [0] * shards
    for (slot, piece), (_, n) in sorted(sizes.items()):
        shard = held[slot, piece] if (slot, piece) in held else held[slot, WHOLE]
        start.append((slot, piece, filled[shard]))
        filled[shard] += n
    starts = spark.createDataFrame(start, "vslot int, piece int, start long")
    place = F.row_number().over(Window.partitionBy("vslot", "piece").orderBy(key, "text_crc32", "size"))
    return with_shard(rows.withColumn("_place", place), load_map(spark, path, 2)).join(
        F.broadcast(starts), ["vslot", "piece"]
    ).select(key, "size", "text_crc32", "shard", (F.col("start") + F.col("_place") - 1).alias("slot"), "vslot")
