"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

Documents are sets of word shingles. Two sets can only be similar if their
sizes are, so sets fall into size bands; a level holds one band and the sizes
its members may pair with. All shingles have one order, the rarest first. Two
sets of a level that are similar enough share a shingle among the first few of
each, as many as may be missing in the other and one more: sets that share such
a shingle form a tile, and no link lies outside all tiles.

Any order gives the same links. The one used puts first what is known to occur
in one document alone, and so makes no tile: of the shingles whose hashes fall
into a fixed quarter, those that are shared are found exactly and kept in a bit
filter of fixed size; the rest of the quarter comes first. A document with
enough shingles of its own is a member of no tile. Then come shingles outside
the quarter, then shared ones, each by counts of documents in a table of fixed
size, into which all shingles are hashed. That keeps shingles of frequent lines
and passages out of the tiles. A full filter only makes tiles more numerous.

Bitmaps of hashed shingles bound each overlap from above (a bit set in one
alone is a shingle missing in the other), and pairs that pass are decided by
intersecting the sorted shingle arrays. Every document first tries the partner
it meets in most tiles, then components that meet try one pair each; links are
joined to components. Only tiles that still hold several components are
compared all against all across components, in blocks of bounded size. The
result is exact.

Defined results: ``A``-``Z`` are lower-cased; words are runs of anything but
ASCII white space. Fewer words than a shingle make one shingle of the whole.
Null and empty texts have size 0 and link with nothing. Rows with a null id
link with nothing and have a null component. Rows that share an id are one
node. Other columns are kept by ``without_near_copies`` and not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import WordHashes, by_ids, join_per_key, map_batches
from martflow.llm.components import components
from martflow.session import materialize

GROWTH = 1.6  # of the bands' lower ends
FILTER_BITS = 26
SAMPLE_SHIFT, SAMPLE_MASK = 40, 3  # shingles with none of these bits form the quarter
BLOCK = 400  # members of a block; a tile is compared block by block
PAIRS_A_TASK = 5_000  # compared by a task at least
ROUNDS = 3  # in which components that meet try a single pair
COUNT_BITS = 18  # of the table of counts that orders shingles
LEVEL_SEED = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)


class Likeness:
    """At least ``num`` of ``den`` shared shingles in the union, and the levels that follow."""

    def __init__(self, width: int, num: int, den: int):
        self.width, self.num, self.den = width, num, den
        self.lows = [1]

    def similar(self, shared: int, a: int, b: int) -> bool:
        return shared > 0 and self.den * shared >= self.num * (a + b - shared)

    def level(self, j: int) -> tuple[int, int, bool]:
        """Least and largest size, and whether unequal sets can be similar."""
        while len(self.lows) < j + 2:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * GROWTH)))
        top = self.lows[j + 1] - 1
        cap = top * self.den // self.num
        return self.lows[j], cap, (self.den - self.num) * (top + cap) >= self.den + self.num

    def levels(self, size: int) -> list[tuple[int, int, int]]:
        """(level, first, bits) for each level that compares sets of this size:
        a similar set of the level shares one of the ``first`` shingles."""
        found, j = [], 0
        while True:
            low, cap, unequal = self.level(j)
            if low > size:
                return found
            if size <= cap and unequal:
                least = max(low, -(-self.num * size // self.den))
                shared = -(-self.num * (size + least) // (self.num + self.den))
                found.append((j, size - shared + 1, 1 << max(6, int(np.ceil(np.log2(4 * cap))))))
            j += 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = hashes.of(words)
    n = max(1, len(codes) - width + 1)
    total = np.full(n, len(codes) if len(codes) < width else 0, dtype=np.uint64)
    factor = 0xD6E8FEB86659FD93
    for i in range(min(width, len(codes))):
        total += codes[i : i + n] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF | 1
    return np.unique(_mix(total))


def sampled(found: np.ndarray) -> np.ndarray:
    """Which shingles are of the quarter that is looked at for shared ones."""
    return found >> np.uint64(SAMPLE_SHIFT) & np.uint64(SAMPLE_MASK) == 0


def tile_keys(found: np.ndarray, levels: list, ranks: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Keys of the tiles a set is a member of: its first shingles in each of
    its levels, but for those that no other document has."""
    keys = [np.zeros(0, dtype=np.uint64)]
    if levels:
        slot = found >> np.uint64(64 - FILTER_BITS)
        marked = shared[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1) == 1
        group = np.where(sampled(found), np.where(marked, 2, 0), 1)
        order = np.argsort(ranks[found >> np.uint64(64 - COUNT_BITS)] + (group << COUNT_BITS), kind="stable")
        for j, first, _ in levels:
            chosen = order[:first]
            keys.append(_mix(found[chosen[group[chosen] > 0]] + LEVEL_SEED * np.uint64(j + 1)))
    return np.concatenate(keys)


def bitmap(found: np.ndarray, bits: int) -> bytes:
    marks = np.zeros(bits, dtype=np.uint8)
    marks[found & np.uint64(bits - 1)] = 1
    return np.packbits(marks).tobytes()


def folded(marks: bytes, size: int) -> bytes:
    """The bitmap of ``size`` bytes of the same set, from a wider one."""
    return np.bitwise_or.reduce(np.frombuffer(marks, np.uint8).reshape(-1, size), axis=0).tobytes()


def overlap_bound(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> int:
    """Shingles two sets can share at most, by the bits that only one has."""
    only_a = int(np.bitwise_count(a & ~b).sum())
    only_b = int(np.bitwise_count(b & ~a).sum())
    return min(size_a - only_a, size_b - only_b)


def _counts(like: Likeness):
    """(``key``, ``n``): each shingle of the quarter once per document; and per
    slot of the table of counts, marked by a bit that no such shingle has, the
    documents of all shingles that share it."""

    def make():
        hashes, counts = WordHashes(), np.zeros(1 << COUNT_BITS, dtype=np.int64)

        def work(batch):
            keys = [np.zeros(0, dtype=np.uint64)]
            for text in batch["text"]:
                found = shingles(text, like.width, hashes)
                np.add.at(counts, found >> np.uint64(64 - COUNT_BITS), 1)
                keys.append(found[sampled(found)])
            keys = np.concatenate(keys).astype(np.int64)
            return {"key": keys, "n": np.ones(len(keys), dtype=np.int64)}

        def last():
            used = np.flatnonzero(counts)
            return {"key": used | 1 << SAMPLE_SHIFT, "n": counts[used]}

        work.last = last
        return work

    return make


def _order(texts: DataFrame, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Each slot's place by its count, and the bit filter of shared shingles of
    the quarter. What is collected has a fixed size."""
    is_slot = F.shiftright("key", SAMPLE_SHIFT).bitwiseAND(SAMPLE_MASK) > 0
    found = map_batches(texts, _counts(like), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = materialize(found.filter(is_slot | (F.col("n") > 1)), "shingle-counts")
    slots = found.filter(is_slot).select((F.col("key") - (1 << SAMPLE_SHIFT)).alias("slot"), "n").toArrow()
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    counts[slots["slot"].to_numpy()] = slots["n"].to_numpy()
    ranks = np.empty(1 << COUNT_BITS, dtype=np.int32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(1 << COUNT_BITS, dtype=np.int32)
    return ranks, _filter_of(found.filter(~is_slot).select("key"))


def _signatures(like: Likeness, order):
    def make():
        hashes, (ranks, shared) = WordHashes(), order.value

        def work(batch):
            out = {"id": batch["id"], "size": [], "digest": [], "bitmap": [], "keys": []}
            for name, text in zip(batch["id"], batch["text"], strict=True):
                found = shingles(text, like.width, hashes)
                levels = like.levels(len(found)) if name is not None else []
                out["size"].append(len(found))
                out["digest"].append(_digest(found))
                out["bitmap"].append(bitmap(found, max(width for *_, width in levels)) if levels else b"")
                out["keys"].append(tile_keys(found, levels, ranks, shared).astype(np.int64))
            return out

        return work

    return make


def _digest(found: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    with np.errstate(over="ignore"):
        sums = np.array([found.sum(dtype=np.uint64), _mix(found).sum(dtype=np.uint64)], dtype=np.uint64)
    return sums.tobytes()


def _filter_of(keys: DataFrame) -> np.ndarray:
    """One bit per key prefix; at most 2**(FILTER_BITS - 6) words are collected."""
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    words = (
        keys.select(F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint64)
    return bits


def _bounds(like: Likeness):
    def make():
        def work(batch):
            states = []
            for i in range(len(batch["a"])):
                if batch["digest_a"][i] == batch["digest_b"][i]:
                    states.append(1)
                    continue
                marks, sizes = (batch["bitmap_a"][i], batch["bitmap_b"][i]), (batch["size_a"][i], batch["size_b"][i])
                width = min(map(len, marks))
                both = [np.frombuffer(folded(m, width), np.uint64) for m in marks] if width else []
                states.append(2 if both and like.similar(overlap_bound(*both, *sizes), *sizes) else 0)
            return {"a": batch["a"], "b": batch["b"], "state": states}

        return work

    return make


def _exact(like: Likeness):
    def make():
        hashes = WordHashes()
        last: dict[str, np.ndarray] = {}

        def array(text):
            if text not in last:
                if len(last) > 8:
                    last.clear()
                last[text] = shingles(text, like.width, hashes)
            return last[text]

        def work(batch):
            linked = []
            for x, y in zip(batch["text_a"], batch["text_b"], strict=True):
                p, q = array(x), array(y)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(like.similar(shared, len(p), len(q)))
            return {"a": batch["a"], "b": batch["b"], "linked": linked}

        return work

    return make


def _links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar, as edges (``u``, ``v``). Written."""
    own = ["size", "digest", "bitmap"]
    pairs = materialize(pairs, "pairs")
    count = pairs.count()
    if not count:
        return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    tasks = -(-count // PAIRS_A_TASK)
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    met = by_ids(sets.select("id", *own), materialize(ids, "met"), "id")

    def side(name: str) -> DataFrame:
        return met.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in own])

    bounded = map_batches(
        pairs.join(side("a"), "a").join(side("b"), "b").coalesce(tasks), _bounds(like), "a long, b long, state int"
    ).filter("state > 0")
    # A repeated id has several sets.
    bounded = materialize(bounded.distinct().coalesce(tasks), "bounded")
    edges = bounded.filter("state = 1").select(F.col("a").alias("u"), F.col("b").alias("v"))
    to_check = bounded.filter("state = 2").select("a", "b")
    wanted = materialize(
        to_check.select(F.col("a").alias("id")).unionByName(to_check.select(F.col("b").alias("id"))).distinct(), "wanted"
    )
    some = materialize(by_ids(texts, wanted, "id"), "texts")
    both = to_check.join(some.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        some.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    checked = map_batches(both.coalesce(tasks), _exact(like), "a long, b long, linked boolean").filter("linked")
    return materialize(edges.unionByName(checked.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")


def _tile_pairs(like: Likeness):
    """Pairs of different components in a tile's block pair whose bitmaps allow a link."""

    def make():
        def work(batch):
            found: set[tuple[int, int]] = set()
            for members, cross in zip(batch["members"], batch["cross"], strict=True):
                by_level: dict[int, list] = {}
                for m in members:
                    for level, _, width in like.levels(m["size"]):
                        bits = folded(m["bitmap"], width // 8)
                        by_level.setdefault(level, []).append((m["id"], m["component"], m["size"], m["block"], bits))
                for rows in by_level.values():
                    rows.sort(key=lambda r: (r[2], r[0]))
                    ids = np.array([r[0] for r in rows])
                    component = np.array([r[1] for r in rows])
                    size = np.array([r[2] for r in rows])
                    block = np.array([r[3] for r in rows])
                    bits = np.frombuffer(b"".join(r[4] for r in rows), np.uint64).reshape(len(rows), -1)
                    for i in range(len(rows) - 1):
                        end = np.searchsorted(size, size[i] * like.den // like.num, side="right")
                        other = np.flatnonzero(component[i + 1 : end] != component[i]) + i + 1
                        if cross:
                            other = other[block[other] != block[i]]
                        if not len(other):
                            continue
                        only_i = np.bitwise_count(bits[i] & ~bits[other]).sum(axis=1, dtype=np.int64)
                        only_o = np.bitwise_count(bits[other] & ~bits[i]).sum(axis=1, dtype=np.int64)
                        most = np.minimum(size[i] - only_i, size[other] - only_o)
                        fits = (most > 0) & (like.den * most >= like.num * (size[i] + size[other] - most))
                        found.update((int(ids[i]), b) for b in ids[other[fits]].tolist())
            return {"a": [a for a, _ in found], "b": [b for _, b in found]}

        return work

    return make


def _joined(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """Labels after further links, and whether there were any."""
    if links.isEmpty():
        return labels, False
    return components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links)), True


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (``key``, ``id``, ``component``) of tiles that hold several components. Written."""
    named = members.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    named = materialize(named, "named-tiles")
    held = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    held = materialize(held.filter("low <> high").select("key"), "open-tiles")
    return materialize(named.join(held, "key"), "open-members")


def _one_pair_each(members: DataFrame) -> DataFrame:
    """For components that meet in a tile with its lowest component: one pair of documents."""
    local = members.groupBy("key", "component").agg(F.min("id").alias("id"))
    lowest = local.groupBy("key").agg(F.min(F.struct("component", "id")).alias("low"))
    met = local.join(lowest, "key").filter("component <> low.component")
    pairs = met.groupBy("component", F.col("low.component").alias("other")).agg(
        F.min(F.struct(F.col("id").alias("a"), F.col("low.id").alias("b"))).alias("pair")
    )
    return pairs.select("pair.a", "pair.b")


def _unsettled(members: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of different components that share a tile and whose bitmaps allow a link. Written.

    Tiles that overlap form a cluster. Where comparing the cluster's members
    all against all costs less than comparing tile by tile, which meets the
    same pair again and again, the cluster stands for its tiles.
    """
    first = members.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first, "tile-firsts")
    edges = members.join(first, "key").select(F.col("id").alias("u"), F.col("first").alias("v")).filter("u <> v")
    cluster = components(edges.distinct())
    named = members.join(cluster.select(F.col("node").alias("id"), F.col("component").alias("_c")), "id", "left")
    named = materialize(named.withColumn("cluster", F.coalesce("_c", "id")).drop("_c"), "clustered")
    tile_cost = named.groupBy("cluster", "key").agg(F.count(F.lit(1)).alias("n"))
    tile_cost = tile_cost.groupBy("cluster").agg(F.sum(F.col("n") * F.col("n")).alias("by_tile"))
    sizes = named.select("cluster", "id").distinct().groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    whole = sizes.join(tile_cost, "cluster").filter(F.col("size") * F.col("size") <= F.col("by_tile"))
    whole = materialize(whole.select("cluster", F.lit(True).alias("whole")), "whole-clusters")
    of_cluster = F.coalesce("whole", F.lit(False))
    named = named.join(whole, "cluster", "left").select(
        F.when(of_cluster, F.col("cluster")).otherwise(F.col("key")).alias("key"),
        of_cluster.alias("whole"),
        "id",
        "component",
    )
    named = materialize(named.distinct(), "compared")
    counted = materialize(named.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("members")), "compared-sizes")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = named.join(counted, ["key", "whole"]).withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    # Documents that share many first shingles meet in many tiles with the same
    # members; each set of members is compared once.
    member = F.struct("id", "component", "block")
    tiles = (
        rows.groupBy("key", "whole", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
        .agg(F.array_sort(F.collect_set(member)).alias("members"))
        .select("members", (F.col("x") != F.col("y")).alias("cross"))
        .distinct()
    )
    tiles = materialize(tiles.withColumn("tile", F.monotonically_increasing_id()), "distinct-tiles")
    grouped = (
        tiles.select("tile", "cross", F.inline("members"))
        .join(sets.select("id", "size", "bitmap"), "id")
        .groupBy("tile", "cross")
        .agg(F.collect_list(F.struct("id", "component", "size", "block", "bitmap")).alias("members"))
    )
    return materialize(map_batches(grouped, _tile_pairs(like), "a long, b long").distinct(), "open-pairs")


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """Per row: ``key``, ``n_shingles`` and ``component_id``, the smallest id
    reachable over links: ``den`` * shared >= ``num`` * union."""
    like = Likeness(width, num, den)
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    named = texts.filter(F.col("id").isNotNull() & F.col("text").isNotNull())

    order = spark.sparkContext.broadcast(_order(named.select("text"), like))
    sets = materialize(
        map_batches(
            texts,
            _signatures(like, order),
            "id long, size long, digest binary, bitmap binary, keys array<long>",
        ),
        "signatures",
    )

    # Equal sets are linked by digest, and one of them stands for all in tiles.
    nodes = sets.filter(F.col("id").isNotNull() & (F.col("size") > 0))
    leaders = nodes.groupBy("digest", "size").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    leaders = materialize(leaders.withColumn("of", F.concat("digest", F.col("size").cast("string").cast("binary"))), "equal")
    equal = join_per_key(
        nodes.select("id", F.concat("digest", F.col("size").cast("string").cast("binary")).alias("of")),
        leaders.select("of", "first", "n"),
        ["of"],
        "n",
        nodes.count(),
    )
    equal = equal.filter("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v"), "of")
    equal = materialize(equal.distinct(), "equal-links")
    # An id may have other sets besides the one it follows in; those stay.
    members = sets.filter(F.col("id").isNotNull())
    members = members.select("id", F.concat("digest", F.col("size").cast("string").cast("binary")).alias("of"), "keys")
    members = members.join(equal.select(F.col("u").alias("id"), "of"), ["id", "of"], "left_anti")
    members = materialize(members.select(F.explode("keys").alias("key"), "id").distinct(), "members")
    equal = equal.select("u", "v")
    firsts = members.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialize(firsts.filter("n > 1"), "firsts")
    tiles = join_per_key(members, firsts, ["key"], "n", members.count()).filter(F.col("first").isNotNull())
    tiles = materialize(tiles.select("key", "id", "first"), "tiles")
    # Each document first tries the one it meets most often.
    met = tiles.filter("id <> first").groupBy("id", "first").agg(F.count(F.lit(1)).alias("n"))
    pairs = met.groupBy("id").agg(F.max(F.struct("n", (-F.col("first")).alias("least"))).alias("best"))
    pairs = pairs.select(F.col("id").alias("a"), (-F.col("best.least")).alias("b"))

    links = materialize(_links(pairs, sets, texts, like).unionByName(equal), "first-links")
    labels = components(links)

    # Then components that meet in a tile try one pair, a few times over, ...
    members = tiles.select("key", "id")
    for _ in range(ROUNDS):
        members = _open_members(members, labels)
        labels, changed = _joined(labels, _links(_one_pair_each(members), sets, texts, like))
        members = members.select("key", "id")
        if not changed:
            break
    # ... and at last everything left is compared.
    labels, _ = _joined(labels, _links(_unsettled(_open_members(members, labels), sets, like), sets, texts, like))
    found = sets.select("id", "size").join(labels, F.col("id") == F.col("node"), "left")
    own = F.when(F.col("size") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), own.alias("component_id"))


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row of each component, with all its columns; rows without words stay.

    Rows are judged, not ids: each is a node of its own, so texts that share an
    id are compared by themselves and rows without an id like others. The row
    with the smallest id stays, a null id being the last; of rows that share it
    any one. The rows are written once, numbered. A row's node is its id where
    no other row has it, else a number below all ids.
    """
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_n"))
    numbered = materialize(numbered, "numbered-rows")
    told = numbered.select("_n", F.col(f"_row.`{key}`").cast("long").alias("id"), F.col(f"_row.`{text}`").alias("text"))
    shared = told.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("_shared")).filter("n > 1")
    shared = materialize(shared.select("id", "_shared"), "shared-ids")
    low = told.agg(F.least(F.lit(0), F.min("id"))).first()[0] or 0
    own = F.when(F.col("id").isNull() | F.col("_shared"), F.lit(low - 1) - F.col("_n")).otherwise(F.col("id"))
    told = by_ids(told, shared, "id", "left").select("_n", "id", "text", own.alias("_node"))
    found = jaccard_components(told, "_node", "text", width, num, den).filter("n_shingles > 0")
    placed = found.join(told.select("_n", "id", "_node"), "_node")
    placed = placed.select("_n", "component_id", F.struct(F.col("id").isNull(), "id", "_n").alias("place"))
    placed = materialize(placed, "near-copy-places")
    groups = placed.groupBy("component_id").agg(F.min("place").getField("_n").alias("stays"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups.filter("n > 1"), "near-copy-groups")
    copies = join_per_key(placed.select("_n", "component_id"), groups, ["component_id"], "n", placed.count())
    gone = materialize(copies.filter("_n <> stays").select("_n"), "near-copies")
    return by_ids(numbered, gone, "_n", "left_anti").select(*[F.col(f"_row.`{c}`") for c in docs.columns])
