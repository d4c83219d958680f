"""Hard-negative mining with angular triangle filtering.

Every row of the table is searched for every anchor, exactly, in blocks. The
angle between two vectors differs from the difference of their angles to a
third by no more than the triangle inequality allows. So angles to a few
reference directions are stored with the rows, rows that lie alike are stored
together, and for each *window* of consecutive rows its least and greatest
angles and norms give, by way of the cosine, bounds on the score any of its
rows can have with an anchor. Bounds are widened by more than rounding can
take away. A window whose bounds meet none of the scores an anchor still
looks for is passed over; the others are scored in integers.

References are centres of a bounded sample (``SAMPLE`` rows, the least by a
hash of their values) and change nothing but the work to be done: bounds hold
for any directions, and rows of lengths that the sample lacks have none.

Anchors are taken in passes of at most about ``ANCHOR_BYTES``, broadcast to
tasks that each read a part of the rows; a task returns its best rows per
query, which Spark ranks. No row is shuffled for a search, no group of equal
labels or equal vectors is gathered in one task, and what a task keeps is
bounded by the pass.

Rows with a null label or vector or with a null or non-finite component take
no part; null ids do, as the last of their score. Only vectors of equal length
have a score. Equal ids are different rows. Scores have to fit a long. Other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martflow.operators.joins import replicate
from martflow.session import materialize

# Rows the references are taken from, and how many are made of them.
SAMPLE = 4096
REFERENCES = 32
ROUNDS = 8

# Rows of one window.
WINDOW = 64

# Bytes of the anchors that are looked for in one pass over the rows.
ANCHOR_BYTES = 32 << 20

# Candidates a task holds before it drops those that can no longer count.
HELD = 100_000

# More than rounding takes from an angle (radians) and, relatively, from a score.
ANGLE_SLACK = 1e-6
SCORE_SLACK = 1e-9

# Sums of integer products up to this are exact in doubles.
EXACT = 2**52

LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

VECTORS = "key long, vec_id long, label long, vector array<long>"
FOUND = "anchor long, key long, vec_id long, score long"


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """The rows that take part, with a key of their own and integer components."""
    vector = F.col("embedding")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.where(F.col("label").isNotNull() & vector.isNotNull() & fine)
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return materialize(
        rows.select(
            F.monotonically_increasing_id().alias("key"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            scaled.cast("array<long>").alias("vector"),
        ),
        "vectors",
    )


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1.0)


def angles_to(rows: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of vectors to unit directions; of a zero vector, whose scores are 0, a right angle."""
    return np.arccos(np.clip(unit(rows) @ references.T, -1.0, 1.0))


def centres(sample: np.ndarray) -> np.ndarray:
    """Directions in the midst of a sample's vectors: far-apart ones first, then moved to their surroundings' mean."""
    rows = unit(sample.astype(np.float64))
    rows = rows[np.any(rows != 0, axis=1)]
    if not len(rows):
        return np.zeros((0, sample.shape[1]))
    chosen, near = [0], rows @ rows[0]
    while len(chosen) < min(REFERENCES, len(rows)):
        nxt = int(np.argmin(near))
        if near[nxt] > 1 - 1e-9:
            break
        chosen.append(nxt)
        near = np.maximum(near, rows @ rows[nxt])
    found = rows[chosen]
    for _ in range(ROUNDS):
        cell = np.argmax(rows @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, cell, rows)
        found = unit(np.where(np.any(sums != 0, axis=1, keepdims=True), sums, found))
    return found


def references(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Reference directions by vector length, of a sample of at most ``SAMPLE`` rows."""
    sample = vectors.select("vector").orderBy(F.xxhash64("vector", "vec_id")).limit(SAMPLE).toArrow()
    by_length: dict[int, list] = {}
    for row in sample.column("vector").to_pylist():
        by_length.setdefault(len(row), []).append(row)
    return {n: centres(np.array(rows, dtype=np.int64).reshape(len(rows), n)) for n, rows in by_length.items() if n}


def of_equal_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length in a column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    lengths = np.diff(offsets)
    parts = []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        parts.append((at, values[offsets[at][:, None] + np.arange(n)].reshape(len(at), n)))
    return parts


def stored(vectors: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """Rows with norm and angles, written in the order of their nearest direction and angle to it."""
    schema = f"{VECTORS}, norm double, angles array<double>, cell int, near double"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            norms, angles = np.zeros(batch.num_rows), [[]] * batch.num_rows
            cells, near = np.full(batch.num_rows, -1, dtype=np.int32), np.zeros(batch.num_rows)
            for at, rows in of_equal_length(batch.column("vector")):
                norms[at] = np.linalg.norm(rows.astype(np.float64), axis=1)
                known = directions.get(rows.shape[1])
                if known is not None and len(known):
                    theirs = angles_to(rows.astype(np.float64), known)
                    cells[at], near[at] = theirs.argmin(axis=1), theirs.min(axis=1)
                    for i, row in zip(at, theirs):
                        angles[i] = row
            columns = [*batch.columns, pa.array(norms), pa.array(angles, pa.list_(pa.float64())), pa.array(cells), pa.array(near)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    order = ["cell", "near", "key"]
    laid = vectors.mapInArrow(run, schema).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(laid.drop("cell", "near"), "vectors-by-angle")


class Anchors(NamedTuple):
    """The anchors of one pass that have the same vector length, with the scores they look for."""

    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    low: np.ndarray
    high: np.ndarray


def score_bounds(anchors: Anchors, angles: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows of these angles and norms can have with each anchor."""
    if angles.shape[1] and anchors.angles.shape[1]:
        low, high = angles.min(axis=0), angles.max(axis=0)
        apart = np.maximum(anchors.angles - high, low - anchors.angles).max(axis=1)
        least, most = anchors.angles + low, anchors.angles + high
        far = np.where(most <= math.pi, most, np.where(least >= math.pi, 2 * math.pi - least, math.pi)).min(axis=1)
    else:
        apart, far = np.zeros(len(anchors.keys)), np.full(len(anchors.keys), math.pi)
    top = np.cos(np.clip(apart - ANGLE_SLACK, 0.0, math.pi))
    bottom = np.cos(np.clip(far + ANGLE_SLACK, 0.0, math.pi))
    small, large = norms.min(), norms.max()
    most = anchors.norms * np.where(top >= 0, top * large, top * small)
    least = anchors.norms * np.where(bottom >= 0, bottom * small, bottom * large)
    slack = anchors.norms * large * SCORE_SLACK + 1
    return np.floor(least - slack), np.ceil(most + slack)


def integer_scores(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of integer vectors; by doubles where these are exact."""
    if bound < EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Search:
    """The best rows a task has seen for the anchors of one length."""

    def __init__(self, anchors: Anchors, best: int, same: bool):
        self.anchors, self.best, self.same = anchors, best, same
        self.floor = anchors.low.copy()
        self.held, self.count = [], 0
        self.windows = self.scored = 0

    def look(self, keys, ids, unnamed, labels, rows, norms, angles):
        """Take one window of rows."""
        own = self.anchors
        least, most = score_bounds(own, angles, norms)
        wanted = (most[:, None] >= self.floor) & (least[:, None] <= own.high) & (self.floor <= own.high)
        alive = wanted.any(axis=1)
        if self.same:
            alive &= np.isin(own.labels, labels)
        self.windows += len(alive)
        which = np.flatnonzero(alive)
        self.scored += len(which)
        if not len(which):
            return
        scores = integer_scores(own.vectors[which], rows, own.norms[which].max() * norms.max())
        fits = np.zeros(scores.shape, dtype=bool)
        for j in range(own.low.shape[1]):
            fits |= (scores >= self.floor[which, j, None]) & (scores <= own.high[which, j, None])
        fits &= (own.labels[which, None] == labels) == self.same
        fits &= own.keys[which, None] != keys
        a, b = np.nonzero(fits)
        if len(a):
            self.held.append((which[a], keys[b], ids[b], unnamed[b], scores[a, b]))
            self.count += len(a)
            if self.count > HELD:
                self.settle()

    def settle(self):
        """Keep the best rows of each query and raise its floor to the last of them."""
        if not self.held:
            return
        anchor, key, ident, unnamed, score = (np.concatenate(c) for c in zip(*self.held))
        keep = np.zeros(len(anchor), dtype=bool)
        order = np.lexsort((key, ident, unnamed, -score, anchor))
        for j in range(self.floor.shape[1]):
            mine = order[(score[order] >= self.floor[anchor[order], j]) & (score[order] <= self.anchors.high[anchor[order], j])]
            of = anchor[mine]
            begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, dtype=np.int64)
            place = np.arange(len(of)) - np.repeat(begins, np.diff(np.r_[begins, len(of)]))
            keep[mine[place < self.best]] = True
            last = mine[place == self.best - 1]
            self.floor[anchor[last], j] = score[last]
        self.held = [tuple(c[keep] for c in (anchor, key, ident, unnamed, score))]
        self.count = int(keep.sum())
        # Only a settled few may stay, or every window would be settled anew.
        self.count = min(self.count, HELD // 2)

    def results(self):
        self.settle()
        for anchor, key, ident, unnamed, score in self.held:
            yield self.anchors.keys[anchor], key, ident, unnamed, score


def search(rows: DataFrame, anchors: list[Anchors], best: int, same: bool) -> DataFrame:
    """The first ``best`` rows of every query, and few others, as ``FOUND``.

    A query is a column of the anchors' ``low`` and ``high``, the scores it
    takes; ``same`` says whether rows must have the anchor's label or another.
    """
    shared = rows.sparkSession.sparkContext.broadcast(anchors)
    arrow = to_arrow_schema(StructType.fromDDL(FOUND))

    def run(batches):
        searches = {a.vectors.shape[1]: Search(a, best, same) for a in shared.value}
        for batch in batches:
            keys, labels, norms = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "label", "norm"))
            unnamed = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False)
            angles = batch.column("angles")
            for at, matrix in of_equal_length(batch.column("vector")):
                mine = searches.get(matrix.shape[1])
                if mine is None:
                    continue
                (_, theirs), *_ = of_equal_length(angles.take(pa.array(at)))
                for i in range(0, len(at), WINDOW):
                    w = at[i : i + WINDOW]
                    mine.look(keys[w], ids[w], unnamed[w], labels[w], matrix[i : i + WINDOW], norms[w], theirs[i : i + WINDOW])
        for mine in searches.values():
            for anchor, key, ident, none, score in mine.results():
                columns = [pa.array(anchor), pa.array(key), pa.array(ident, mask=none), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    found = materialize(rows.mapInArrow(run, FOUND), "candidates")
    shared.unpersist()
    return found


def first_rows(found: DataFrame, by: list[str], best: int) -> DataFrame:
    """The first ``best`` rows of each query with their ``rank``: higher scores, then smaller ids."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def anchors_of(block: pa.Table) -> list[Anchors]:
    """The anchors of a pass, looking for any score."""
    columns = {c: block.column(c).to_numpy() for c in ("key", "label", "norm")}
    angles, made = block.column("angles").combine_chunks(), []
    for at, matrix in of_equal_length(block.column("vector")):
        (_, theirs), *_ = of_equal_length(angles.take(pa.array(at)))
        every = np.ones((len(at), 1), dtype=np.int64)
        made.append(Anchors(columns["key"][at], columns["label"][at], matrix, columns["norm"][at], theirs, every * LOWEST, every * HIGHEST))
    return made


def between(anchors: list[Anchors], positives: pa.Table, positive: int, low: int, high: int) -> list[Anchors]:
    """The same anchors, looking for the scores between two percentages of each of their positives' scores."""
    keys, ranks, scores = (positives.column(c).to_pylist() for c in ("anchor", "rank", "score"))
    spans = {(k, r): (-(-low * s // 100), high * s // 100) for k, r, s in zip(keys, ranks, scores)}
    made = []
    for a in anchors:
        limits = np.array([[spans.get((k, r), (1, 0)) for r in range(1, positive + 1)] for k in a.keys.tolist()], dtype=np.int64)
        made.append(a._replace(low=limits[:, :, 0], high=limits[:, :, 1]))
    return made


def mine(
    vectors: DataFrame, is_anchor: str, positive: int = 5, negative: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """Hard negatives of the anchors among ``vectors``, a written table as ``quantised`` makes it.

    An anchor's positives are its first ``positive`` other rows of its label by
    inner product. For each of them come the first ``negative`` rows of other
    labels whose score lies between ``low`` and ``high`` percent of its score.
    """
    rows = stored(vectors, references(vectors))
    anchors = rows.where(is_anchor)
    size = anchors.agg(F.coalesce(F.sum(F.size("vector") + F.size("angles") + 8), F.lit(0)).alias("n")).first()["n"] * 8
    passes = max(1, math.ceil(size / ANCHOR_BYTES))
    parts = []
    for i in range(passes):
        block = anchors_of(anchors.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == i).toArrow())
        near = materialize(first_rows(search(rows, block, positive, True), ["anchor"], positive), "positives")
        block = between(block, near.select("anchor", "rank", "score").toArrow(), positive, low, high)
        found = search(rows, block, negative, False)
        of = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("rank").alias("place"), F.col("score").alias("positive_score"))
        inside = (low * F.col("positive_score") <= 100 * F.col("score")) & (100 * F.col("score") <= high * F.col("positive_score"))
        parts.append(first_rows(found.join(replicate(of), "anchor").where(inside), ["anchor", "place"], negative))
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    names = anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return chosen.join(replicate(names), "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
