"""Hard negatives against brute force in plain integers."""

import math
import random

import numpy as np
import pytest
from conftest import SMALL

from martflow.llm import hard_negatives
from martflow.llm.hard_negatives import mine, quantised

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, positive=5, negative=10):
    """(anchor, positive, rank, negative, scores) of rows (id, vector, label)."""
    live = []
    for n, (ident, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        live.append((n, ident, [math.floor(256 * float(np.float32(x))) for x in vector], label))

    def first(scored, k):
        return sorted(scored, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))[:k]

    out = []
    for n, ident, vector, label in live:
        if ident is None or ident % 100:
            continue
        scored = [(sum(map(int.__mul__, vector, v)), i, m, own) for m, i, v, own in live if m != n and len(v) == len(vector)]
        for ps, pid, _, _ in first([r for r in scored if r[3] == label], positive):
            fits = [r for r in scored if r[3] != label and 30 * ps <= 100 * r[0] <= 90 * ps]
            out += [(ident, pid, k + 1, r[1], ps, r[0]) for k, r in enumerate(first(fits, negative))]
    return sorted(out, key=str)


def found_in(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def some_rows(rng, n, d, clusters=6, ids=None):
    middles = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(clusters)]
    rows = []
    for i in range(n):
        c = rng.randrange(clusters)
        rows.append((ids(i) if ids else i, [float(np.float32(m + rng.gauss(0, 0.3))) for m in middles[c]], rng.randrange(4)))
    return rows


def test_brute_force(prepared):
    rows = some_rows(random.Random(1), 900, 12)
    assert found_in(mine(quantised(prepared.createDataFrame(rows, SCHEMA)), "vec_id % 100 = 0")) == by_hand(rows)


def test_hot_vectors_ties_and_repeated_ids(prepared):
    """A third of all rows are one vector; ids repeat and are missing."""
    rng = random.Random(2)
    rows = some_rows(rng, 400, 8, ids=lambda i: rng.choice([None, i % 150, i]))
    rows += [(i * 7, [0.5] * 8, i % 3) for i in range(200)] + [(100, [0.5] * 8, 1)] * 3
    got = found_in(mine(quantised(prepared.createDataFrame(rows, SCHEMA)), "vec_id % 100 = 0"))
    assert got == by_hand(rows)


def test_awkward_rows(prepared):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.9, 0.5], 2), (3, [0.4, 0.25], 3), (None, [0.5, 0.1], 2), (4, None, 1), (5, [1.0, None], 1),
        (6, [nan, 1.0], 1), (7, [1.0, inf], 1), (8, [0.5, 0.5], None), (9, [], 1), (100, [], 1), (200, [0.0, 0.0], 2), (10, [0.0, 0.0], 2),
        (300, [1.0, 2.0, 3.0], 1), (11, [1.0, 2.0, 2.5], 1), (12, [1.0, 1.0, 1.0], 2), (400, [-1.0, -0.5], 1), (500, [3000.0, 1.0], 1), (13, [1e4, 1.0], 1),
        (14, [4000.0, 2.0], 0), (600, None, None), (15, [9.0], 1), (-100, [0.7, 0.7], 1),
    ]
    table = prepared.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", key int")
    assert found_in(mine(quantised(table), "vec_id % 100 = 0")) == by_hand(rows)
    assert mine(quantised(table.limit(0)), "vec_id % 100 = 0").count() == 0
    assert mine(quantised(table), "vec_id = 99").count() == 0


def test_wide_scores_are_exact():
    a = np.array([[2**30, 2**30 + 1]])
    assert hard_negatives.integer_scores(a, a, float(2**62)).tolist() == [[2**60 + (2**30 + 1) ** 2]]


@pytest.mark.parametrize("setting, value", [("ANCHOR_BYTES", 500), ("HELD", 10), ("REFERENCES", 1), ("WINDOW", 3)])
def test_settings_change_no_row(prepared, monkeypatch, setting, value):
    rows = some_rows(random.Random(3), 500, 6)
    monkeypatch.setattr(hard_negatives, setting, value)
    assert found_in(mine(quantised(prepared.createDataFrame(rows, SCHEMA)), "vec_id % 100 = 0")) == by_hand(rows)


def window_of(rng, n, d, spread):
    middle = rng.normal(size=d) * 100
    return np.rint(middle + rng.normal(size=(n, d)) * spread).astype(np.int64)


def test_bounds_hold_and_pass_over_windows():
    """Every score lies within its window's bounds, and tight windows are told apart."""
    rng = np.random.default_rng(4)
    anchors = rng.integers(-300, 300, size=(40, 10))
    anchors[0] = 0
    directions = hard_negatives.centres(rng.integers(-300, 300, size=(200, 10)))
    own = hard_negatives.Anchors(
        np.arange(40), np.zeros(40), anchors, np.linalg.norm(anchors, axis=1), hard_negatives.angles_to(anchors.astype(float), directions),
        np.zeros((40, 1)), np.zeros((40, 1)),
    )
    narrow = 0
    for i in range(200):
        rows = window_of(rng, 8, 10, [0.0, 1.0, 20.0, 300.0][i % 4])
        if i % 7 == 0:
            rows[3] = 0
        if i % 5 == 0:
            rows[2] = anchors[i % 40] * 2
        low, high = hard_negatives.score_bounds(own, hard_negatives.angles_to(rows.astype(float), directions), np.linalg.norm(rows, axis=1))
        scores = anchors @ rows.T
        assert (scores >= low[:, None]).all() and (scores <= high[:, None]).all()
        narrow += (high < own.norms * np.linalg.norm(rows, axis=1).max() * 0.9).sum()
    assert narrow > 2000


def test_windows_without_candidates_are_not_scored():
    """In clustered data most windows are passed over."""
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(20, 16))
    rows = np.rint(256 * (np.repeat(middles, 100, axis=0) + rng.normal(size=(2000, 16)) * 0.02)).astype(np.int64)
    directions = hard_negatives.centres(rows[::7])
    angles, norms = hard_negatives.angles_to(rows.astype(float), directions), np.linalg.norm(rows, axis=1)
    at = np.arange(0, 2000, 50)
    every = np.ones((len(at), 1), dtype=np.int64)
    own = hard_negatives.Anchors(at, np.zeros(len(at)), rows[at], norms[at], angles[at], every * hard_negatives.LOWEST, every * hard_negatives.HIGHEST)
    searched = hard_negatives.Search(own, 5, True)
    blank = np.zeros(2000, dtype=bool)
    for i in np.random.default_rng(1).permutation(40) * 50:
        w = np.arange(i, i + 50)
        searched.look(w, w, blank[w], np.zeros(50), rows[w], norms[w], angles[w])
        searched.settle()
    assert searched.scored < 0.6 * searched.windows
    scores = rows[at] @ rows.T
    scores[np.arange(len(at)), at] = -(10**12)
    want = {(a, k) for a, row in zip(at, np.argsort(-scores, axis=1, kind="stable")[:, :5]) for k in row}
    assert {(a, k) for anchors, keys, *_ in searched.results() for a, k in zip(anchors, keys)} == want


def test_query_equals_brute_force(prepared):
    from martflow.llm.queries import QUERIES

    rows = [tuple(r) for r in prepared.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert found_in(QUERIES["op13_hard_negatives"](prepared, SMALL)) == by_hand(moved)
