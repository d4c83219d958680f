"""N-gram join, decontamination, components and the pipeline, against brute force."""

import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from check import compare, oracle
from martflow.llm import decontaminate, ngram_join
from martflow.llm.components import components
from llm.conftest import AWKWARD


def test_components(prepared):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    rng.shuffle(edges)
    parent = {n: n for e in edges for n in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = dict(map(tuple, components(prepared.createDataFrame(edges, "u long, v long")).collect()))
    assert {n: found.get(n, n) for n in parent} == {n: root(n) for n in parent}


def join_by_hand(rows, width, num, den):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for name, text in rows:
        words = (text or "").translate(fold).encode().split()
        whole = {tuple(words)} if words else set()
        sets.append((name, {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or whole))
    parent = {n: n for n, _ in sets if n is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and den * len(s & t) >= num * len(s | t) > 0:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(
        ((n, len(s), None if n is None else root(n) if s else n) for n, s in sets), key=str
    )


@pytest.mark.parametrize(("width", "num", "den"), [(4, 85, 100), (5, 8, 10)])
def test_ngram_join_equals_brute_force(documents, width, num, den):
    rng = random.Random(width)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = [(r[0], r[1]) for r in AWKWARD]
    name = 100
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 20, 60, 200)))]
        for _ in range(rng.choice((1, 2, 6))):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4, 8)) * len(words) // 100 + rng.choice((0, 0, 1))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((name, " ".join(words)))
            name += 1
    docs = documents(rows).withColumn("component_id", F.lit("mine"))
    found = ngram_join.jaccard_components(docs, width=width, num=num, den=den).collect()
    assert sorted(map(tuple, found), key=str) == join_by_hand(rows, width, num, den)


def test_levels_hold_every_similar_pair():
    """Sets that differ as much as allowed share a tile, in whatever order shingles stand."""
    like = ngram_join.Likeness(4, 85, 100)
    rng = np.random.default_rng(4)
    slots = 1 << ngram_join.COUNT_BITS
    full = np.full(1 << (ngram_join.FILTER_BITS - 6), 2**64 - 1, dtype=np.uint64)
    orders = [np.zeros(slots, dtype=np.int32), rng.permutation(slots).astype(np.int32)]
    for size in list(range(1, 60)) + [150, 700, 3000]:
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        for lost in range(0, size // 6 + 2):
            b = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**63, rng.integers(0, lost + 1), dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if like.similar(shared, len(a), len(b)) and shared < max(len(a), len(b)):
                both = np.intersect1d(a, b) >> np.uint64(64 - ngram_join.FILTER_BITS)
                exact = np.zeros(1 << (ngram_join.FILTER_BITS - 6), dtype=np.uint64)
                np.bitwise_or.at(exact, both >> np.uint64(6), np.uint64(1) << (both & np.uint64(63)))
                for ranks in orders:
                    for marks in (exact, full):
                        keys = [set(ngram_join.tile_keys(s, like.levels(len(s)), ranks, marks).tolist()) for s in (a, b)]
                        assert keys[0] & keys[1]


def test_follower_of_one_text_still_links_by_another(documents):
    one, other = (" ".join(f"{x}{i}" for i in range(100)) for x in "ab")
    rows = [(1, one), (5, one), (5, other), (7, other + " more")]
    found = ngram_join.jaccard_components(documents(rows)).collect()
    assert sorted(map(tuple, found), key=str) == join_by_hand(rows, 4, 85, 100)
    assert {r.component_id for r in found} == {1}


def test_near_copies_go(documents):
    text = " ".join(f"w{i}" for i in range(100))
    docs = documents([(1, text), (2, text + " more"), (3, "another text of its own"), (4, None), (None, text)])
    kept = ngram_join.without_near_copies(docs)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4]
    assert ngram_join.jaccard_components(documents([])).count() == 0


def test_near_copies_are_rows_not_ids(documents):
    text = " ".join(f"w{i}" for i in range(100))
    own = "a text of its own that is found nowhere else at all"
    rows = [(1, text), (7, text + " more"), (7, own), (None, text), (None, own + " so"), (5, own), (5, own), (None, None), (None, None)]
    kept = ngram_join.without_near_copies(documents(rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, text), (5, own), (None, None), (None, None)], key=str)
    assert ngram_join.without_near_copies(documents(rows).limit(0)).count() == 0
    assert ngram_join.without_near_copies(documents([(None, own)] * 3)).count() == 1


ITEM = "the quick brown fox jumps over the lazy dog while seven green birds sing loudly near an old stone bridge"


HELD = pytest.mark.parametrize("held_words", [decontaminate.HELD_WORDS, 0])


@HELD
def test_leaks_tolerate_substitutions(prepared, documents, held_words):
    items = prepared.createDataFrame(
        [(1, ITEM), (2, "one two three"), (3, None), (4, "alpha beta gamma delta epsilon zeta")], "item_id long, text string"
    )
    words = ITEM.split()
    changed = " ".join("X" if i % 6 == 4 else w for i, w in enumerate(words))
    inserted = " ".join([*words[:14], "really", *words[14:]])  # leaves a stretch longer than a mask
    rows = [
        (10, f"Before. {ITEM.upper()}! After."), (11, f"pre {changed} post"), (12, inserted),
        (13, "the quick brown fox is all that is here, nothing of the rest is in this text at all"),
        (14, "one two three"), (15, "say alpha beta gamma delta epsilon zeta now"), (16, " ".join(reversed(words))),
        (17, "one two, then three"),
    ]
    docs = documents(rows + AWKWARD)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items, held_words=held_words).collect()}
    assert found == {(10, 1), (11, 1), (12, 1), (14, 2), (15, 4)}
    kept = decontaminate.without_leaks(docs.withColumn("uid", F.lit(1)), items, held_words=held_words)
    assert kept.count() == len(rows) + len(AWKWARD) - 5 and "uid" in kept.columns
    assert decontaminate.leaks(documents([]), items, held_words=held_words).count() == 0
    assert decontaminate.leaks(docs, items.limit(0), held_words=held_words).count() == 0


@HELD
def test_short_and_unspaced_items(prepared, documents, held_words):
    unspaced = "富士山は日本で一番高い山として広く知られている"
    items = prepared.createDataFrame(
        [(1, "paris"), (2, "forty two"), (3, "one two three"), (4, "a b c d"), (5, unspaced), (6, "東京"), (None, "lost and found box"), (7, " ?! ")],
        "item_id long, text string",
    )
    rows = [
        (10, "Paris!"), (11, "paris is a town"), (12, "Forty-two"), (13, "it is forty two"), (14, "say one two three now"),
        (15, "one two and three"), (16, "x a b c d y"), (17, "a b c"), (18, f"前置き{unspaced}。後書き"), (19, unspaced[:14]), (20, unspaced[:8]),
        (21, unspaced.replace("一", "二")), (22, "東京"), (23, "東京と大阪"), (24, "the lost and found box"), (25, "?!"), (26, "one two three " * 4),
    ]
    want = {(10, 1), (12, 2), (14, 3), (16, 4), (18, 5), (19, 5), (21, 5), (22, 6), (24, None), (26, 3)}
    found = decontaminate.leaks(documents(rows), items, held_words=held_words).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
    gone = {r for r, _ in want}
    kept = decontaminate.without_leaks(documents(rows), items, held_words=held_words).collect()
    assert {r.doc_id for r in kept} == {r for r, _ in rows} - gone


def words_matched_by_hand(doc: list, item: list) -> int:
    """Words of the item in a stretch of any alignment, from running sums."""
    hit = set()
    for shift in range(-len(item), len(doc)):
        same = [0 <= i + shift < len(doc) and doc[i + shift] == w for i, w in enumerate(item)]
        i = 0
        while i < len(item):
            if not same[i]:
                i += 1
                continue
            scores = []
            for s in same[i:]:
                scores.append((scores[-1] if scores else 0) + (1 if s else -2))
                if scores[-1] <= 0:
                    break
            end = i + scores.index(max(scores)) + 1
            matches = [k for k in range(i, end) if same[k]]
            hit.update(matches if len(matches) >= 5 else [])
            i += len(scores)
    return len(hit)


@HELD
def test_leaks_equal_brute_force(prepared, documents, held_words):
    """Short items with random substitutions, passages of them, and words that repeat."""
    rng = random.Random(8)
    items = [(n, [f"i{n}w{k}" for k in range(n)]) for n in (5, 6, 8, 10, 12, 15, 16, 17, 18, 20, 21, 24, 30, 59)]
    items += [(100 + n, [rng.choice("pqr") for _ in range(n)]) for n in (7, 11, 19)]
    items += [(200, ["same"] * 12)]
    rows = [(1000, "same " * 60), (1001, "same " * 7 + "other " + "same " * 4), (1002, "same " * 5 + "but not at all so"), (1003, "same same")]
    rows += [(1100 + n, " ".join(rng.choice("pqr") for _ in range(n))) for n in (5, 20, 60)]
    for n, words in items:
        for lost in range(0, n // 2 + 1) if n < 100 else ():
            for _ in range(3):
                gone = set(rng.sample(range(n), lost))
                part = ["x" if i in gone else w for i, w in enumerate(words)]
                rows.append((len(rows), " ".join(["before", *part, "after"])))
        for size in {len(words) // 2 - 1, -(-len(words) // 2), len(words) // 2 + 1}:
            start = rng.randrange(len(words) - size + 1)
            passage = words[start : start + size]
            rows.append((len(rows), " ".join(["before", *passage, "after"])))
            rows.append((len(rows), " ".join([*passage[:5], "between", *passage[5:]])))
    want = set()
    for name, text in rows:
        for n, words in items:
            matched = words_matched_by_hand(text.split(), words)
            if matched >= max(5, -(-len(words) // 2)):
                want.add((name, n, matched))
    tests = prepared.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    found = decontaminate.leaks(documents(rows), tests, held_words=held_words).collect()
    assert {(r.doc_id, r.item_id, r.matched) for r in found} == want


def test_alignments_of_repeated_words_in_chunks(monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 7)
    hashes = decontaminate.WordHashes()
    words = [hashes.of(w.split()) for w in ("a a a a a a a b", "b a a a a a", "c d e")]
    doc = hashes.of("x a a a a a a a a a b a a a a a c d e".split())
    held = decontaminate.HeldItems([1, 2, 3], words)
    want = {}
    for i, item in enumerate(words):
        for salt in decontaminate.kinds_of(len(item)):
            mask = decontaminate.KINDS[salt]
            for p in range(len(doc) - len(mask) + 1):
                for q in range(len(item) - len(mask) + 1):
                    if all(m == "0" or doc[p + k] == item[q + k] for k, m in enumerate(mask)):
                        want.setdefault(i, set()).add(p - q)
    assert held.alignments(doc) == {i: sorted(s) for i, s in want.items()}
    assert decontaminate.HeldItems([], []).alignments(doc) == {}


def test_pipeline_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert out.columns == [*docs.columns, "vslot", "shard"]
    rows = out.collect()
    assert 0 < len({r.doc_id for r in rows}) <= docs.count()
    assert all(0 <= r.shard < corpus_pipeline.SHARDS for r in rows)


@pytest.mark.parametrize("name", ["op6_licenses", "op10_exact_dedup"])
def test_query_agrees(spark, name):
    verdict, _, _ = compare(spark, oracle(SMALL), name, SMALL)
    assert verdict == "ok"


def test_driver_lists_all():
    names = driver.queries()
    assert [n for i in range(1, 11) for n in names if n.startswith(f"op{i}_")] and "pipeline" in names
