"""Exact deduplication, sharding and mixing."""

import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from check import compare
from martflow.llm import exact_dedup, licenses, mixing, sharding
from llm.conftest import AWKWARD


def dedup_by_hand(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(fold)].append(r[0])
    want = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        want += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(want, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t).cast("string")])
def test_dedup_compares_whole_texts(documents, digest):
    rows = AWKWARD + [(20 + i, "copy") for i in range(40)] + [(90, "cope"), (91, "Copy")]
    found = exact_dedup.exact_dedup(documents(rows), digest=digest).drop("digest").collect()
    assert sorted(map(tuple, found), key=str) == dedup_by_hand(rows)


def test_dedup_of_nothing(documents):
    assert exact_dedup.exact_dedup(documents([])).count() == 0


def test_dedup_is_native(documents, capsys):
    exact_dedup.exact_dedup(documents(AWKWARD)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_drop_copies_keeps_columns(documents):
    docs = documents([(1, "a"), (2, "A"), (3, "b")]).withColumn("keep_id", F.lit("mine"))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_copies_are_rows_not_ids(documents):
    """No text is lost with its id, and rows without an id are copies like others."""
    rows = [(5, "a"), (5, "b only here"), (9, "A"), (None, "copy"), (None, "COPY"), (None, "copy"), (3, "x"), (3, "X"), (None, None), (2, "")]
    kept = sorted(((r.doc_id, (r.text or "").lower()) for r in exact_dedup.drop_copies(documents(rows)).collect()), key=str)
    assert kept == sorted([(5, "b only here"), (9, "a"), (None, "copy"), (3, "x"), (2, "")], key=str)
    assert exact_dedup.drop_copies(documents([])).count() == 0


def test_shards_are_even_and_gapless(prepared):
    docs = prepared.read.parquet(f"{SMALL}/documents.parquet")
    found = sharding.shard_positions(docs, 6).collect()
    loads = Counter()
    slots = defaultdict(list)
    for r in found:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(loads.values()) - min(loads.values()) < 0.02 * max(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.size == len(text[r.doc_id].encode()) + 8 for r in found)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in found)


def test_shards_of_awkward_rows(documents):
    docs = documents(AWKWARD).withColumn("shard", F.lit(9))
    out = sharding.sharded(docs, 4)
    assert sorted(out.columns) == sorted([*docs.columns, "vslot"])
    assert out.count() == len(AWKWARD) and out.filter("shard not between 0 and 3").count() == 0
    assert sharding.shard_positions(documents([]), 4).count() == 0


def test_long_documents_keep_a_shard_when_the_layout_changes(prepared, documents, monkeypatch):
    """The second pass over the input finds its rows in other partitions than the first."""
    rows = [(i, "long " * 5000 if i % 40 == 0 else f"short {i}") for i in range(400)]
    before = {k: prepared.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    balanced = sharding.balanced_map

    def then_dealt_anew(*args):
        made = balanced(*args)
        prepared.conf.set("spark.sql.shuffle.partitions", "3")
        return made

    monkeypatch.setattr(sharding, "balanced_map", then_dealt_anew)
    try:
        prepared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = sharding.sharded(documents(rows).repartition("doc_id"), 4).collect()
    finally:
        for k, v in before.items():
            prepared.conf.set(k, v)
    assert sorted(r.doc_id for r in out) == list(range(400))
    assert [r.doc_id for r in out if r.shard is None] == []
    loads = Counter()
    for r in out:
        loads[r.shard] += len(r.text) + sharding.OVERHEAD
    assert max(loads.values()) - min(loads.values()) <= 25_008


def test_pieces_without_a_map_row_keep_a_shard(prepared):
    held = prepared.createDataFrame([(1, 0, -1, 3), (1, 1, 2, 1), (1, 1, 5, 2)], sharding.MAP_SCHEMA)
    rows = prepared.createDataFrame([(0, 7), (1, 2), (1, 5), (1, 9)], "vslot int, piece int")
    found = {(r.vslot, r.piece): r.shard for r in sharding.with_shard(rows, held).collect()}
    assert found == {(0, 7): 3, (1, 2): 1, (1, 5): 2, (1, 9): 1}


def test_rebalancing_edits_the_map():
    sizes = {(s, 0): (100 + s % 7, 1) for s in range(200)} | {(5, 1): (5000, 50), (5, 2): (5000, 50)}
    first = sharding.first_map(4, 200)
    held = sharding.rebalanced(first, sizes, 4)
    load = Counter()
    for (slot, piece), shard in held.items():
        load[shard] += sum(b for (s, p), (b, _) in sizes.items() if s == slot and piece in (p, sharding.WHOLE))
    assert max(load.values()) - min(load.values()) < 120
    more = sharding.rebalanced(held, sizes, 5)
    moved = [u for u in held if held[u] != more[u]]
    assert len(moved) < 0.4 * len(held)


def targets_by_hand(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixture_meets_targets(prepared):
    docs = prepared.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("source") != "src3", F.col("source")))
    found = mixing.mixture(docs).collect()
    again = mixing.mixture(docs.repartition(5)).collect()
    key = lambda rows: sorted((r.doc_id, r.taken, r.positions) for r in rows)
    assert key(found) == key(again)
    sizes, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in found:
        assert r.taken <= 2 * r.size and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    want = targets_by_hand(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= largest[s]


def test_position_inverts_the_schedule(prepared):
    knots = ((0.0, 0.5), (0.6, 1.0), (1.0, 2.0))
    shares = [i / 10 for i in range(11)]
    rows = prepared.createDataFrame([(s,) for s in shares], "q double")
    got = [r.p for r in rows.select(mixing.position(F.col("q"), knots).alias("p")).collect()]

    def used(t):
        steps = 20_000
        height = lambda x: 0.5 + 0.5 * x / 0.6 if x < 0.6 else 1 + (x - 0.6) / 0.4
        return sum(height((i + 0.5) * t / steps) for i in range(steps)) * t / steps

    whole = used(1.0)
    assert [used(p) / whole for p in got] == pytest.approx(shares, abs=1e-4)


def test_curriculum_of_awkward_rows(documents):
    docs = documents(AWKWARD).withColumn("position", F.lit("mine"))
    out = mixing.curriculum(docs)
    assert out.columns == docs.columns
    rows = [r.position for r in out.collect()]
    assert rows == sorted(rows)
    assert mixing.mixture(documents([])).count() == 0


def test_licences_by_canonical_text(prepared, documents, capsys):
    isc = licenses.KNOWN["ISC"]
    rows = [
        (50, isc), (51, "Copyright (c) 2020 A. Person\n\n" + isc.upper().replace(". ", ".\n")),
        (52, "LICENCED... under: CC-BY 4.0"), (53, isc + " And more."),
    ]
    docs = documents(rows + AWKWARD).withColumn("license", F.lit("mine"))
    out = licenses.scan(docs, licenses.known_digests(prepared))
    found = {r.doc_id: r.license for r in out.collect()}
    assert (found[50], found[51], found[53], found[1]) == ("ISC", "ISC", None, None)
    assert found[52] == "CC-BY-4.0 notice"
    assert out.count() == len(rows) + len(AWKWARD)
    assert licenses.scan(documents([]), licenses.known_digests(prepared)).count() == 0
    out.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_every_known_licence_in_several_spellings(prepared, documents):
    rows, want = [], []
    for name, body in sorted(licenses.KNOWN.items()):
        plain = body.strip("\r\n")
        heads = ["", "Copyright Jane Doe 2020\n", "(c) 2020 X\n\n", "© 2020 X\r\n", " * Copyright © 2019-2020, X. All rights reserved.\n"]
        heads += ["The MIT License (MIT)\n\nCopyright 2020 X and others\n(C) Y\n", 'BSD 2-Clause "Simplified" License\n\n(c) Z 2020\n']
        spelt = [h + plain for h in heads] + [plain.upper(), plain.replace("\n", "\r\n"), "\n".join("// " + x for x in plain.split("\n"))]
        for text in spelt:
            rows.append((len(rows), text))
            want.append(name)
    for text in (licenses.KNOWN["MIT"] + "and more", "The MIT License\n", "Copyright law\n" + licenses.KNOWN["ISC"]):
        rows.append((len(rows), text))
        want.append(None)
    bsd = licenses.KNOWN["BSD-3-Clause"].replace("of the copyright holder", "of Acme, Inc.").replace(" * Neither", " 3. Neither")
    gpl = licenses.KNOWN["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301", "59 Temple Place, Suite 330, Boston, MA  02111-1307")
    for text, name in ((bsd, "BSD-3-Clause"), (gpl, "GPL-2.0"), (gpl[: gpl.index("How to Apply")].strip(), "GPL-2.0")):
        rows.append((len(rows), text))
        want.append(name)
    found = {r.doc_id: r.license for r in licenses.scan(documents(rows), licenses.known_digests(prepared)).collect()}
    assert [(want[i], rows[i][1][:80]) for i in range(len(rows)) if found[i] != want[i]][:5] == []


def test_known_texts_agree_with_sql(prepared, documents, tmp_path):
    """Every known text, whole and without what follows its terms, in spellings that SQL can state."""
    rows = []
    for name, body in licenses.bodies():
        spelt = [body, body.upper(), body.replace(",", " ;"), "Copyright (c) 2020 X\n" + body, body.replace("license", "licence"), body + " more"]
        rows += [(len(rows) + i, text) for i, text in enumerate(spelt)]
    rows += [(name, text) for name, text, *_ in AWKWARD if name is not None]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    verdict, n, _ = compare(prepared, con, "op6_licenses", str(tmp_path))
    assert (verdict, n) == ("ok", len(rows))
    names = {r.license for r in licenses.scan(documents(rows), licenses.known_digests(prepared)).collect()}
    assert names == {*licenses.KNOWN, None}


def test_stems_leave_out_no_licence(prepared, documents):
    assert all(any(stem in body.lower() for stem in licenses.STEMS) for _, body in licenses.bodies())
    docs = documents([(i, body) for i, (_, body) in enumerate(licenses.bodies())] + [(99, "no such word"), (98, None)])
    known = licenses.known_digests(prepared)
    by_stem, all_folded = licenses.scan(docs, known).collect(), licenses.scan(docs, known, stems=()).collect()
    assert {(r.doc_id, r.digest, r.license) for r in by_stem} == {(r.doc_id, r.digest, r.license) for r in all_folded}
    assert sorted(r.doc_id for r in by_stem if r.folded_digest is None) == [98, 99]
    assert all(r.folded_digest for r in all_folded)
