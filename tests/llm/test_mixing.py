"""The order in which a mix is read."""

from pyspark.sql import functions as F

from martflow.llm import mixing
from llm.conftest import AWKWARD


def test_mixture_is_sorted_by_range(prepared, documents):
    rows = [(100 + i, "w " * (1 + i % 7), "en", "abc"[i % 3]) for i in range(300)]
    docs = documents(rows + AWKWARD)
    found = mixing.mixture(docs).collect()
    assert len(found) == len(rows) + len(AWKWARD)
    copies = sorted((place, p, r.doc_id) for r in found for place, p in zip(r.places, r.positions, strict=True))
    assert all(len(r.places) == r.copies and r.taken == r.copies * r.size for r in found)
    assert [place for place, *_ in copies] == list(range(sum(r.copies for r in found)))
    assert [p for _, p, _ in copies] == sorted(p for _, p, _ in copies)

    def read(rows):
        return sorted((r.doc_id or 0, r.size, r.places) for r in rows)

    assert read(found) == read(mixing.mixture(docs.repartition(5)).collect())
    # The run reads the documents at the same places.
    whole = mixing.curriculum(docs.filter(F.col("doc_id") >= 100)).select("doc_id", "position").collect()
    alone = mixing.mixture(docs.filter(F.col("doc_id") >= 100)).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in alone for _ in r.places)
    assert [r.position for r in whole] == [p for _, p in sorted((n, p) for r in alone for n, p in zip(r.places, r.positions, strict=True))]
