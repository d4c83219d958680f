"""Texts are read for personal data where they lie."""

from martflow.llm import pii


def test_texts_are_not_joined(documents, monkeypatch, capsys):
    rows = [(i, f"write to ann{i % 4}@shop.org about nebula{i % 4} or call", "en", "s") for i in range(60)]
    rows += [(100 + i, f"write to one{i}@else.net about call") for i in range(60)] + [(200, None), (None, "x")]
    seen, map_batches = [], pii.map_batches

    def spied(frame, make, schema):
        if "text" in frame.columns:
            frame.explain()
            seen.append(capsys.readouterr().out)
        return map_batches(frame, make, schema)

    monkeypatch.setattr(pii, "map_batches", spied)
    found = {r.id: r.spans for r in pii.findings(documents(rows)).collect()}
    assert len(seen) >= 4 and not any("Join" in plan or "Exchange" in plan for plan in seen)
    term = pii.KINDS.index("term")
    for i in range(60):
        text = rows[i][1]
        assert [text[s.start : s.end] for s in found[i] if s.rank == term] == ["nebula", "or"]
        assert all(s.rank != term for s in found[100 + i])
