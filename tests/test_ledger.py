"""Staging by logical date with a ledger."""

import json
import os
from datetime import date

import pytest

from martflow.sources import ledger
from martflow.sources.ledger import current_versions, read_staged, stage_run

SCHEMA = "id int, text string"
DAYS = [date(2024, 5, d) for d in (1, 2, 3)]


@pytest.fixture
def box(spark, tmp_path):
    class Box:
        target = str(tmp_path / "staged")

        def put(self, day, name, ids, text="x"):
            folder = tmp_path / "in" / f"{day:%Y/%m/%d}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_text("".join(json.dumps({"id": i, "text": text}) + "\n" for i in ids))
            return folder / name

        def run(self, day):
            template = f"{tmp_path}/in/{{day:%Y/%m/%d}}/*.json"
            return stage_run(spark, template, day, spark.read.schema(SCHEMA).json, self.target)

        def rows(self):
            return sorted(map(tuple, read_staged(spark, self.target, SCHEMA).collect()), key=str)

    return Box()


def test_any_order_any_number_of_times(box):
    assert box.rows() == []
    for i, day in enumerate(DAYS):
        box.put(day, "a.json", [10 * i, 10 * i + 1])
    assert [box.run(d) for d in (DAYS[2], DAYS[0], DAYS[2], DAYS[0])] == [1, 1, 0, 0]
    assert {r[2] for r in box.rows()} == {DAYS[0], DAYS[2]}
    box.put(DAYS[0], "late file.json", [5, 5])
    assert [box.run(DAYS[0]), box.run(DAYS[1]), box.run(DAYS[1])] == [1, 1, 0]
    assert [r[0] for r in box.rows()] == sorted([0, 1, 5, 5, 10, 11, 20, 21], key=str)
    assert box.run(date(2031, 1, 1)) == 0  # a date without files


def test_a_crashed_run_leaves_nothing(box, monkeypatch):
    box.put(DAYS[0], "a.json", [1, 2])
    box.put(DAYS[1], "a.json", [3])
    box.run(DAYS[1])

    class Crash(Exception):
        pass

    def crash(*args):
        raise Crash

    with monkeypatch.context() as patched:  # after the rows were written, before the ledger's line
        patched.setattr(ledger.F, "current_timestamp", crash)
        with pytest.raises(Crash):
            box.run(DAYS[0])
    assert len([d for d in os.listdir(f"{box.target}/rows") if d.startswith("load=")]) == 2
    assert [r[0] for r in box.rows()] == [3]
    assert box.run(DAYS[0]) == 1
    assert [r[0] for r in box.rows()] == [1, 2, 3]
    assert box.run(DAYS[0]) == 0


def test_a_file_delivered_anew_replaces_its_rows(box, spark):
    box.put(DAYS[0], "a.json", [1, 2])
    box.put(DAYS[0], "b.json", [3])
    assert box.run(DAYS[0]) == 2
    path = box.put(DAYS[0], "a.json", [2, 4], "a longer text")
    os.utime(path, (path.stat().st_atime, path.stat().st_mtime + 5))
    assert box.run(DAYS[0]) == 1
    assert box.rows() == sorted([(2, "a longer text", DAYS[0]), (3, "x", DAYS[0]), (4, "a longer text", DAYS[0])], key=str)
    assert current_versions(ledger.ledger(spark, box.target)).count() == 2
    assert box.run(DAYS[0]) == 0
