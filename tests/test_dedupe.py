"""Repeated and late lines in a growing directory."""

import datetime as dt
import os

import pytest

from martflow.streaming import dedupe
from martflow.streaming.dedupe import stage_deduplicated

SCHEMA = "id int, at timestamp_ntz, text string"
DAY = dt.datetime(2024, 5, 1)


def line(i, day, text="x"):
    return (i, None if day is None else DAY + dt.timedelta(days=day), text)


def deliver(spark, path, lines):
    spark.createDataFrame(lines, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def stage(spark, tmp_path):
    source, target, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))

    def run(lines=None, prune_from=0):
        if lines is not None:
            deliver(spark, source, lines)
        return stage_deduplicated(
            spark, source, "parquet", SCHEMA, target, progress, ["id"], "at", "3 days", ["text"], prune_from=prune_from
        )

    run.target = target
    return run


def counts(found):
    return [(r.staged, r.repeated, r.late) for r in found.batches.orderBy("batch").collect()]


def test_repeated_lines_are_staged_once(stage, rows):
    first = [line(1, 0), line(2, 1), line(2, 1, "a"), line(None, 1), line(None, 1)]
    found = stage(first)
    assert rows(found.rows) == rows_of([line(1, 0), line(2, 1, "a"), line(None, 1)])
    assert rows(stage().rows) == rows(found.rows)  # no new file
    found = stage([*first, line(3, 2), line(1, 2, "other time")])
    assert rows(found.rows) == rows_of([line(1, 0), line(2, 1, "a"), line(None, 1), line(3, 2), line(1, 2, "other time")])
    assert counts(found) == [(3, 2, 0), (2, 5, 0)]
    assert found.late.count() == 0


def rows_of(lines):
    return sorted(lines, key=lambda row: [(v is not None, str(type(v)), v if v is not None else 0) for v in row])


def test_late_lines_are_set_aside(stage, rows):
    stage([line(1, 0), line(2, 10)])
    late = [line(1, 0), line(9, 6), line(8, None)]
    found = stage([*late, line(3, 7), line(2, 10), line(4, 20)])
    assert rows(found.late) == rows_of(late)
    assert rows(found.rows) == rows_of([line(1, 0), line(2, 10), line(3, 7), line(4, 20)])
    assert counts(found) == [(2, 0, 0), (2, 1, 3)]
    marks = [r.watermark for r in found.batches.orderBy("batch").collect()]
    assert marks[0] is None and marks[1].startswith("2024-05-08")


def test_filters_change_no_row(stage, rows):
    stage([line(1, 0), line(2, 10)], prune_from=1 << 40)
    found = stage([line(1, 0), line(3, 7), line(2, 10), line(4, 20)], prune_from=1 << 40)
    assert counts(found) == [(2, 0, 0), (2, 1, 1)]


def test_what_is_remembered_is_bounded(stage):
    for day in range(0, 40, 8):
        stage([line(day, day), line(day + 1, day)])
    kept = [d for d in os.listdir(f"{stage.target}/seen") if d.startswith("batch=")]
    assert len(kept) <= 2
    found = stage([line(32, 32), line(99, 32)])
    assert counts(found)[-1] == (1, 1, 0)


@pytest.mark.parametrize("lost", ["rows", "seen", "batches"])
def test_a_replayed_batch_writes_the_same(stage, rows, monkeypatch, lost):
    stage([line(1, 0), line(2, 1)])
    write, failed = dedupe._write, []

    def failing(df, path, number):
        write(df, path, number)
        if number == 1 and path.endswith(lost) and not failed:
            failed.append(path)
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(dedupe, "_write", failing)
    with pytest.raises(Exception, match="lost after writing"):
        stage([line(2, 1), line(3, 2)])
    monkeypatch.undo()
    found = stage()
    assert failed and rows(found.rows) == rows_of([line(1, 0), line(2, 1), line(3, 2)])
    assert counts(found) == [(2, 0, 0), (1, 1, 0)]


def test_nothing(stage):
    found = stage([])
    assert found.rows.count() == found.late.count() == 0
