import os
import uuid

from martflow.operators.upsert import upsert_columns, upsert_rows
from martflow.sinks.tables import create_table
from martflow.streaming.incremental import (
    merge_partitions_incrementally,
    run_available,
    stage_incrementally,
    upsert_incrementally,
)

SCHEMA = "id int, seq int, level string"


def deliver(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(path)


def test_each_file_is_staged_once(spark, tmp_path, rows):
    source, target, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    first, second = [(1, 1, "free"), (2, 2, "paid")], [(3, 3, "free")]
    deliver(spark, source, first)
    stage = lambda: stage_incrementally(spark, source, "json", SCHEMA, target, progress)
    assert rows(stage()) == first
    assert rows(stage()) == first
    deliver(spark, source, second)
    assert rows(stage()) == first + second


def test_one_file_per_batch_gives_the_same_rows(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    for i in range(4):
        deliver(spark, source, [(i, i, "free")])
    staged = stage_incrementally(
        spark, source, "json", SCHEMA, str(tmp_path / "out"), str(tmp_path / "progress"), files_per_batch=1
    )
    assert rows(staged) == [(i, i, "free") for i in range(4)]


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    """A failure after the write hands the batch over again under its number."""
    source, target, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    deliver(spark, source, [(1, 1, "free")])
    seen = []

    def fail_once(batch, number):
        seen.append(number)
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        if len(seen) == 1:
            raise RuntimeError("lost after writing")

    try:
        run_available(spark, source, "json", SCHEMA, progress, fail_once)
    except Exception as error:
        assert "lost after writing" in str(error)
    run_available(spark, source, "json", SCHEMA, progress, fail_once)
    assert seen == [0, 0]
    assert spark.read.parquet(target).count() == 1


def test_upsert_by_batches(spark, tmp_path, rows):
    source, table = str(tmp_path / "in"), f"users_{uuid.uuid4().hex}"
    create_table(spark, table, "id int, level string", str(tmp_path / "empty"))

    def merge(target, incoming):
        return upsert_columns(target, incoming, ["id"], ["level"], ["seq"])

    def run():
        return upsert_incrementally(
            spark, source, "json", SCHEMA, table, str(tmp_path / "versions"), str(tmp_path / "progress"), merge,
            files_per_batch=1,
        )

    deliver(spark, source, [(1, 1, "free"), (2, 2, "free")])
    assert rows(run()) == [(1, "free"), (2, "free")]
    deliver(spark, source, [(1, 3, "paid")])
    deliver(spark, source, [(3, 4, "free")])
    assert rows(run()) == [(1, "paid"), (2, "free"), (3, "free")]
    assert rows(run()) == [(1, "paid"), (2, "free"), (3, "free")]
    # The current version and the one before it are left.
    assert sorted(os.listdir(tmp_path / "versions")) == ["batch-1-a", "batch-2-a"]


def test_partitions_not_touched_keep_their_files(spark, tmp_path, rows):
    source, path = str(tmp_path / "in"), tmp_path / "by-level"

    def run():
        return merge_partitions_incrementally(
            spark, source, "json", SCHEMA, str(path), SCHEMA, ["level"], str(tmp_path / "progress"),
            lambda batch: batch, lambda t, n: upsert_rows(t, n, ["id", "level"], ["seq"]), files_per_batch=1,
        )

    deliver(spark, source, [(1, 1, "free"), (2, 2, "paid")])
    assert rows(run()) == [(1, 1, "free"), (2, 2, "paid")]
    before = sorted(os.listdir(path / "level=paid"))
    deliver(spark, source, [(1, 3, "free"), (5, 4, "new")])
    for _ in range(2):
        assert rows(run()) == [(1, 3, "free"), (2, 2, "paid"), (5, 4, "new")]
    assert sorted(os.listdir(path / "level=paid")) == before
