"""JSON written small, and in files that one task can read."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from martflow.sinks.writers import write_json
from martflow.sources.readers import read_json


def test_json_is_compressed_and_cut(spark, rows, tmp_path):
    lines = spark.range(1000, numPartitions=2).select("id", F.when(F.col("id") % 3 > 0, F.lit("a text with a \"\n")).alias("text"))
    write_json(lines, str(tmp_path / "log"), rows_per_file=300)
    files = list(Path(tmp_path / "log").glob("part-*"))
    assert all(f.name.endswith(".json.gz") for f in files)
    assert max(len(gzip.open(f, "rt").readlines()) for f in files) <= 300
    assert sum(f.stat().st_size for f in files) * 5 < sum(len(gzip.open(f).read()) for f in files)
    assert rows(read_json(spark, f"{tmp_path}/*/*.json.gz", "id long, text string")) == rows(lines)


def test_staged_trees_are_written_small(spark, tmp_path, monkeypatch):
    from martflow.queries import plans

    monkeypatch.setattr(plans, "scratch_path", lambda _, label: str(tmp_path / label))
    plans.star_dw_staged(spark, "/root/testdata/sf0.001").count()
    plans.star_lake_fact(spark, "/root/testdata/sf0.001").count()
    for root in ("warehouse", "lake"):
        for tree in ("song/A/B/C", "log/2018/11"):
            assert [f.suffix for f in (tmp_path / root / tree).glob("part-*")] == [".gz"]
