"""Checks made by the write itself."""

import pytest
from pyspark.sql import functions as F

from martflow.operators.quality import QualityError
from martflow.plans.load_run import run_load
from martflow.sinks.observed import Watch, count_difference, load_watched, watched_report

SCHEMA = "k int, v string, `odd name` string"
ROWS = [(1, "5", None), (2, " 7 ", "x"), (None, "y", None), (4, None, None)]


def test_rules_are_judged_by_the_write(spark, tmp_path, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    watch = Watch("t", ["k", "odd name"], {"v": "int"})
    load_watched(df.repartition(3), str(tmp_path / "t"), True, watch)
    assert rows(watched_report(spark, [watch])) == [
        ("t", "null k", 1, False), ("t", "null odd name", 3, False), ("t", "rows", 4, True), ("t", "unfit v", 1, False),
    ]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_an_empty_table(spark, tmp_path):
    none = spark.createDataFrame(ROWS, SCHEMA).where("k > 9")
    watches = [Watch("a", ["k"]), Watch("b", may_be_empty=True)]
    for watch in watches:
        load_watched(none, str(tmp_path / watch.name), True, watch)
    assert [w.lines()[0] for w in watches] == [("a", "rows", 0, False), ("b", "rows", 0, True)]


def test_a_watch_is_for_one_write(spark, tmp_path):
    df, watch = spark.range(3), Watch("t")
    with pytest.raises(ValueError, match="not written"):
        watch.lines()
    load_watched(df, str(tmp_path / "t"), True, watch)
    with pytest.raises(ValueError, match="already"):
        watch.on(df)


def test_rows_that_went_missing(spark, tmp_path, rows):
    source, target = Watch("staged"), Watch("kept")
    load_watched(spark.range(10), str(tmp_path / "a"), True, source)
    load_watched(spark.range(10).where("id % 3 > 0"), str(tmp_path / "b"), True, target)
    assert rows(count_difference(spark, source, target)) == [("kept", 10, 6, 4)]


def test_a_load_reads_no_table_again(spark, tmp_path):
    """One job per write, and one for the lines of the report: counts and null checks come with the writes."""
    staged = {"raw": spark.createDataFrame(ROWS, SCHEMA).drop("odd name")}
    fact = {"f": lambda t: t["raw"].where("v IS NOT NULL")}
    dimensions = {"d": lambda t: t["raw"].select("v"), "e": lambda t: t["f"].select("k")}
    spark.sparkContext.setJobGroup("watched", "")
    try:
        report = run_load(spark, str(tmp_path / "out"), staged, fact, dimensions, not_null={"f": ["v"]})
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("watched")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 4 + 1
    assert sorted(map(tuple, report.collect())) == [("d", 4, True), ("e", 3, True), ("f", 3, True)]


def test_a_null_stops_the_load(spark, tmp_path):
    staged = {"raw": spark.createDataFrame(ROWS, SCHEMA).drop("odd name")}
    with pytest.raises(QualityError, match="f"):
        run_load(spark, str(tmp_path / "out"), staged, {"f": lambda t: t["raw"]}, {}, not_null={"f": ["k"]})


def test_added_rows_count_with_those_before(spark, tmp_path):
    staged = {"raw": spark.range(5)}
    fact = {"f": lambda t: t["raw"].where(F.col("id") < 3)}
    for total in (3, 6):
        report = run_load(spark, str(tmp_path / "out"), staged, fact, {}, truncate=False)
        assert report.first().row_count == total
