import pytest
from pyspark.sql import functions as F

from martflow.operators import quality


def test_gate_raises_and_names_the_table(spark):
    good = quality.nonempty_report({"full": spark.range(3)})
    quality.enforce(good)
    bad = quality.nonempty_report({"full": spark.range(3), "void": spark.range(0)})
    with pytest.raises(quality.QualityError, match="void"):
        quality.enforce(bad)
    with pytest.raises(ValueError):
        quality.enforce(bad)


def test_null_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(quality.null_counts(df)) == [("a", 1), ("b", 2)]


def test_cast_rejects_ignore_nulls(spark, rows):
    df = spark.createDataFrame([("1", "2000-01-01"), (" 2 ", None), ("x", "2000-13-01"), ("", "")], "n string, d string")
    assert rows(quality.cast_rejects(df, {"n": "int", "d": "date"})) == [("d", 2), ("n", 2)]


def test_column_types(spark, rows):
    assert rows(quality.column_types(spark.range(1).select("id", F.lit("x").alias("s")))) == [("id", "bigint"), ("s", "string")]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (2, None)], "a int, b int")
    assert tuple(quality.key_violations(df, ["a", "b"]).first()) == (1, 2, 3)
    assert tuple(quality.key_violations(spark.range(3), ["id"]).first()) == (0, 0, 0)


def test_orphans_count_rows_and_ignore_nulls(spark, rows):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "parent int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(quality.orphans(child, "parent", parent, "id")) == [(7, 2)]


def test_not_null_report(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(quality.not_null_violations({"t": (df, ["a", "b"])})) == [("t", "a", 0, True), ("t", "b", 1, False)]


def test_source_target_counts(spark, rows):
    got = quality.source_target_counts({"t": (spark.range(5), spark.range(3)), "u": (spark.range(0), spark.range(0))})
    assert rows(got) == [("t", 5, 3, 2), ("u", 0, 0, 0)]
