import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.operators import aggregates as agg
from martflow.operators import combine
from martflow.operators import quality


def test_null_group_counts_zero(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "c string")
    assert rows(agg.group_counts(df, "c", "n")) == [(None, 0), ("a", 2)]


def test_top_groups_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "c string")
    top = [tuple(r) for r in agg.top_groups(df, "c", "n", 2).collect()]
    assert top == [("a", 2), ("b", 2)]


def test_top_groups_does_not_sort_everything(spark, capsys):
    agg.top_groups(spark.range(10).toDF("c"), "c", "n", 2).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_mean_of_text_skips_bad_text(spark, rows):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "x"), ("b", None)], "k string, v string")
    assert rows(agg.group_mean(df, ["k"], "v", "m")) == [("a", 1.5), ("b", None)]


def test_first_values_come_from_one_row(spark, rows):
    df = spark.createDataFrame([("k", 1, "b", "y"), ("k", 1, "a", "z"), ("k", 2, "0", "0")], "k string, t int, p string, q string")
    for n in (1, 4):
        assert rows(agg.first_per_group(df.repartition(n), ["k"], ["p", "q"], ["t"])) == [("k", "a", "z")]
        assert rows(agg.mean_and_first(df.repartition(n), ["k"], "t", "m", ["q"], ["p"])) == [("k", 4 / 3, "0")]


def test_pivot_before_rollup_counts_a_city_once(spark, rows):
    lines = spark.createDataFrame(
        [("x", "S", "10", "A", 1), ("x", "S", "10", "B", 2), ("y", "S", "5", "A", 4)],
        "city string, state string, people string, race string, n int",
    )
    city = agg.pivot_first(lines, ["city", "state", "people"], "race", "n", {"A": "a", "B": "b"})
    state = agg.mixed_measures(city, ["state"], {}, {"people": "people", "a": "a", "b": "b"})
    assert rows(state) == [("S", 15.0, 5.0, 2.0)]


def test_distinct_is_over_all_columns(spark):
    df = spark.createDataFrame([(1, "free"), (1, "paid"), (1, "free")], "u int, level string")
    assert agg.distinct_rows(df).count() == 2
    assert agg.distinct_rows(df, ["u"]).count() == 1


def test_distinct_values_of_two_columns(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, None), (None, 3)], "a int, b int")
    assert rows(combine.distinct_values(df, ["a", "b"], "v")) == [(1,), (2,), (3,)]


def test_distinct_values_scans_once(spark, tmp_path, capsys):
    spark.range(10).selectExpr("id AS a", "id + 1 AS b").write.parquet(str(tmp_path / "t"))
    combine.distinct_values(spark.read.parquet(str(tmp_path / "t")), ["a", "b"], "v").explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_in_order_numbers_rows_of_the_key(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (2, 9), (1, 2)], "s int, item int")
    got = combine.in_order(df, F.col("s") == 1, ["item"], "place").collect()
    assert sorted((r["place"], r["item"]) for r in got) == [(0, 1), (1, 2), (2, 3)]


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_exact_quartiles(spark, n):
    rng = random.Random(n)
    values = [rng.choice([0.5, 7.0, rng.random() * 100]) for _ in range(n)]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)] + [(None, None)], "a double, b double")
    summary = {r["column_name"]: r for r in quality.numeric_summary(df, ["a", "b"]).collect()}
    for name, data in (("a", values), ("b", [float(i) for i in range(n)])):
        row = summary[name]
        assert row["count"] == n
        got = [row["p25"], row["p50"], row["p75"]]
        assert got == pytest.approx(list(np.percentile(data, [25, 50, 75])))
        assert (row["min"], row["max"]) == (min(data), max(data))
