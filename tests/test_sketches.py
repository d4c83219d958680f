"""Profiles of sketches against exact ones."""

import math
import random

import pytest

from martflow.operators.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    merge_profiles,
    rank_errors,
    read_profile,
    sketch_profile,
)

SCHEMA = "day int, v double, n int, none string"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    rows = []
    for i in range(30_000):
        v = rng.choice([None, float("nan"), 7.0]) if rng.random() < 0.3 else rng.lognormvariate(0, 2)
        rows.append((min(5, int(rng.expovariate(0.9))), v, i % 997, None))
    return rows


def test_merged_days_tell_what_one_pass_tells(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    columns = ["v", "n", "none"]
    days = sketch_profile(df, columns, ["day"])
    merged = {r.column_name: r.asDict() for r in read_profile(merge_profiles(days)).collect()}
    whole = {r.column_name: r.asDict() for r in read_profile(sketch_profile(df, columns)).collect()}
    for name in columns:
        for part in ("count", "nulls", "min", "max", "distinct"):
            assert merged[name][part] == whole[name][part]
    values = sorted(r[1] for r in data if r[1] is not None and not math.isnan(r[1]))
    assert merged["v"]["count"] == len(values) and merged["v"]["nulls"] == len(data) - len(values)
    assert math.isclose(merged["v"]["mean"], sum(values) / len(values))
    assert (merged["v"]["min"], merged["v"]["max"]) == (values[0], values[-1])
    assert abs(merged["v"]["distinct"] / len(set(values)) - 1) <= DISTINCT_ERROR
    assert abs(merged["n"]["distinct"] / 997 - 1) <= DISTINCT_ERROR
    assert merged["none"]["count"] == merged["none"]["distinct"] == 0 and merged["none"]["p50"] is None
    errors = rank_errors(df, columns, read_profile(merge_profiles(days))).collect()
    assert {r.column_name for r in errors} == {"v", "n"}
    assert max(max(r.p25_error, r.p50_error, r.p75_error) for r in errors) <= 2 * RANK_ERROR


def test_a_span_of_days(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    some = sketch_profile(df, ["v"], ["day"]).where("day IN (1, 2)")
    row = read_profile(merge_profiles(some)).first()
    values = sorted(r[1] for r in data if r[0] in (1, 2) and r[1] is not None and not math.isnan(r[1]))
    assert (row["count"], row["min"], row["max"]) == (len(values), values[0], values[-1])
    by_day = read_profile(merge_profiles(some, ["day"]), ["day"]).collect()
    assert sorted(r.day for r in by_day) == [1, 2] and sum(r["count"] for r in by_day) == len(values)


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sketch_profile(none, ["v"], ["day"]).count() == 0
    assert merge_profiles(sketch_profile(none, ["v"], ["day"])).count() == 0


def test_days_are_combined_before_the_shuffle(spark, data, capsys):
    capsys.readouterr()
    sketch_profile(spark.createDataFrame(data, SCHEMA), ["v", "n"], ["day"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 1 and "partial_kll" in plan
