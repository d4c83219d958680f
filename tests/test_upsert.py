"""Keyed loads against a row-by-row replay in plain Python."""

import random

import pytest

from martflow.operators.aggregates import one_row_per_key
from martflow.operators.upsert import (
    absent_rows,
    reduce_updates,
    upsert_columns,
    upsert_do_nothing,
    upsert_rows,
)

SCHEMA = "k int, seq int, name string, level string"


def some_rows(seed, n=200):
    rng = random.Random(seed)
    return [
        (rng.randrange(40), i, rng.choice(["a", "b", None]), rng.choice(["free", "paid", None]))
        for i in range(n)
    ]


def replay(rows, policy):
    table = {}
    for k, seq, name, level in sorted(rows, key=lambda r: r[1]):
        if policy == "nothing":
            table.setdefault(k, (k, seq, name, level))
        elif policy == "rows":
            table[k] = (k, seq, name, level)
        else:
            first = table.get(k, (k, name, None))
            table[k] = (k, first[1], level)
    return sorted(table.values(), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_a_replay(spark, seed):
    data = some_rows(seed)
    empty = spark.createDataFrame([], SCHEMA)
    absent = rows_ = empty
    columns = spark.createDataFrame([], "k int, name string, level string")
    for cut in (data[:50], data[50:120], data[120:]):
        shuffled = random.Random(seed).sample(cut, len(cut))
        batch = spark.createDataFrame(shuffled, SCHEMA).repartition(3)
        absent = upsert_do_nothing(absent, batch, ["k"], ["seq"])
        rows_ = upsert_rows(rows_, batch, ["k"], ["seq"])
        columns = upsert_columns(columns, batch, ["k"], ["level"], ["seq"])
    assert got(absent) == replay(data, "nothing")
    assert got(rows_) == replay(data, "rows")
    assert got(columns) == replay(data, "columns")


def test_applying_twice_changes_nothing(spark):
    first, second = some_rows(7)[:100], some_rows(7)[100:]
    target = one_row_per_key(spark.createDataFrame(first, SCHEMA), ["k"], ["seq"])
    batch = spark.createDataFrame(second, SCHEMA)
    for upsert in (upsert_do_nothing, upsert_rows):
        once = upsert(target, batch, ["k"], ["seq"])
        assert got(upsert(once, batch, ["k"], ["seq"])) == got(once)
    reduced = reduce_updates(spark.createDataFrame(first, SCHEMA), ["k"], ["level"], ["seq"])
    once = upsert_columns(reduced, batch, ["k"], ["level"], ["seq"])
    assert got(upsert_columns(once, batch, ["k"], ["level"], ["seq"])) == got(once)


def test_absent_rows_are_only_the_new_ones(spark):
    target = spark.createDataFrame([(1, 0, "a", "free")], SCHEMA)
    batch = spark.createDataFrame([(1, 1, "x", "paid"), (2, 3, "late", "paid"), (2, 2, "early", "free")], SCHEMA)
    assert got(absent_rows(target, batch, ["k"], ["seq"])) == [(2, 2, "early", "free")]


def test_an_update_to_null_is_an_update(spark):
    target = spark.createDataFrame([(1, "a", "free")], "k int, name string, level string")
    batch = spark.createDataFrame([(1, 1, "b", None)], SCHEMA)
    assert got(upsert_columns(target, batch, ["k"], ["level"], ["seq"])) == [(1, "a", None)]


def test_ties_do_not_depend_on_partitioning(spark):
    data = [(1, 0, str(i % 17), "free") for i in range(200)]
    df = spark.createDataFrame(data, SCHEMA)
    answers = {tuple(got(one_row_per_key(df.repartition(n), ["k"], ["seq"]))) for n in (1, 3, 8)}
    assert answers == {((1, 0, "9", "free"),)}
