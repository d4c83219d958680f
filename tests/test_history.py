"""Histories and as-of joins against a plain replay."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martflow.operators import history
from martflow.operators.history import as_of, time_buckets, versions
from martflow.plans import star_history
from martflow.schemas import STAGED_LOG

SCHEMA = "k string, at timestamp_ntz, seq int, level string, city string"
START = dt.datetime(2024, 2, 28, 23)


def some_rows(seed, n=300, hot=0.4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        at = None if rng.random() < 0.03 else START + dt.timedelta(seconds=int(rng.random() ** 3 * 400) * 30)
        rows.append((k, at, i, rng.choice(["free", "paid", None]), rng.choice(["x", "x", "x", None])))
    return rows


def order(value):
    return (value is not None, value or "")


def replay(rows):
    """(key, level, city, from, to) by walking each key's moments."""
    moments = defaultdict(dict)
    for k, at, seq, level, city in sorted(rows, key=lambda r: r[2]):
        if k is not None and at is not None:
            moments[k][at] = (level, city)
    out = []
    for k, seen in moments.items():
        runs = []
        for at in sorted(seen):
            if not runs or runs[-1][1] != seen[at]:
                runs.append((at, seen[at]))
        ends = [at for at, _ in runs[1:]] + [None]
        out += [(k, *of, at, to) for (at, of), to in zip(runs, ends)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("buckets", [None, 1, 2, 7, 300])
def test_versions_equal_a_replay(spark, buckets):
    for seed in range(3):
        rows = some_rows(seed)
        found = versions(spark.createDataFrame(rows, SCHEMA), ["k"], "at", ["level", "city"], ["seq"], buckets)
        assert found.columns == ["k", "level", "city", "valid_from", "valid_to", "is_current"]
        assert got(found.drop("is_current")) == replay(rows)
        assert found.where(F.col("is_current") != F.col("valid_to").isNull()).isEmpty()


@pytest.mark.parametrize("buckets", [None, 1, 5, 300])
def test_as_of_equals_a_search(spark, buckets):
    known = replay(some_rows(4))
    dims = spark.createDataFrame(known, "k string, level string, city string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = [(k, at, i, "mine") for i, (k, at, *_) in enumerate(some_rows(5) + some_rows(4)[:50])]
    facts += [("new", START, -1, "mine"), ("a", START - dt.timedelta(days=9), -2, "mine"), ("a", START + dt.timedelta(days=99), -3, "mine")]
    facts += facts[:3]
    want = []
    for k, at, i, city in facts:
        fits = [v for v in known if at is not None and v[0] == k and v[3] <= at]
        last = max(fits, key=lambda v: v[3], default=(None,) * 5)
        want.append((k, at, i, city, last[1], last[3]))
    table = spark.createDataFrame(facts, "k string, at timestamp_ntz, seq int, city string")
    assert got(as_of(table, dims, ["k"], "at", ["level", "valid_from"], buckets=buckets)) == sorted(want, key=str)


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    dims = versions(none, ["k"], "at", ["level"])
    assert dims.count() == 0
    assert as_of(none, dims, ["k"], "at", ["level"]).count() == 0
    rows = spark.createDataFrame(some_rows(6, 20), SCHEMA).drop("level")
    assert {r.level for r in as_of(rows, dims, ["k"], "at", ["level"]).collect()} == {None}


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "bigint", "decimal(12,2)"])
def test_buckets_grow_with_time_and_are_even(spark, kind):
    rng = random.Random(7)
    days = sorted(int(rng.random() ** 4 * 3000) for _ in range(4000))
    number = spark.createDataFrame([(d,) for d in days], "d int").withColumn("n", F.monotonically_increasing_id())
    at = F.col("d").cast(kind) if kind in ("bigint", "decimal(12,2)") else F.date_add(F.lit("1965-01-01").cast("date"), F.col("d")).cast(kind)
    rows = number.select("d", at.alias("at"))
    bucket = time_buckets(rows, "at", 8)
    found = rows.select("d", bucket(F.col("at")).alias("b")).orderBy("d").collect()
    assert [r.b for r in found] == sorted(r.b for r in found)
    sizes, ties = Counter(r.b for r in found), max(Counter(days).values())
    assert len(sizes) > 4 and max(sizes.values()) <= 4000 / 8 + 2 * ties + 200


def test_no_window_holds_all_rows_of_a_key(spark, capsys):
    """Only rows that stand for a whole bucket are ordered by key alone."""
    rows = spark.createDataFrame([("hot", START + dt.timedelta(seconds=i), i, str(i % 7), "x") for i in range(2000)], SCHEMA)
    dims = versions(rows, ["k"], "at", ["level"], ["seq"], 20)
    assert dims.count() == 2000
    capsys.readouterr()
    as_of(rows.drop("level"), dims, ["k"], "at", ["level"], buckets=20).explain()
    plan = capsys.readouterr().out
    for window in re.findall(r"Window \[(.*)windowspecdefinition\((.*)", plan):
        partition = re.split(r"_bucket#\d+ ASC|\(_order#\d+ > 0\) ASC", window[1])[0]
        # What is ordered by key alone is one row per key and bucket.
        assert "_bucket#" in partition or "_last" in window[0]


def test_plan_names_users_by_version(spark):
    columns = [c.split()[0] for c in STAGED_LOG.split(", ")]
    line = {"userId": "7", "firstName": "Ann", "lastName": "B", "gender": "F", "page": "NextSong", "song": "S", "artist": "A"}

    def at(hour, level, page="NextSong", user="7"):
        row = {**line, "ts": dt.datetime(2018, 11, 1, hour), "level": level, "page": page, "userId": user, "sessionId": hour}
        return tuple(row.get(c) for c in columns)

    log = spark.createDataFrame([at(1, "free"), at(2, "paid", "Upgrade"), at(3, "paid"), at(5, "free"), at(4, "free", user=" ")], STAGED_LOG)
    users = star_history.users(log)
    assert [(r.level, r.valid_from.hour, r.is_current) for r in users.orderBy("valid_from").collect()] == [
        ("free", 1, False), ("paid", 2, False), ("free", 5, True),
    ]
    plays = star_history.plays(log, users).orderBy("start_time").collect()
    assert [(r.session_id, r.level, r.user_key is None) for r in plays] == [(1, "free", False), (3, "paid", False), (4, None, True), (5, "free", False)]
