"""Tables that are looked up by any of their keys."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.operators.buckets import even_buckets
from martflow.sinks.clustered import FILES, lookup_clustered, read_clustered, write_clustered

SCHEMA = "session int, user string, song string, score double, n int"


def some_rows(seed, n=4000):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, rng.randrange(500), 7]), f"user/{int(rng.random() ** 3 * 90):03d}", rng.choice(["", "ä", None, f"s{rng.randrange(200)}"]),
            rng.choice([None, 0.5, float("nan"), float("-inf"), rng.random()]), i,
        )
        for i in range(n)
    ]


def got(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "clustered")
    df = spark.createDataFrame(some_rows(1), SCHEMA)
    write_clustered(df, path, ["session", "user", "song"], 64)
    return path, df


@pytest.mark.parametrize(
    "wanted",
    [
        {"session": 7}, {"user": "user/040"}, {"song": "s17"}, {"session": None}, {"song": None, "user": "user/000"}, {"song": ""},
        {"session": (100, 120)}, {"session": (None, 3), "user": ("user/080", None)}, {"user": "nobody"}, {"song": (None, None)}, {},
    ],
)
def test_lookups(spark, table, wanted):
    path, df = table
    want = df
    for key, value in wanted.items():
        column = F.col(key)
        if isinstance(value, tuple):
            want = want.where(column.isNotNull())
            want = want.where(column >= F.lit(value[0])) if value[0] is not None else want
            want = want.where(column <= F.lit(value[1])) if value[1] is not None else want
        else:
            want = want.where(column.eqNullSafe(F.lit(value)))
    assert got(lookup_clustered(spark, path, df.schema, wanted)) == got(want)


def opened(spark, path, schema, wanted):
    found = lookup_clustered(spark, path, schema, wanted)
    return len(set(found.inputFiles()))


def test_any_key_alone_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "even")
    rows = spark.range(64_000).select(
        (F.col("id") * 7919 % 1009).alias("a"), (F.col("id") * 104729 % 997).alias("b"), F.concat(F.lit("user/"), F.col("id") % 512).alias("c")
    )
    write_clustered(rows, path, ["a", "b"], 64)
    assert spark.read.parquet(f"{path}/{FILES}").count() == 64
    for wanted in ({"a": 500}, {"b": 500}, {"b": 3}):
        assert opened(spark, path, rows.schema, wanted) < 16
    assert opened(spark, path, rows.schema, {"a": 500, "b": 500}) <= 4
    three = str(tmp_path / "three")
    write_clustered(rows, three, ["a", "b", "c"], 64)
    for wanted in ({"a": 500}, {"b": 500}):
        assert opened(spark, three, rows.schema, wanted) <= 32


def test_appended_rows_and_lost_writes(spark, table):
    path, df = table
    more = spark.createDataFrame(some_rows(2, 300), SCHEMA)
    write_clustered(more, path, ["session", "user", "song"], 4, append=True)
    both = df.unionAll(more)
    assert got(read_clustered(spark, path, df.schema)) == got(both)
    # A write that fails before its files are listed adds nothing.
    more.write.mode("append").parquet(path)
    assert got(read_clustered(spark, path, df.schema)) == got(both)
    files = spark.read.parquet(f"{path}/{FILES}")
    assert files.agg(F.sum("rows")).first()[0] == both.count() and files.count() == files.select("file").distinct().count()


def test_a_used_path_is_refused(spark, table):
    path, df = table
    with pytest.raises(Exception, match="(?i)already exists"):
        write_clustered(df, path, ["session"], 4)


def test_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    none = spark.createDataFrame([], SCHEMA)
    write_clustered(none, path, ["session", "user"], 8)
    assert lookup_clustered(spark, path, none.schema, {"user": "a"}).count() == 0


def test_hot_combination_fills_several_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(20_000).select(F.lit(1).alias("a"), F.lit("x").alias("b"), F.lit(0).alias("same"))
    write_clustered(rows, path, ["a", "b"], 16)
    sizes = [r.rows for r in spark.read.parquet(f"{path}/{FILES}").collect()]
    assert len(sizes) > 4 and max(sizes) < 5000


def test_buckets_of_odd_values(spark):
    values = [(float(v),) for v in ("nan", "inf", "-inf", "0", "1e308", "-5")] + [(None,)]
    rows = spark.createDataFrame(values, "v double")
    bucket = even_buckets(rows, {"v": 3})["v"]
    found = {str(r.v): r.b for r in rows.select("v", bucket(F.col("v")).alias("b")).collect()}
    assert found["None"] is None and found["-inf"] == found["0.0"] == 0 and found["nan"] == found["inf"] == found["1e+308"] == 1
