"""Upserts into hash buckets."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from martflow.operators.pruning import split_rows
from martflow.operators.upsert import upsert_columns, upsert_do_nothing, upsert_rows
from martflow.sinks.bucketed import BUCKET, bucket_of, merge_buckets, read_bucketed, upsert_bucketed, write_bucketed

SCHEMA = "k bigint, j string, v int, seq int"
KEYS = ["k", "j"]


def some_rows(seed, n, keys=120):
    rng = random.Random(seed)
    return [(rng.choice([None, rng.randrange(keys)]), rng.choice(["a", None]), rng.randrange(9), i) for i in range(n)]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/{BUCKET}=*/*.parquet")}


@pytest.mark.parametrize("prune_from", [0, 1 << 30])
@pytest.mark.parametrize(
    ("upsert", "args"), [(upsert_columns, (["v"], ["seq"])), (upsert_rows, (["seq"],)), (upsert_do_nothing, (["seq"],))]
)
def test_merges_equal_the_plain_upsert(spark, tmp_path, prune_from, upsert, args):
    path = str(tmp_path / "t")
    schema = SCHEMA if upsert is not upsert_columns else "k bigint, j string, v int"
    empty = spark.createDataFrame([], schema)
    whole = upsert(empty, spark.createDataFrame(some_rows(1, 200), SCHEMA), KEYS, *args)
    write_bucketed(whole, path, KEYS, 8)
    for seed in (2, 3):
        delivery = spark.createDataFrame(some_rows(seed, 30), SCHEMA)
        whole = spark.createDataFrame(upsert(whole, delivery, KEYS, *args).collect(), schema)
        for _ in range(2):  # a repeated delivery changes nothing
            found = upsert_bucketed(spark, path, schema, delivery, upsert, *args, prune_from=prune_from)
            assert got(found) == got(whole)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit("a").alias("j"), F.lit(1).alias("v"), F.lit(0).alias("seq"))
    write_bucketed(rows, path, KEYS, 16)
    before = files_of(path)
    delivery = spark.createDataFrame([(5, "a", 2, 9), (9999, "a", 3, 9)], SCHEMA)
    touched = {r[0] for r in delivery.select(bucket_of(KEYS, 16)).collect()}
    merge_buckets(spark, path, SCHEMA, delivery, lambda t, n: upsert_rows(t, n, KEYS, ["seq"]), 0)
    after = files_of(path)
    for file, at in before.items():
        kept = int(file.split(f"{BUCKET}=")[1].split("/")[0]) not in touched
        assert (after.get(file) == at) == kept
    table = read_bucketed(spark, path, SCHEMA)
    assert table.count() == 2001 and {r.v for r in table.where("k IN (5, 9999)").collect()} == {2, 3}


def test_a_delivery_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(spark.createDataFrame(some_rows(1, 0), SCHEMA), path, KEYS, 4)
    none = spark.createDataFrame([], SCHEMA)
    assert upsert_bucketed(spark, path, SCHEMA, none, upsert_rows, ["seq"]).count() == 0
    one = spark.createDataFrame([(None, None, 1, 1)], SCHEMA)
    assert got(upsert_bucketed(spark, path, SCHEMA, one, upsert_rows, ["seq"])) == [(None, None, 1, 1)]


def test_a_hot_bucket_stays_spread_and_unshuffled(spark, tmp_path, capsys):
    """One bucket holds all rows: it is read and written by several tasks, and only rows of the delivery's keys are shuffled."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("k"), F.lit("a").alias("j"), F.lit(1).alias("v"), F.lit(0).alias("seq"))
    rows.withColumn(BUCKET, F.lit(0)).write.partitionBy(BUCKET).parquet(path)
    spark.range(1).select(F.lit(1).alias("buckets"), F.array(F.lit("k"), F.lit("j")).alias("keys")).write.parquet(f"{path}/_layout")
    delivery = spark.createDataFrame([(k, "a", 2, 9) for k in (7, 39_999, 50_000)], SCHEMA)
    held, rest = split_rows(read_bucketed(spark, path, SCHEMA), delivery, KEYS)
    assert held.count() < 50 and held.count() + rest.count() == 40_000
    capsys.readouterr()
    rest.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(k" not in plan
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = upsert_bucketed(spark, path, SCHEMA, delivery, upsert_rows, ["seq"], prune_from=0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found.count() == 40_001 and found.agg(F.sum("v")).first()[0] == 40_001 + 3
    assert len(files_of(path)) > 2
