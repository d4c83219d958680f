"""Keys that are null or differ in type between the sides of a join."""

import pytest
from pyspark.sql import functions as F

from martflow.operators.joins import equi_join, salted_join
from martflow.operators.upsert import absent_rows, upsert_do_nothing, upsert_rows
from martflow.sinks.writers import merge_partitions
from martflow.streaming.incremental import stage_incrementally


@pytest.mark.parametrize(
    ("left_type", "right_type"),
    [("int", "bigint"), ("string", "bigint"), ("decimal(18,2)", "decimal(18,5)"), ("int", "int")],
)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_of_unlike_types(spark, rows, left_type, right_type, how):
    key = F.when(F.col("id") % 10 < 8, F.lit(7)).when(F.col("id") % 10 == 8, F.col("id"))
    left = spark.range(2000).select(F.col("id").alias("row"), key.cast(left_type).alias("k"))
    right = spark.range(100).select(F.col("id").cast(right_type).alias("j"), (F.col("id") * 2).alias("v"))
    got = salted_join(left, right, {"k": "j"}, how, share=0.05, salts=8)
    assert rows(got) == rows(equi_join(left, right, {"k": "j"}, how))
    assert got.filter("k = 7").count() == 1600


def merge(target, incoming):
    return upsert_rows(target, incoming, ["k", "p"], ["k"])


def test_null_partitions_keep_their_rows(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None), (2, None), (3, 1), (4, 2)], "k int, p int").write.partitionBy("p").parquet(path)
    target = spark.read.schema("k int, p int").parquet(path)
    merge_partitions(target, spark.createDataFrame([(9, None), (5, 2)], "k int, p int"), path, ["p"], merge)
    after = spark.read.schema("k int, p int").parquet(path)
    assert rows(after) == rows(
        spark.createDataFrame([(1, None), (2, None), (3, 1), (4, 2), (9, None), (5, 2)], "k int, p int")
    )


def test_several_partition_columns(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k int, p int, q string"
    spark.createDataFrame([(1, None, "a"), (2, 1, None), (3, 1, "a")], schema).write.partitionBy("p", "q").parquet(path)

    def keep_all(target, incoming):
        return target.unionByName(incoming)

    new = spark.createDataFrame([(8, 1, None), (9, None, "a")], schema)
    merge_partitions(spark.read.schema(schema).parquet(path), new, path, ["p", "q"], keep_all)
    assert [r[0] for r in rows(spark.read.schema(schema).parquet(path))] == [1, 2, 3, 8, 9]


def test_merge_reads_touched_partitions_only(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("cast(id as int) as k", "cast(id % 10 as int) as p").write.partitionBy("p").parquet(path)

    def explained(target, incoming):
        target.explain()
        return merge(target, incoming)

    merge_partitions(
        spark.read.schema("k int, p int").parquet(path),
        spark.createDataFrame([(500, 3), (501, None)], "k int, p int"),
        path,
        ["p"],
        explained,
    )
    filters = capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]
    assert "3" in filters and "isnull" in filters


def test_null_keys_are_inserted_once(spark, rows):
    new = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    empty = new.limit(0)
    once = upsert_do_nothing(empty, new, ["k"], ["v"])
    assert rows(upsert_do_nothing(once, new, ["k"], ["v"])) == rows(once) == rows(new)
    assert absent_rows(once, new, ["k"], ["v"]).count() == 0
    assert rows(upsert_rows(upsert_rows(empty, new, ["k"], ["v"]), new, ["k"], ["v"])) == rows(new)


def test_staging_before_the_first_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    staged = stage_incrementally(
        spark, str(tmp_path / "in"), "json", "a int, b string", str(tmp_path / "out"), str(tmp_path / "progress")
    )
    assert staged.columns == ["a", "b"] and staged.count() == 0
