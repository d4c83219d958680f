import hashlib

from pyspark.sql import functions as F

from martflow.functions.keys import dense_ids, md5_key, unique_ids


def test_dense_ids_follow_the_order_without_gaps(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    got = dense_ids(df, "id", ["k"], start=1).collect()
    assert sorted((r["id"], r["k"]) for r in got) == [(i + 1, i) for i in range(5000)]


def test_dense_ids_with_many_copies_of_one_row(spark):
    """A third of the rows are copies of each other: still dense and in order."""
    copies = spark.range(3000).select(F.lit(500).cast("bigint").alias("k"))
    others = spark.range(6000).select(F.col("id").alias("k"))
    numbered = dense_ids(copies.union(others).repartition(5), "id", ["k"], partitions=6).collect()
    by_id = sorted((r["id"], r["k"]) for r in numbered)
    assert [i for i, _ in by_id] == list(range(9000))
    keys = [k for _, k in by_id]
    assert keys == sorted(keys)


def test_copies_are_spread_over_partitions(spark):
    copies = spark.range(20000).select(F.lit(1).alias("k"))
    numbered = dense_ids(copies, "id", ["k"], partitions=8)
    sizes = [spark.read.parquet(path).count() for path in set(numbered.inputFiles())]
    assert len(sizes) == 8 and max(sizes) < 5000
    assert numbered.agg(F.count_distinct("id")).first()[0] == 20000


def test_dense_ids_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(300).select((F.col("id") % 10).alias("k"), (F.col("id") * 31 % 300).alias("v"))
    assert rows(dense_ids(df.repartition(2), "id", ["k"])) == rows(dense_ids(df.repartition(9, "v"), "id", ["k"]))


def test_dense_ids_without_an_order_need_no_shuffle(spark):
    df = spark.range(0, 1000, 1, 7).where("id % 3 != 0")
    ids = [r["n"] for r in dense_ids(df, "n", start=1).collect()]
    assert sorted(ids) == list(range(1, 667))


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0), "n", ["id"]).count() == 0


def test_unique_ids(spark):
    df = unique_ids(spark.range(1000).repartition(5), "key")
    assert df.columns == ["key", "id"]
    assert df.select("key").distinct().count() == 1000


def test_md5_key(spark):
    got = spark.range(1).select(md5_key(F.lit(12), F.lit("a")).alias("k")).first()["k"]
    assert got == hashlib.md5(b"12a").hexdigest()
