import os
import uuid

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from martflow.operators.upsert import upsert_do_nothing
from martflow.schemas import STAR
from martflow.sinks import tables, writers
from martflow.sources.readers import read_csv, read_partitioned


def unused(label="t"):
    return f"{label}_{uuid.uuid4().hex}"


def test_overwrite_and_refusal(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_parquet(spark.range(5), path, mode="errorifexists")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        writers.write_parquet(spark.range(7), path, mode="errorifexists")
    assert spark.read.parquet(path).count() == 5
    writers.write_parquet(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7


def test_partitioned_write_bounds_files(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.range(8000).select("id", (F.col("id") % 4).alias("part")).repartition(8)
    writers.write_parquet(df, str(path), ["part"])
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 4
    assert read_partitioned(spark, str(path), "id bigint, part bigint").count() == 8000


def test_csv_round_trip_keeps_quotes_commas_and_nulls(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a,"b"'), (2, None), (3, "x;y")], "id int, label string")
    for sep in (",", ";"):
        path = str(tmp_path / f"csv{ord(sep)}")
        writers.write_csv(df, path, sep=sep)
        assert rows(read_csv(spark, path, df.schema, sep=sep)) == rows(df)


def test_csv_round_trip_keeps_spaces_breaks_and_empty_text(spark, tmp_path, rows):
    texts = [" outer ", "two\nlines", "", None, 'a "b"', "back\\slash", ",", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, label string")
    for i, frame in enumerate((df, df.select("label"))):
        for quote_all in (False, True):
            path = str(tmp_path / f"{i}{quote_all}")
            writers.write_csv(frame, path, quote_all=quote_all)
            found = read_csv(spark, path, frame.schema, multi_line=True)
            assert sorted(map(repr, found.collect())) == sorted(map(repr, frame.collect()))


def test_quote_all_and_column_subset(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "z")], "id int, label string, unused string")
    writers.write_csv(df, str(tmp_path / "q"), columns=["label", "id"], quote_all=True)
    lines = {r["value"] for r in spark.read.text(str(tmp_path / "q")).collect()}
    assert lines == {'"label","id"', '"a","1"'}


def test_load_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    for truncate, expected in ((True, 3), (False, 6), (True, 3)):
        writers.load(spark.range(3), path, truncate)
        assert spark.read.parquet(path).count() == expected


def test_merge_partitions_leaves_others_alone(spark, tmp_path, rows):
    path = tmp_path / "t"
    schema = "k int, v string, part int"
    writers.write_parquet(spark.createDataFrame([(1, "old", 1), (2, "old", 2)], schema), str(path), ["part"])
    before = sorted(os.listdir(path / "part=2"))
    writers.merge_partitions(
        read_partitioned(spark, str(path), schema),
        spark.createDataFrame([(1, "new", 1), (3, "new", 1), (4, "new", 3)], schema),
        str(path),
        ["part"],
        lambda t, n: upsert_do_nothing(t, n, ["k", "part"], []),
    )
    assert sorted(os.listdir(path / "part=2")) == before
    assert rows(read_partitioned(spark, str(path), schema)) == [
        (1, "old", 1), (2, "old", 2), (3, "new", 1), (4, "new", 3),
    ]


def test_namespace_create_drop(spark, tmp_path):
    name = unused("ns")
    tables.create_namespace(spark, name, str(tmp_path / "ns"))
    tables.create_namespace(spark, name)
    assert spark.catalog.databaseExists(name)
    tables.create_table(spark, f"{name}.t", "id int", str(tmp_path / "ns/t"))
    tables.drop_namespace(spark, name)
    tables.drop_namespace(spark, name)
    assert not spark.catalog.databaseExists(name)


def test_drop_table_twice(spark, tmp_path):
    name = unused()
    tables.create_table(spark, name, "id int", str(tmp_path / "t"))
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_reset_gives_empty_tables(spark, tmp_path):
    suffix = uuid.uuid4().hex
    declared = {f"{name}_{suffix}": ddl for name, ddl in STAR.items()}
    tables.reset_tables(spark, declared, str(tmp_path))
    users = f"users_{suffix}"
    writers.load_table(spark.createDataFrame([("1", "a", "b", "F", "free")], STAR["users"]), users, truncate=False)
    assert spark.table(users).count() == 1
    tables.reset_tables(spark, declared, str(tmp_path))
    assert [spark.table(t).count() for t in declared] == [0] * 5
    assert spark.table(users).columns == [f.name for f in tables.schema_of(STAR["users"])]


def test_varchar_limit_is_enforced(spark, tmp_path):
    name = unused()
    tables.create_table(spark, name, "label VARCHAR(3)", str(tmp_path / "t"))
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        writers.load_table(spark.createDataFrame([("long",)], "label string"), name, truncate=False)


def test_replace_table_from_itself(spark, tmp_path, rows):
    name = unused()
    tables.replace_table(spark.range(3).toDF("id"), name, str(tmp_path / "v0"))
    for version in (1, 2):
        doubled = spark.table(name).select((F.col("id") * 2).alias("id"))
        tables.replace_table(doubled, name, str(tmp_path / f"v{version}"))
    assert rows(spark.table(name)) == [(0,), (4,), (8,)]


def test_bucketed_layout_groups_without_a_shuffle(spark, tmp_path, capsys):
    name = unused()
    df = spark.range(4000).select((F.col("id") % 500).alias("k"), "id")
    tables.write_distributed(df, name, str(tmp_path / "t"), "k", ["k", "id"], 8)
    grouped = spark.table(name).groupBy("k").count()
    grouped.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert grouped.count() == 500
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        spark.table(name).where("k = 7").explain()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in capsys.readouterr().out


def test_layout_is_the_callers_choice_and_splits_hot_keys(spark, tmp_path, rows):
    name = unused()
    hot = spark.range(3000).select(F.lit(0).cast("bigint").alias("k"), "id")
    cold = spark.range(3000).select((F.col("id") + 1).alias("k"), "id")
    df = hot.union(cold)
    for layout, spread in (("ranged", 1), ("bucketed", 4)):
        name = unused()
        tables.write_distributed(df, name, str(tmp_path / layout), "k", ["k", "id"], 16, layout, spread)
        stored = spark.table(name)
        assert rows(stored) == rows(df)
        assert stored.where("k = 0").select(F.input_file_name()).distinct().count() > 1
    assert stored.groupBy("k").count().where("k = 0").first()["count"] == 3000
    with pytest.raises(ValueError):
        tables.write_distributed(df, unused(), str(tmp_path / "t"), "k", ["k"], 4, "either")


def test_replace_table_refuses_a_used_location(spark, tmp_path):
    name = unused()
    tables.replace_table(spark.range(3), name, str(tmp_path / "a"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.replace_table(spark.range(4), name, str(tmp_path / "a"))
    assert spark.table(name).count() == 3


def test_length_violations(spark, rows):
    df = spark.createDataFrame([("abc", "x"), ("abcd", None), ("abcde", "xy")], "a string, b string")
    assert rows(tables.length_violations(df, {"a": 3, "b": 1})) == [("a", 2), ("b", 1)]
