import pytest
from pyspark.sql import functions as F

from martflow.operators import joins


@pytest.fixture
def sides(spark):
    """Plays of which a third share one song and some name none."""
    plays = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hit").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("song"), F.col("id") % 50)).alias("song"),
        (F.col("id") % 2).alias("half"),
    )
    songs = spark.createDataFrame(
        [("hit", 0, "H0"), ("hit", 1, "H1"), (None, 0, "N")] + [(f"song{i}", i % 2, f"S{i}") for i in range(0, 50, 2)],
        "title string, side bigint, song_id string",
    )
    return plays, songs


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(sides, rows, how):
    plays, songs = sides
    on = {"song": "title", "half": "side"}
    salted = joins.salted_join(plays, songs, on, how, share=0.05, salts=4)
    plain = joins.equi_join(plays, songs, on, how)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_join_spreads_the_hot_key(spark, sides):
    plays, songs = sides
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def tasks(join, **options):
            joined = join(plays, songs, {"song": "title"}, **options).where("song = 'hit'")
            return joined.select(F.spark_partition_id()).distinct().count()

        assert tasks(joins.equi_join) == 1
        assert tasks(joins.salted_join, share=0.05, salts=16) > 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_join_without_hot_keys(spark, rows):
    left, right = spark.range(500).toDF("a"), spark.range(0, 500, 2).toDF("b")
    assert rows(joins.salted_join(left, right, {"a": "b"}, share=0.1)) == rows(right)


def test_heavy_hitters_misses_none(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("k"))
    hot = df.where("k = -1").select(F.xxhash64("k")).first()[0]
    found = joins.heavy_hitters(df, ["k"], 0.05)
    assert hot in found and len(found) <= 20


def test_replicate_checks_rows_and_bytes(spark, capsys):
    def hinted(df):
        df.explain(mode="extended")
        return "strategy=broadcast" in capsys.readouterr().out

    assert hinted(joins.replicate(spark.range(100)))
    assert not hinted(joins.replicate(spark.range(100), max_rows=99))
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert hinted(joins.replicate(wide, max_bytes=20_000))
    assert not hinted(joins.replicate(wide, max_bytes=5_000))


def test_duplicate_titles_multiply_rows(spark):
    plays = spark.createDataFrame([("a", "x")], "song string, artist string")
    songs = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 3)], "title string, name string, id int")
    assert joins.equi_join(plays, songs, {"song": "title", "artist": "name"}).count() == 2


def test_numeric_key_compares_exactly_at_its_scale(spark, rows):
    plays = spark.createDataFrame([("a", 0.1 + 0.2), ("b", 100.4)], "song string, length double")
    songs = spark.createDataFrame([("a", 0.3, 1), ("b", 99.6, 2)], "title string, duration double, id int")
    fine = joins.left_join_numeric(plays, songs, {"song": "title"}, ("length", "duration"))
    assert rows(fine.select("song", "id")) == [("a", 1), ("b", None)]
    whole = joins.left_join_numeric(plays, songs, {"song": "title"}, ("length", "duration"), scale=0)
    assert rows(whole.select("song", "id")) == [("a", 1), ("b", 2)]


def test_resolve_keeps_every_play_once(spark, rows):
    plays = spark.createDataFrame([(1, "a", 1.0), (2, "z", 1.0), (3, None, None)], "p int, song string, length double")
    songs = spark.createDataFrame([("a", 1.0, "S2"), ("a", 1.0, "S1"), ("a", 2.0, "S0")], "title string, d double, id string")
    assert rows(joins.resolve(plays, songs, {"song": "title"}, ("length", "d"), ["id"]).select("p", "id")) == [
        (1, "S1"), (2, None), (3, None),
    ]


def test_hot_key_is_split_against_a_reduced_catalogue(spark, tmp_path):
    """A third of the plays name one song; no task may join them all."""
    hot = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    saved = {k: spark.conf.get(k, None) for k in hot}
    for k, v in hot.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        plays = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hit").otherwise(F.concat(F.lit("s"), F.col("id") % 5000)).alias("song"),
            F.lit(1.0).alias("length"),
            F.uuid().alias("agent"),
        )
        songs = plays.select(F.col("song").alias("title"), F.lit(1.0).alias("d"), F.lit("i").alias("id")).distinct()
        got = joins.resolve(plays, songs, {"song": "title"}, ("length", "d"), ["id"])
        got.write.parquet(str(tmp_path / "out"))
        files = [spark.read.parquet(p) for p in set(spark.read.parquet(str(tmp_path / "out")).inputFiles())]
        sizes = [f.where("song = 'hit'").count() for f in files]
        assert sum(sizes) == n / 3
        assert max(sizes) < n / 6
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_roles_share_one_lookup(spark, rows):
    fact = spark.createDataFrame([(1, 10, 20), (2, 20, 99)], "id int, born int, lives int")
    countries = spark.createDataFrame([(10, "A"), (20, "B")], "code int, country string")
    both = joins.enrich(
        fact,
        (countries, "born", "code", {"country": "born_country"}),
        (countries, "lives", "code", {"country": "home_country"}),
    )
    assert both.columns == ["id", "born", "lives", "born_country", "home_country"]
    assert rows(both) == [(1, 10, 20, "A", "B"), (2, 20, 99, "B", None)]


def test_small_lookups_are_broadcast_by_size(spark, tmp_path, capsys):
    spark.range(10).selectExpr("id AS code", "string(id) AS name").write.parquet(str(tmp_path / "lookup"))
    spark.range(1000).selectExpr("id", "id % 12 AS c").write.parquet(str(tmp_path / "fact"))
    lookup = spark.read.parquet(str(tmp_path / "lookup"))
    decoded = joins.decode(spark.read.parquet(str(tmp_path / "fact")), lookup, "c", "code", {"name": "name"})
    decoded.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert decoded.where("name IS NULL").count() == decoded.where("c > 9").count()


def test_mean_by_attribute_keeps_the_null_group(spark, rows):
    temps = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 8.0), ("z", 5.0), ("x", None)], "city string, t double")
    states = spark.createDataFrame([("x", "S"), ("y", "S")], "name string, state string")
    got = joins.mean_by_attribute(temps, "city", F.col("t"), states, "name", "state", "mean")
    assert rows(got) == [(None, 5.0), ("S", 4.0)]
