"""Whole marts on a handful of made-up rows."""

import os
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from martflow.functions.timeparts import from_epoch_ms
from martflow.operators.quality import QualityError
from martflow.plans import (
    airports,
    analytics,
    climate,
    demographics,
    immigration,
    immigration_mart,
    load_run,
    query_first,
    star_lake,
    star_orchestrated,
    star_upsert,
    star_warehouse,
)
from martflow.schemas import ARRIVAL_COLUMNS, CITY_COLUMNS, EVENT_CSV, LOG_FILE, SONG_FILE, STAR
from martflow.sinks.tables import create_namespace, reset_tables, schema_of

T0 = 1541106000250


def line(user="8", song="A", artist="X", length=100.0, ts=T0, level="free", page="NextSong", session=1, item=0):
    return (artist, "Logged In", "Ann", "F", item, "Example", length, level, "Springfield", "PUT", page,
            1.5e12, session, song, 200, ts, "agent", user)


def song(song_id, title, artist="X", duration=100.0, year=0, artist_id="AR1", place="Here"):
    return (1, artist_id, None, None, place, artist, song_id, title, duration, year)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            line(),
            line(song="B", ts=T0 + 1000, level="paid", item=1),
            line(user="9", song="missing", ts=T0 + 2000, session=2),
            line(user="", song=None, artist=None, length=None, page="Home", ts=T0 + 3000, session=3),
        ],
        LOG_FILE,
    )


@pytest.fixture
def staged(log):
    return log.withColumn("ts", from_epoch_ms(F.col("ts")))


@pytest.fixture
def songs(spark):
    return spark.createDataFrame(
        [song("S1", "A"), song("S1", "A"), song("S2", "B", duration=99.0, year=2000), song("S3", "C", "Y", artist_id="AR2")],
        SONG_FILE,
    )


def test_warehouse_star(staged, songs, rows):
    plays = star_warehouse.songplays(staged, songs, ids="dense")
    assert [(r.songplay_id, r.song_id, r.location) for r in plays.orderBy("songplay_id").collect()] == [
        (0, "S1", "Here"), (1, "S2", "Here"),
    ]
    assert star_warehouse.songplays(staged, songs, ids="unique").select("songplay_id").distinct().count() == 2
    assert star_warehouse.users(staged).count() == 3
    assert rows(star_warehouse.users(staged, "latest").select("user_id", "level")) == [("8", "paid"), ("9", "free")]
    assert star_warehouse.songs(songs).count() == 3
    assert star_warehouse.artists(songs).count() == 2
    assert star_warehouse.times(plays).select("weekday").distinct().first()[0] == 4  # a Thursday


def test_a_blank_id_is_no_user(spark):
    log = spark.createDataFrame([line(user=""), line(user=None), line(user="7")], LOG_FILE)
    staged = log.withColumn("ts", from_epoch_ms(F.col("ts")))
    for policy in ("distinct", "latest"):
        assert [r.user_id for r in star_warehouse.users(staged, policy).collect()] == ["7"]
    empty = spark.createDataFrame([], STAR["users"])
    assert [r.user_id for r in star_upsert.users(empty, staged).collect()] == ["7"]


def test_upserted_star(spark, staged, songs, rows):
    empty = {name: spark.createDataFrame([], ddl) for name, ddl in STAR.items()}
    all_songs = star_upsert.songs(empty["songs"], songs)
    all_artists = star_upsert.artists(empty["artists"], songs)
    assert (all_songs.count(), all_artists.count()) == (3, 2)
    assert star_upsert.songs(all_songs, songs).count() == 3
    users = star_upsert.users(empty["users"], staged)
    assert rows(users.select("user_id", "level")) == [("8", "paid"), ("9", "free")]
    times = star_upsert.times(empty["time"], staged)
    assert rows(star_upsert.times(times, staged)) == rows(times)
    assert times.count() == 3
    fact = star_upsert.songplays(staged, all_songs, all_artists).orderBy("songplay_id").collect()
    # The second song's length differs from its duration; the third song is unknown.
    assert [(r.songplay_id, r.user_id, r.song_id, r.artist_id) for r in fact] == [
        (1, "8", "S1", "AR1"), (2, "8", None, None), (3, "9", None, None),
    ]
    assert {f.name for f in schema_of(STAR["songplays"])} == set(fact[0].asDict())


def test_lake_star(spark, log, songs, tmp_path, rows):
    songs.write.json(str(tmp_path / "song/A/B/C"))
    log.write.json(str(tmp_path / "log/2018/11"))
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the first
        star_lake.run(spark, f"{tmp_path}/song/*/*/*/*.json", f"{tmp_path}/log/*/*/*.json", out, text_time=True)
    assert sorted(d for d in os.listdir(f"{out}/songs") if "=" in d) == ["year=0", "year=2000"]
    assert os.path.isdir(f"{out}/songplays/year=2018/month=11")
    fact = spark.read.parquet(f"{out}/songplays")
    assert rows(fact.select("song_id", "start_time", "location")) == [
        ("S1", "01-11-2018 21:00:00", "Springfield"), ("S2", "01-11-2018 21:00:01", "Springfield"),
    ]
    assert spark.read.parquet(f"{out}/users").count() == 3
    assert rows(spark.read.parquet(f"{out}/time").select("hour", "week", "weekday").distinct()) == [("21", "44", "Thu")]
    assert spark.read.parquet(f"{out}/artists").count() == 2


def test_orchestrated_star(log, songs, rows):
    fact = star_orchestrated.songplays(log, songs.distinct())
    assert rows(fact.select("userid", "songid")) == [("8", None), ("8", "S1"), ("9", None)]
    assert fact.select("start_time").first()[0].microsecond == 0
    assert star_orchestrated.times(fact).count() == 3
    near = songs.distinct().withColumn("duration", F.col("duration") + F.when(F.col("song_id") == "S2", 0.6).otherwise(0.2))
    assert star_orchestrated.songplays(log, near).where("songid IS NOT NULL").count() == 0
    assert star_orchestrated.songplays(log, near, length_scale=0).where("songid IS NOT NULL").count() == 2


def test_load_stops_at_an_empty_table(spark, log, songs, tmp_path, rows):
    fact = {"songplays": lambda t: star_orchestrated.songplays(t["log"], t["catalogue"])}
    dimensions = {
        "songs": lambda t: star_orchestrated.songs(t["catalogue"]),
        "time": lambda t: star_orchestrated.times(t["songplays"]),
    }
    staged = {"log": log, "catalogue": songs}
    report = load_run.run_load(spark, str(tmp_path / "ok"), staged, fact, dimensions)
    assert rows(report) == [("songplays", 4, True), ("songs", 3, True), ("time", 4, True)]
    again = load_run.run_load(spark, str(tmp_path / "ok"), staged, fact, dimensions, truncate=False)
    assert ("songs", 6, True) in rows(again)
    with pytest.raises(QualityError, match="songplays"):
        nothing = {"log": log.where("page = 'none'"), "catalogue": songs}
        load_run.run_load(spark, str(tmp_path / "bad"), nothing, fact, dimensions)


def test_standing_questions(staged, songs, rows):
    plays = star_warehouse.songplays(staged, songs)
    star = {
        "songplays": plays, "time": star_warehouse.times(plays), "users": star_warehouse.users(staged),
        "songs": star_warehouse.songs(songs), "artists": star_warehouse.artists(songs),
    }
    answers = analytics.questions(star)
    assert answers["count_songplays"].first()[0] == 2
    assert [tuple(r) for r in answers["payment_analysis"].collect()] == [("free", 2), ("paid", 1)]
    assert ("most_repeated_locations", "Here", "2") in rows(analytics.long_form(answers))


def test_query_first_tables(spark, tmp_path, rows):
    header = [f.split()[0] for f in EVENT_CSV.split(", ")]
    events = [
        line(artist='Say "Hi", Bob', song="A", session=501, item=4, length=301.2573, user="10"),
        line(artist="Y", song="B", session=77, item=1, user="10"),
        line(artist="Z", song="A", session=77, item=0, user="10"),
        line(artist="Z", song="A", session=7, item=0, user="95"),
        line(artist="", song="", session=8, item=0, user="95"),
        line(artist=None, song=None, session=8, item=1, user="95"),
    ]
    raw = spark.createDataFrame(events, LOG_FILE).select(*header)
    for i in range(2):
        half = raw.where(F.col("itemInSession") % 2 == i)
        half.write.mode("append").csv(str(tmp_path / "csv"), header=True, escape='"')
    full = query_first.consolidate(spark, str(tmp_path / "csv"), str(tmp_path / "full"))
    assert full.count() == 4
    made = {}
    for name in ("session_history", "song_for_user", "user_for_song"):
        table = f"{name}_{uuid.uuid4().hex}"
        query_first.write_table(query_first.table(full, name), name, table, str(tmp_path / name), 4)
        made[name] = spark.table(table)
    heard = query_first.heard_in_session(made["session_history"], 501, 4).first()
    assert (heard.artist, heard.song) == ('Say "Hi", Bob', "A")
    assert heard.length == pytest.approx(301.2573, abs=1e-4)
    ordered = query_first.heard_by_user(made["song_for_user"], 10, 77).collect()
    assert [(r.itemInSession, r.artist) for r in ordered] == [(0, "Z"), (1, "Y")]
    assert query_first.listeners(made["user_for_song"], "A").count() == 2


def test_last_write_wins_by_stated_order(spark, rows):
    events = spark.createDataFrame(
        [("s1", 7, "old", 1), ("s1", 7, "new", 2)], "song string, userId int, firstName string, seq int"
    ).withColumn("lastName", F.lit("z"))
    assert rows(query_first.table(events, "user_for_song", ["seq"])) == [("s1", 7, "new", "z")]
    assert rows(query_first.table(events, "user_for_song")) == [("s1", 7, "old", "z")]


def test_immigration(spark, rows):
    schema = (
        "cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string, arrdate double, "
        "i94mode double, depdate double, i94visa double, gender string, airline string, unused string"
    )
    row = (1.0, 2016.0, 1.0, 582.0, 101.0, "ZZA", 20454.0, 1.0, None, 2.0, "F", "AA", "u")
    other = (2.0, 2016.0, 1.0, 999.0, 582.0, "QQQ", 20455.0, None, 20456.0, 9.0, None, None, "u")
    source = spark.createDataFrame([row, row, other], schema)
    lookups = {
        "airports": spark.createDataFrame([("ZZA", "SOMEWHERE", " ZZ ")], "airport_code string, airport_name string, state_code string"),
        "countries": spark.createDataFrame([(582, "ATLANTIS"), (101, "UTOPIA")], "country_code int, country string"),
        "modes": spark.createDataFrame([(1, "Air")], "mode_code int, mode string"),
        "visas": spark.createDataFrame([(2, "Pleasure")], "visa_code int, visa string"),
    }
    fact = immigration.fact(source, lookups)
    named = ["cicid", "arrdate", "depdate", "airport_name", "state_code", "born_country", "residence_country", "mode", "visa"]
    assert rows(fact.select(*named)) == [
        (1, date(2016, 1, 1), None, "SOMEWHERE", "ZZ", "ATLANTIS", "UTOPIA", "Air", "Pleasure"),
        (2, date(2016, 1, 2), date(2016, 1, 3), None, None, None, "ATLANTIS", None, None),
    ]
    by_residence = immigration.fact(source, lookups, born_key="i94res")
    assert rows(by_residence.select("born_country")) == [("ATLANTIS",), ("UTOPIA",)]
    assert rows(immigration.dates(fact).select("date", "weekday", "yearday")) == [
        (date(2016, 1, 1), 6, 1), (date(2016, 1, 2), 7, 2), (date(2016, 1, 3), 1, 3),
    ]


def test_climate(spark, rows):
    readings = spark.createDataFrame(
        [
            ("2000-01-01", "99", "Mesa", "United States", "1N", "1W"),
            ("2000-01-02", "10", "Mesa", "United States", "2N", "2W"),
            ("2000-02-01", "20", "Mesa", "United States", "3N", "3W"),
            ("2000-02-01", None, "Mesa", "United States", "3N", "3W"),
            ("2001-01-01", "5", "Nowhere", "United States", "4N", "4W"),
            ("2001-01-01", "7", "Paris", "France", "5N", "5W"),
            ("bad", "7", "Paris", "France", "5N", "5W"),
        ],
        "dt string, AverageTemperature string, City string, Country string, Latitude string, Longitude string",
    )
    cities = spark.createDataFrame(
        [("United States", "Mesa", "Arizona"), ("United States", "Mesa", "Colorado"), ("France", "Paris", "Ile")],
        "country string, city string, admin_name string",
    )
    codes = spark.createDataFrame([("Arizona", "AZ"), ("Texas", "TX")], "State string, Code string")
    assert rows(climate.by_state(readings, cities)) == [(None, 5.0), ("Arizona", 15.0)]
    assert rows(climate.by_country(readings)) == [("France", 7.0), ("United States", 35 / 3)]
    # Without the date filter the undated reading counts too, and comes first.
    assert rows(climate.by_country_position(readings.where("Country = 'France'"))) == [("France", 7.0, "5N", "5W")]
    assert rows(climate.by_country_position(readings).select("average_temperature")) == [(7.0,), (33.5,)]
    assert rows(climate.by_state_code(readings, cities, codes)) == [("AZ", 15.0, "2N", "2W")]


def test_airports(spark, rows):
    source = spark.createDataFrame(
        [
            ("A, B", "US", "US-CA", "San, Jose", "SJC", 1),
            ("C", "US", "US", None, "XXX", 1),
            ("D", "US", "US-TX", "E", None, 1),
            ("F", "FR", "FR-J", "Paris", "CDG", 1),
        ],
        "name string, iso_country string, iso_region string, municipality string, iata_code string, elevation int",
    )
    assert rows(airports.airports(source)) == [
        ("A  B", "US", "San  Jose", "SJC", "CA"), ("C", "US", None, "XXX", None),
    ]


def test_demographics(spark):
    city = ("X", "Ohio", "30", "10", "12", "22", None, "3", "2.5", "OH")
    other = ("Y", "Ohio", "40", "1", "2", "3", "4", "5", "3.5", "OH")
    lines = [city + ("White", "20"), city + ("Asian", "2"), other + ("White", "3")]
    source = spark.createDataFrame(lines, [*CITY_COLUMNS, "Race", "Count"])
    row = demographics.by_state(source).first().asDict()
    assert row["state"] == "Ohio" and row["state_code"] == "OH"
    assert (row["median_age"], row["average_household_size"]) == (35.0, 3.0)
    assert (row["male_population"], row["total_population"], row["number_of_veterans"]) == (11.0, 25.0, 4.0)
    assert (row["white"], row["asian"], row["hispanic_latino"]) == (23.0, 2.0, None)


@pytest.mark.parametrize("prune_from", [star_upsert.PRUNE_FROM, 0])
def test_upsert_load_by_deliveries(spark, prune_from, staged, songs, tmp_path, rows):
    suffix = uuid.uuid4().hex
    tables = {name: f"{name}_{suffix}" for name in STAR}
    reset_tables(spark, {tables[name]: ddl for name, ddl in STAR.items()}, str(tmp_path))
    first = staged.where("itemInSession = 0")
    star_upsert.load(spark, first, songs.where("song_id != 'S3'"), tables, str(tmp_path), "one", prune_from=prune_from)
    assert rows(spark.table(tables["users"]).select("user_id", "level")) == [("8", "free"), ("9", "free")]
    star_upsert.load(spark, staged.where("itemInSession = 1"), songs, tables, str(tmp_path), "two", prune_from=prune_from)
    assert rows(spark.table(tables["users"]).select("user_id", "level")) == [("8", "paid"), ("9", "free")]
    assert rows(spark.table(tables["songplays"]).select("songplay_id")) == [(1,), (2,), (3,)]
    assert [spark.table(tables[t]).count() for t in ("songs", "artists", "time")] == [3, 2, 3]
    held = rows(spark.table(tables["songplays"]))
    star_upsert.load(spark, first, songs, tables, str(tmp_path), "one", prune_from=prune_from)
    assert rows(spark.table(tables["songplays"])) == held
    both = staged.where("itemInSession < 2").unionByName(first.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")))
    star_upsert.load(spark, both, songs, tables, str(tmp_path), "three", prune_from=prune_from)
    numbers = [r.songplay_id for r in spark.table(tables["songplays"]).collect()]
    assert sorted(numbers) == list(range(1, len(held) + first.where("page = 'NextSong'").count() + 1))


def test_warehouse_run_from_files(spark, log, songs, tmp_path, rows):
    songs.write.json(str(tmp_path / "song"))
    log.write.json(str(tmp_path / "log"))
    paths = {name: f"$.{name}" for name in schema_of(LOG_FILE).names}
    args = (spark, str(tmp_path / "log"), str(tmp_path / "song"), str(tmp_path / "out"), paths)
    star = star_warehouse.run(*args)
    assert {n: d.count() for n, d in star.items()} == {
        "staging_events": 4, "staging_songs": 4, "songplays": 2, "users": 3, "songs": 3, "artists": 2, "time": 2,
    }
    assert rows(star["songplays"].select("songplay_id", "song_id")) == [(0, "S1"), (1, "S2")]
    assert rows(star["staging_events"].select("ts")) == rows(log.select(from_epoch_ms(F.col("ts"))))
    appended = star_warehouse.run(*args, truncate=False)
    assert appended["songs"].count() == 6 and appended["staging_events"].count() == 4
    assert rows(appended["songplays"].select("songplay_id")) == [(0,), (1,), (2,), (3,)]


def _immigration_files(spark, root, arrivals):
    def put(name, *lines):
        path = root / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    schema = ", ".join(f"{c} {'string' if c in ('i94port', 'gender', 'airline') else 'double'}" for c in ARRIVAL_COLUMNS)
    spark.createDataFrame(arrivals, schema).write.orc(str(root / "arrivals"))
    return immigration_mart.Inputs(
        arrivals=str(root / "arrivals"),
        arrivals_format="orc",
        airport_codes=put("a.csv", "airport_code,airport_name,state_code", "ZZA,PORT, NORTH, ZZ "),
        country_codes=put("c.csv", "country_code,country", "5,ATLANTIS, by sea", "0=UNUSABLE: NOWHERE"),
        mode_codes=put("m.csv", "mode_code,mode", "1,Air"),
        visa_codes=put("v.csv", "visa_code,visa", "2,Pleasure"),
        temperatures=put("t.csv", "dt,AverageTemperature,City,Country", "2001-01-01,3.5,Mesa,United States"),
        cities=put("w.csv", "country,city,admin_name", "United States,Mesa,Arizona"),
        airports=put(
            "p.csv", "name,iso_country,iso_region,municipality,iata_code", '"A, B",US,US-AZ,"Mesa, East",AZA'
        ),
        demographics=put(
            "d.csv", ";".join([*CITY_COLUMNS, "Race", "Count"]), "Mesa;Arizona;30;1;2;3;4;5;2.5;AZ;White;3"
        ),
    )


def test_immigration_mart(spark, tmp_path, rows):
    row = (1.0, 2016.0, 1.0, 5.0, 9.0, "ZZA", 20454.0, 1.0, 20456.0, 2.0, "F", "AA")
    inputs = _immigration_files(spark, tmp_path, [row, row])
    database = f"mart_{uuid.uuid4().hex}"
    create_namespace(spark, database, str(tmp_path / "db"))
    immigration_mart.build(spark, inputs, str(tmp_path / "out"))
    report = immigration_mart.publish(spark, str(tmp_path / "out"), database, str(tmp_path / "tables"))
    assert rows(report) == [
        ("airport", 1, True), ("date", 2, True), ("demographic", 1, True), ("i94", 1, True),
        ("us_states_temperature", 1, True), ("world_temperature", 1, True),
    ]
    fact = spark.table(f"{database}.i94").first()
    assert (fact.airport_name, fact.state_code, fact.born_country, fact.residence_country) == (
        "PORT, NORTH", "ZZ", "ATLANTIS, by sea", None,
    )
    assert (fact.arrdate, fact.depdate, fact.mode, fact.visa) == (date(2016, 1, 1), date(2016, 1, 3), "Air", "Pleasure")
    assert rows(spark.table(f"{database}.airport")) == [("A  B", "US", "Mesa  East", "AZA", "AZ")]
    assert rows(spark.table(f"{database}.date").select("date", "day", "weekday", "yearday")) == [
        (date(2016, 1, 1), 1, 6, 1), (date(2016, 1, 3), 3, 1, 3),
    ]
    assert spark.table(f"{database}.demographic").first().white == 3.0


def test_immigration_mart_without_arrivals_fails(spark, tmp_path):
    inputs = _immigration_files(spark, tmp_path, [])
    database = f"mart_{uuid.uuid4().hex}"
    create_namespace(spark, database, str(tmp_path / "db"))
    immigration_mart.build(spark, inputs, str(tmp_path / "out"))
    with pytest.raises(QualityError, match="date, i94"):
        immigration_mart.publish(spark, str(tmp_path / "out"), database, str(tmp_path / "tables"))
