"""L: whole marts built from the stand-in inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from martflow.operators.filters import of_kind
from martflow.operators.quality import nonempty_report
from martflow.plans import (
    airports,
    climate,
    demographics,
    immigration,
    immigration_mart,
    load_run,
    query_first,
    star_history,
    star_lake,
    star_orchestrated,
    star_upsert,
    star_warehouse,
)
from martflow.queries import standins
from martflow.queries.registry import query
from martflow.queries.standins import (
    AIRPORTS_SQL,
    ARRIVALS_SQL,
    CLIMATE_SQL,
    DEMOGRAPHICS_SQL,
    LOG_SQL,
    SONGS_SQL,
    STAGED_LOG_SQL,
)
from martflow.schemas import EVENT_CSV, RACES, SONG_PLAY, STAGED_LOG, STAR
from martflow.session import materialize, scratch_path
from martflow.sinks.tables import create_namespace, reset_tables, schema_of
from martflow.sinks.writers import write_csv, write_json, write_parquet
from martflow.sources.readers import read_csv, read_partitioned

PARTS_SQL = """CAST(hour(start_time) AS INTEGER) AS "hour", CAST(day(start_time) AS INTEGER) AS "day",
  CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS "month",
  CAST(year(start_time) AS INTEGER) AS "year" """
USERS_SQL = """userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level"""


# Keyed upserts


def _empty(spark, name):
    return spark.createDataFrame([], STAR[name])


def _halves(log):
    """The log in two deliveries, cut at a point in time."""
    early = F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz")
    return log.where(early), log.where(~early)


@query(
    "star_upsert_users",
    f"""WITH {STAGED_LOG_SQL},
    seen AS (SELECT *, (staged.ts, firstName, lastName, gender, level) AS o FROM staged WHERE page = 'NextSong')
    SELECT userId AS user_id, arg_min(firstName, o) AS first_name, arg_min(lastName, o) AS last_name,
           arg_min(gender, o) AS gender, arg_max(level, o) AS level
    FROM seen GROUP BY userId""",
)
def star_upsert_users(spark, sf_dir):
    users = _empty(spark, "users")
    for delivery in _halves(standins.staged_log(spark, sf_dir)):
        users = star_upsert.users(users, delivery)
    return users


@query(
    "star_upsert_time",
    f"""WITH {STAGED_LOG_SQL},
    t AS (SELECT DISTINCT staged.ts AS start_time FROM staged WHERE page = 'NextSong')
    SELECT start_time, {PARTS_SQL}, CAST(isodow(start_time) - 1 AS INTEGER) AS weekday FROM t""",
)
def star_upsert_time(spark, sf_dir):
    times = _empty(spark, "time")
    for delivery in _halves(standins.staged_log(spark, sf_dir)):
        times = star_upsert.times(times, delivery)
    return times


def _upserted_catalogue(spark, sf_dir):
    catalogue = standins.songs(spark, sf_dir)
    return (
        star_upsert.songs(_empty(spark, "songs"), catalogue),
        star_upsert.artists(_empty(spark, "artists"), catalogue),
    )


@query(
    "star_upsert_fact",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL}
    SELECT row_number() OVER (ORDER BY start_time, user_id, level, song_id NULLS FIRST,
             artist_id NULLS FIRST, session_id, location, user_agent) AS songplay_id, * FROM (
      SELECT staged.ts AS start_time, sessionId AS session_id, userId AS user_id, level, song_id,
             artist_id, location, userAgent AS user_agent
      FROM staged LEFT JOIN songs ON song = title AND artist = artist_name
       AND CAST(length AS DECIMAL(18,5)) = CAST(duration AS DECIMAL(18,5))
      WHERE page = 'NextSong')""",
)
def star_upsert_fact(spark, sf_dir):
    songs, artists = _upserted_catalogue(spark, sf_dir)
    return star_upsert.songplays(standins.staged_log(spark, sf_dir), songs, artists)


@query(
    "star_upsert_load",
    f"""WITH {LOG_SQL}, {SONGS_SQL}
    SELECT 'songplays' AS table_name, count(*) AS row_count, true AS passed FROM log WHERE page = 'NextSong'
    UNION ALL SELECT 'time', count(DISTINCT ts), true FROM log WHERE page = 'NextSong'
    UNION ALL SELECT 'users', count(DISTINCT userId), true FROM log WHERE page = 'NextSong'
    UNION ALL SELECT 'songs', count(DISTINCT song_id), true FROM songs
    UNION ALL SELECT 'artists', count(DISTINCT artist_id), true FROM songs""",
)
def star_upsert_load(spark, sf_dir):
    """Catalog tables brought up to date by two deliveries of the log, the first of which comes twice."""
    root = scratch_path(spark, "upserts")
    suffix = uuid.uuid4().hex
    tables = {name: f"{name}_{suffix}" for name in STAR}
    reset_tables(spark, {tables[name]: ddl for name, ddl in STAR.items()}, root)
    catalogue = standins.songs(spark, sf_dir)
    # Every table of the star is fed by plays alone, so these are what is staged.
    log = materialize(of_kind(standins.staged_log(spark, sf_dir), "page", SONG_PLAY).select(*star_upsert.LOG_COLUMNS), "staged-log")
    first, second = _halves(log)
    for i, delivery in enumerate((first, second, first)):
        star_upsert.load(spark, delivery, catalogue, tables, root, f"delivery-{i}")
    return nonempty_report({name: spark.table(table) for name, table in tables.items()})


@query(
    "star_upsert_artists",
    f"""WITH {SONGS_SQL}
    SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
           artist_longitude AS longitude
    FROM songs QUALIFY row_number() OVER (PARTITION BY artist_id
      ORDER BY artist_name, artist_location, artist_latitude NULLS FIRST, artist_longitude NULLS FIRST) = 1""",
)
def star_upsert_artists(spark, sf_dir):
    return _upserted_catalogue(spark, sf_dir)[1]


# Users with history

USER_VERSIONS_SQL = """
seen AS (
  SELECT userId AS user_id, staged.ts AS valid_from, max((firstName, lastName, gender, level)) AS o
  FROM staged GROUP BY ALL),
changes AS (
  SELECT * FROM seen
  QUALIFY lag(o) OVER (PARTITION BY user_id ORDER BY valid_from) IS DISTINCT FROM o),
versions AS (
  SELECT md5(user_id || CAST(valid_from AS VARCHAR)) AS user_key, user_id, o[1] AS first_name, o[2] AS last_name,
         o[3] AS gender, o[4] AS level, valid_from,
         lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to, valid_to IS NULL AS is_current
  FROM changes)"""


@query("dim_user_history", f"WITH {STAGED_LOG_SQL}, {USER_VERSIONS_SQL} SELECT * FROM versions")
def dim_user_history(spark, sf_dir):
    return star_history.users(standins.staged_log(spark, sf_dir), buckets=12)


@query(
    "fact_user_version",
    f"""WITH {STAGED_LOG_SQL}, {USER_VERSIONS_SQL},
    plays AS (SELECT staged.ts AS start_time, userId AS user_id, sessionId AS session_id, itemInSession AS item,
                     song, artist, location
              FROM staged WHERE page = 'NextSong'),
    late AS (SELECT * FROM versions WHERE valid_from >= TIMESTAMP '1995-01-01')
    SELECT plays.*, user_key, first_name, last_name, gender, level, valid_from
    FROM plays ASOF LEFT JOIN late ON plays.user_id = late.user_id AND start_time >= valid_from""",
)
def fact_user_version(spark, sf_dir):
    """Plays with the user as of their time; versions before 1995 are not known."""
    read = ["userId", "firstName", "lastName", "gender", "level", "ts", "page", "sessionId", "itemInSession", "song", "artist", "location"]
    log = materialize(standins.staged_log(spark, sf_dir).select(*read), "staged-log")
    known = star_history.users(log, buckets=12).where("valid_from >= TIMESTAMP_NTZ '1995-01-01'")
    return star_history.plays(log, known, buckets=12)


# Set-based warehouse

DW_FACT_SQL = f"""
plays AS (SELECT DISTINCT staged.ts AS start_time, sessionId AS session_id, userId AS user_id, song_id, level,
                 artist_id, artist_location AS location, userAgent AS user_agent
          FROM staged JOIN songs ON song = title AND artist = artist_name WHERE page = 'NextSong')"""


@query(
    "star_dw_fact",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL}, {DW_FACT_SQL}
    SELECT row_number() OVER (ORDER BY start_time, user_id, level, song_id, artist_id, session_id,
             location, user_agent) - 1 AS songplay_id, * FROM plays""",
)
def star_dw_fact(spark, sf_dir):
    return star_warehouse.songplays(
        standins.staged_log(spark, sf_dir), standins.songs(spark, sf_dir), ids="dense"
    )


@query(
    "star_dw_users",
    f"WITH {LOG_SQL} SELECT DISTINCT {USERS_SQL} FROM log WHERE page = 'NextSong' AND userId IS NOT NULL",
)
def star_dw_users(spark, sf_dir):
    return star_warehouse.users(standins.staged_log(spark, sf_dir))


@query("star_dw_songs", f"""WITH {SONGS_SQL} SELECT DISTINCT song_id, title, artist_id, "year", duration FROM songs""")
def star_dw_songs(spark, sf_dir):
    return star_warehouse.songs(standins.songs(spark, sf_dir))


ARTISTS_SQL = f"""WITH {SONGS_SQL}
SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
       artist_longitude AS longitude FROM songs"""


@query("star_dw_artists", ARTISTS_SQL)
def star_dw_artists(spark, sf_dir):
    return star_warehouse.artists(standins.songs(spark, sf_dir))


@query(
    "star_dw_time",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL}, {DW_FACT_SQL}, t AS (SELECT DISTINCT start_time FROM plays)
    SELECT start_time, {PARTS_SQL}, CAST(dayofweek(start_time) AS INTEGER) AS weekday FROM t""",
)
def star_dw_time(spark, sf_dir):
    plays = star_warehouse.songplays(standins.staged_log(spark, sf_dir), standins.songs(spark, sf_dir))
    return star_warehouse.times(plays)


@query(
    "star_dw_staged",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL}, {DW_FACT_SQL}
    SELECT song_id, user_id, level, start_time, CAST(dayofweek(start_time) AS INTEGER) AS weekday, location
    FROM plays""",
)
def star_dw_staged(spark, sf_dir):
    """From JSON files through staging to the five tables; the fact beside its time."""
    root = scratch_path(spark, "warehouse")
    write_json(standins.songs(spark, sf_dir), f"{root}/song/A/B/C")
    write_json(standins.log(spark, sf_dir), f"{root}/log/2018/11")
    paths = {name: f"$.{name}" for name in schema_of(STAGED_LOG).names}
    star = star_warehouse.run(spark, f"{root}/log/*/*", f"{root}/song/*/*/*", f"{root}/out", paths)
    joined = star["songplays"].join(star["time"], "start_time")
    return joined.select("song_id", "user_id", "level", "start_time", "weekday", "location")


# Partitioned lake


def _lake(spark, sf_dir):
    """Both JSON trees written out, then the whole lake built from them."""
    root = scratch_path(spark, "lake")
    write_json(standins.songs(spark, sf_dir), f"{root}/song/A/B/C")
    write_json(standins.log(spark, sf_dir), f"{root}/log/2018/11")
    star_lake.run(spark, f"{root}/song/*/*/*/*.json.gz", f"{root}/log/*/*/*.json.gz", f"{root}/out")
    return f"{root}/out"


@query(
    "star_lake_songs",
    f"""WITH {SONGS_SQL} SELECT DISTINCT song_id, title, artist_id, artist_name, duration, "year" FROM songs""",
)
def star_lake_songs(spark, sf_dir):
    path = scratch_path(spark, "lake")
    write_parquet(star_lake.songs(standins.songs(spark, sf_dir)), path, ["year"])
    return read_partitioned(spark, path, star_lake.SONGS)


@query("star_lake_artists", ARTISTS_SQL)
def star_lake_artists(spark, sf_dir):
    path = scratch_path(spark, "lake")
    write_parquet(star_lake.artists(standins.songs(spark, sf_dir)), path)
    return spark.read.parquet(path)


LAKE_TIME = "start_time timestamp_ntz, hour string, day string, week string, month string, year string, weekday string"


@query(
    "star_lake_time",
    f"""WITH {STAGED_LOG_SQL}, t AS (SELECT DISTINCT staged.ts AS start_time FROM staged WHERE page = 'NextSong')
    SELECT start_time, strftime(start_time, '%H') AS "hour", strftime(start_time, '%d') AS "day",
           CAST(week(start_time) AS VARCHAR) AS week, strftime(start_time, '%m') AS "month",
           strftime(start_time, '%Y') AS "year", strftime(start_time, '%a') AS weekday FROM t""",
)
def star_lake_time(spark, sf_dir):
    path = scratch_path(spark, "lake")
    write_parquet(star_lake.times(star_lake.plays(standins.log(spark, sf_dir))), path, ["year", "month"])
    return read_partitioned(spark, path, LAKE_TIME)


LAKE_FACT = (
    "songplay_id bigint, start_time timestamp_ntz, user_id string, level string, song_id string, "
    "artist_id string, session_id int, location string, user_agent string, year string, month string"
)


@query(
    "star_lake_fact",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL}
    SELECT staged.ts AS start_time, userId AS user_id, level, song_id, artist_id, sessionId AS session_id,
           location, userAgent AS user_agent, strftime(staged.ts, '%Y') AS "year", strftime(staged.ts, '%m') AS "month"
    FROM staged JOIN songs ON song = title AND artist = artist_name WHERE page = 'NextSong'""",
)
def star_lake_fact(spark, sf_dir):
    fact = read_partitioned(spark, f"{_lake(spark, sf_dir)}/songplays", LAKE_FACT)
    return fact.drop("songplay_id")


# Ordered steps

DAG_FACT_SQL = f"""
fact AS (SELECT md5(CAST(sessionId AS VARCHAR) || CAST(date_trunc('second', staged.ts) AS VARCHAR)) AS playid,
                date_trunc('second', staged.ts) AS start_time, userId AS userid, level, song_id AS songid,
                artist_id AS artistid, sessionId AS sessionid, location, userAgent AS user_agent
         FROM staged LEFT JOIN songs ON song = title AND artist = artist_name
          AND CAST(length AS DECIMAL(18,5)) = CAST(duration AS DECIMAL(18,5))
         WHERE page = 'NextSong')"""


@query("star_dag_fact", f"WITH {STAGED_LOG_SQL}, {SONGS_SQL}, {DAG_FACT_SQL} SELECT * FROM fact")
def star_dag_fact(spark, sf_dir):
    return star_orchestrated.songplays(standins.log(spark, sf_dir), standins.songs(spark, sf_dir))


@query(
    "star_dag_time",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL}, {DAG_FACT_SQL}
    SELECT start_time, {PARTS_SQL}, CAST(dayofweek(start_time) AS INTEGER) AS weekday FROM fact""",
)
def star_dag_time(spark, sf_dir):
    return star_orchestrated.times(star_dag_fact(spark, sf_dir))


@query(
    "star_dag_dims",
    f"""WITH {LOG_SQL}, {SONGS_SQL}
    SELECT 'users' AS dimension, count(*) AS n FROM
      (SELECT DISTINCT {USERS_SQL} FROM log WHERE page = 'NextSong')
    UNION ALL SELECT 'songs', count(*) FROM (SELECT DISTINCT song_id, title, artist_id, "year", duration FROM songs)
    UNION ALL SELECT 'artists', count(*) FROM (SELECT DISTINCT artist_id, artist_name, artist_location,
      artist_latitude, artist_longitude FROM songs)""",
)
def star_dag_dims(spark, sf_dir):
    log, songs = standins.log(spark, sf_dir), standins.songs(spark, sf_dir)
    report = nonempty_report(
        {
            "users": star_orchestrated.users(log),
            "songs": star_orchestrated.songs(songs),
            "artists": star_orchestrated.artists(songs),
        }
    )
    return report.select(F.col("table_name").alias("dimension"), F.col("row_count").alias("n"))


@query(
    "load_report",
    f"""WITH {LOG_SQL}, {SONGS_SQL}
    SELECT 'songplays' AS table_name, count(*) AS row_count, true AS passed FROM log WHERE page = 'NextSong'
    UNION ALL SELECT 'time', count(*), true FROM log WHERE page = 'NextSong'
    UNION ALL SELECT 'users', count(*), true FROM (SELECT DISTINCT {USERS_SQL} FROM log WHERE page = 'NextSong')
    UNION ALL SELECT 'songs', count(DISTINCT song_id), true FROM songs
    UNION ALL SELECT 'artists', count(*), true FROM (SELECT DISTINCT artist_id, artist_name, artist_location,
      artist_latitude, artist_longitude FROM songs)""",
)
def load_report(spark, sf_dir):
    log, songs = standins.log(spark, sf_dir), standins.songs(spark, sf_dir)
    return load_run.run_load(
        spark,
        scratch_path(spark, "star"),
        {"staging_events": log, "staging_songs": songs},
        {"songplays": lambda t: star_orchestrated.songplays(t["staging_events"], t["staging_songs"])},
        {
            "users": lambda t: star_orchestrated.users(t["staging_events"]),
            "songs": lambda t: star_orchestrated.songs(t["staging_songs"]),
            "artists": lambda t: star_orchestrated.artists(t["staging_songs"]),
            "time": lambda t: star_orchestrated.times(t["songplays"]),
        },
    )


# Query-first tables


def _consolidated(spark, sf_dir):
    """The log as CSV files, consolidated into one quoted data set."""
    root = scratch_path(spark, "events")
    events = standins.log(spark, sf_dir)
    fields = [f.split()[0] for f in EVENT_CSV.split(", ")]
    write_csv(events.select(*fields), f"{root}/csv")
    return query_first.consolidate(spark, f"{root}/csv", f"{root}/consolidated")


@query(
    "qf_consolidate",
    f"""WITH {LOG_SQL}
    SELECT artist, firstName, gender, itemInSession, lastName, length, level, location, sessionId, song,
           CAST(userId AS INTEGER) AS userId
    FROM log WHERE artist <> ''""",
)
def qf_consolidate(spark, sf_dir):
    return _consolidated(spark, sf_dir)


@query(
    "qf_session_history",
    f"""WITH {LOG_SQL}
    SELECT sessionId, itemInSession, artist, song, CAST(CAST(length AS FLOAT) AS DOUBLE) AS length
    FROM log WHERE artist <> ''
    QUALIFY row_number() OVER (PARTITION BY sessionId, itemInSession ORDER BY artist DESC, song DESC, length DESC) = 1""",
)
def qf_session_history(spark, sf_dir):
    history = query_first.table(_consolidated(spark, sf_dir), "session_history")
    return history.withColumn("length", F.col("length").cast("double"))


@query(
    "qf_song_for_user",
    f"""WITH {LOG_SQL}
    SELECT CAST(userId AS INTEGER) AS userId, sessionId, itemInSession, firstName, lastName, artist, song
    FROM log WHERE artist <> ''
    QUALIFY row_number() OVER (PARTITION BY userId, sessionId, itemInSession
                               ORDER BY firstName DESC, lastName DESC, artist DESC, song DESC) = 1""",
)
def qf_song_for_user(spark, sf_dir):
    return query_first.table(query_first.song_events(standins.log(spark, sf_dir)), "song_for_user")


@query(
    "qf_user_for_song",
    f"""WITH {LOG_SQL}
    SELECT song, CAST(userId AS INTEGER) AS userId, max(firstName) AS firstName, max(lastName) AS lastName
    FROM log WHERE artist <> '' GROUP BY ALL""",
)
def qf_user_for_song(spark, sf_dir):
    return query_first.table(query_first.song_events(standins.log(spark, sf_dir)), "user_for_song")


# Immigration

ENRICHED_SQL = f"""{ARRIVALS_SQL},
fact AS (
  SELECT CAST(cicid AS INTEGER) AS cicid, CAST(i94yr AS INTEGER) AS i94yr, CAST(i94mon AS INTEGER) AS i94mon,
         CAST(i94cit AS INTEGER) AS i94cit, CAST(i94res AS INTEGER) AS i94res, i94port,
         DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrdate, CAST(i94mode AS INTEGER) AS i94mode,
         DATE '1960-01-01' + CAST(depdate AS INTEGER) AS depdate, CAST(i94visa AS INTEGER) AS i94visa,
         gender, airline, airport_name, trim(state_code) AS state_code,
         b.country AS born_country, r.country AS residence_country, mode, visa
  FROM (SELECT DISTINCT * FROM arrivals) LEFT JOIN airports ON i94port = airport_code
  LEFT JOIN countries b ON i94cit = b.country_code LEFT JOIN countries r ON i94res = r.country_code
  LEFT JOIN modes ON i94mode = mode_code LEFT JOIN visas ON i94visa = visa_code)"""


@query(
    "imm_fact",
    f"""WITH {ENRICHED_SQL}
    SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate, CAST(depdate AS VARCHAR) AS depdate) FROM fact""",
)
def imm_fact(spark, sf_dir):
    source = standins.arrivals(spark, sf_dir)
    # Every arrival is delivered twice; the duplicates are dropped.
    fact = immigration.fact(source.union(source), standins.arrival_lookups(spark, sf_dir))
    return fact.withColumns({c: F.col(c).cast("string") for c in ("arrdate", "depdate")})


@query(
    "imm_dates",
    f"""WITH {ENRICHED_SQL},
    d AS (SELECT DISTINCT date FROM (SELECT arrdate AS date FROM fact UNION ALL SELECT depdate FROM fact)
          WHERE date IS NOT NULL)
    SELECT CAST(date AS VARCHAR) AS date, CAST(day(date) AS INTEGER) AS "day", CAST(month(date) AS INTEGER) AS "month",
           CAST(year(date) AS INTEGER) AS "year", CAST(week(date) AS INTEGER) AS week,
           CAST(dayofweek(date) + 1 AS INTEGER) AS weekday, CAST(dayofyear(date) AS INTEGER) AS yearday
    FROM d""",
)
def imm_dates(spark, sf_dir):
    dates = immigration.dates(immigration.arrivals(standins.arrivals(spark, sf_dir)))
    return dates.withColumn("date", F.col("date").cast("string"))


@query(
    "imm_mart_report",
    f"""WITH {ENRICHED_SQL}, {CLIMATE_SQL.replace("cities AS", "places AS").replace("FROM cities", "FROM places")},
    {AIRPORTS_SQL.replace("airports AS", "airport_file AS")},
    days AS (SELECT arrdate AS date FROM fact UNION SELECT depdate FROM fact)
    SELECT 'i94' AS table_name, count(*) AS row_count, true AS passed FROM fact
    UNION ALL SELECT 'date', count(date), true FROM days
    UNION ALL SELECT 'us_states_temperature', count(*), true FROM (SELECT DISTINCT state FROM kept
      LEFT JOIN city_state ON kept.City = city_state.city WHERE Country = 'Home')
    UNION ALL SELECT 'world_temperature', count(DISTINCT Country), true FROM kept
    UNION ALL SELECT 'airport', count(*), true FROM airport_file WHERE iata_code IS NOT NULL AND iso_country = 'US'
    UNION ALL SELECT 'demographic', count(DISTINCT c_nationkey), true FROM customer
      WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
)
def imm_mart_report(spark, sf_dir):
    """Files of every source to CSV tables to typed, checked tables."""
    root = scratch_path(spark, "immigration")
    paths = {name: f"{root}/in/{name}" for name in immigration_mart.INPUT_NAMES}
    standins.arrivals(spark, sf_dir).write.parquet(paths["arrivals"])
    codes = standins.arrival_lookups(spark, sf_dir)
    for lookup in ("airport", "country", "mode", "visa"):
        plural = {"country": "countries"}.get(lookup, f"{lookup}s")
        codes[plural].write.csv(paths[f"{lookup}_codes"], header=True)
    climate_sources = standins.climate(spark, sf_dir)
    write_csv(climate_sources["readings"], paths["temperatures"])
    write_csv(climate_sources["cities"], paths["cities"])
    write_csv(standins.airport_source(spark, sf_dir), paths["airports"])
    write_csv(standins.demographics(spark, sf_dir), paths["demographics"], sep=";")
    database = f"immigration_{uuid.uuid4().hex}"
    create_namespace(spark, database, f"{root}/db")
    immigration_mart.build(spark, immigration_mart.Inputs(**paths), f"{root}/out", country="Home")
    return immigration_mart.publish(spark, f"{root}/out", database, f"{root}/tables")


# Climate, airports, demographics


@query(
    "temp_by_state",
    f"""WITH {CLIMATE_SQL}
    SELECT state, round(avg(v), 4) AS average_temperature
    FROM kept LEFT JOIN city_state ON kept.City = city_state.city WHERE Country = 'Home' GROUP BY state""",
)
def temp_by_state(spark, sf_dir):
    sources = standins.climate(spark, sf_dir)
    means = climate.by_state(sources["readings"], sources["cities"], country="Home")
    return means.withColumn("average_temperature", F.round("average_temperature", 4))


@query(
    "temp_by_country",
    f"""WITH {CLIMATE_SQL}
    SELECT Country AS country, round(avg(v), 4) AS average_temperature FROM kept GROUP BY Country""",
)
def temp_by_country(spark, sf_dir):
    means = climate.by_country(standins.climate(spark, sf_dir)["readings"])
    return means.withColumn("average_temperature", F.round("average_temperature", 4))


@query(
    "temp_by_state_code",
    f"""WITH {CLIMATE_SQL},
    placed AS (SELECT *, (date, kept.City, Latitude, Longitude) AS o
               FROM kept JOIN city_state ON kept.City = city_state.city WHERE Country = 'Home')
    SELECT Code AS state, round(avg(v), 4) AS average_temperature, arg_min(Latitude, o) AS "Latitude",
           arg_min(Longitude, o) AS "Longitude"
    FROM placed JOIN abbreviations ON placed.state = abbreviations.State GROUP BY Code""",
)
def temp_by_state_code(spark, sf_dir):
    sources = standins.climate(spark, sf_dir)
    means = climate.by_state_code(
        sources["readings"], sources["cities"], sources["abbreviations"], country="Home"
    )
    return means.withColumn("average_temperature", F.round("average_temperature", 4))


@query(
    "temp_by_country_position",
    f"""WITH {CLIMATE_SQL},
    valued AS (SELECT *, CAST(AverageTemperature AS DOUBLE) AS v, (dt, City, Latitude, Longitude) AS o
               FROM readings WHERE AverageTemperature IS NOT NULL)
    SELECT Country AS country, round(avg(v), 4) AS average_temperature, arg_min(Latitude, o) AS "Latitude",
           arg_min(Longitude, o) AS "Longitude"
    FROM valued GROUP BY Country""",
)
def temp_by_country_position(spark, sf_dir):
    means = climate.by_country_position(standins.climate(spark, sf_dir)["readings"])
    return means.withColumn("average_temperature", F.round("average_temperature", 4))


@query(
    "airport_dim",
    f"""WITH {AIRPORTS_SQL}
    SELECT replace(name, ',', ' ') AS name, iso_country, replace(municipality, ',', ' ') AS municipality, iata_code,
           nullif(split_part(iso_region, '-', 2), '') AS state
    FROM airports WHERE iata_code IS NOT NULL AND iso_country = 'US'""",
)
def airport_dim(spark, sf_dir):
    path = scratch_path(spark, "airport")
    write_csv(airports.airports(standins.airport_source(spark, sf_dir)), path, sep=";")
    return read_csv(
        spark, path, "name string, iso_country string, municipality string, iata_code string, state string", sep=";"
    )


def _race_sql(race: str, name: str, total: bool) -> str:
    if total:
        return f"sum({name}) AS {name}"
    return f"""min(CAST("Count" AS DOUBLE)) FILTER ("Race" = '{race}') AS {name}"""


@query(
    "demographics_by_state",
    f"""WITH {DEMOGRAPHICS_SQL},
    city AS (SELECT * EXCLUDE ("Race", "Count"), {", ".join(_race_sql(r, n, False) for r, n in RACES.items())}
             FROM lines GROUP BY ALL)
    SELECT "State" AS state, "State Code" AS state_code, round(avg("Median Age"::DOUBLE), 6) AS median_age,
           sum("Male Population"::DOUBLE) AS male_population, sum("Female Population"::DOUBLE) AS female_population,
           sum("Total Population"::DOUBLE) AS total_population, sum("Number of Veterans"::DOUBLE) AS number_of_veterans,
           sum("Foreign-born"::DOUBLE) AS foreignborn,
           round(avg("Average Household Size"::DOUBLE), 6) AS average_household_size,
           {", ".join(_race_sql(r, n, True) for r, n in RACES.items())}
    FROM city GROUP BY ALL""",
)
def demographics_by_state(spark, sf_dir):
    path = scratch_path(spark, "demographics")
    write_csv(standins.demographics(spark, sf_dir), path, sep=";")
    states = demographics.by_state(read_csv(spark, path, sep=";"))
    return states.withColumns(
        {c: F.round(c, 6) for c in ("median_age", "average_household_size")}
    )
