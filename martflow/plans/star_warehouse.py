"""Star schema, set-based: staged log and catalogue in, five tables out.

Takes the staged log (``schemas.STAGED_LOG``) and the song catalogue
(``schemas.SONG_FILE``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.keys import dense_ids, unique_ids
from martflow.functions.text import blank_to_null
from martflow.functions.timeparts import clock_parts
from martflow.operators.aggregates import distinct_rows, one_row_per_key
from martflow.operators.columns import change_columns, select_as
from martflow.operators.filters import of_kind, present
from martflow.operators.joins import Join, equi_join
from martflow.schemas import SONG_FILE, SONG_PLAY, STAGED_LOG
from martflow.session import folder_exists
from martflow.sinks.writers import load
from martflow.sources.staging import stage_json_auto, stage_json_paths

USER_NAMES = {
    "userId": "user_id",
    "firstName": "first_name",
    "lastName": "last_name",
    "gender": "gender",
    "level": "level",
}
ARTIST_NAMES = {
    "artist_id": "artist_id",
    "artist_name": "name",
    "artist_location": "location",
    "artist_latitude": "latitude",
    "artist_longitude": "longitude",
}
PLAY_COLUMNS = [
    "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent",
]
SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]


def songplays(
    log: DataFrame, catalogue: DataFrame, ids: str | None = None, join: Join = equi_join, start: int = 0
) -> DataFrame:
    """Plays of catalogue songs; the location is the artist's.

    ``ids`` adds ``songplay_id``: "dense" numbers plays from ``start`` in time
    order, "unique" leaves gaps but needs no shuffle.
    """
    plays = of_kind(log, "page", SONG_PLAY).select(
        F.col("ts").alias("start_time"), F.col("userId").alias("user_id"), "level", "song", "artist",
        F.col("sessionId").alias("session_id"), F.col("userAgent").alias("user_agent"),
    )
    known = catalogue.select(
        "title", "artist_name", "song_id", "artist_id", F.col("artist_location").alias("location")
    )
    matched = join(plays, known, {"song": "title", "artist": "artist_name"}, "inner")
    fact = distinct_rows(matched, PLAY_COLUMNS)
    if ids == "dense":
        return dense_ids(fact, "songplay_id", fact.columns, start)
    return unique_ids(fact, "songplay_id") if ids == "unique" else fact


def users(log: DataFrame, policy: str = "distinct") -> DataFrame:
    """Users seen playing songs; a blank id is no user.

    "distinct" keeps a row per combination of attributes, so a user who
    changed level has two; "latest" keeps the last row of each user.
    """
    plays = present(change_columns(of_kind(log, "page", SONG_PLAY), ["userId"], blank_to_null), "userId")
    if policy == "latest":
        named = select_as(plays, {**USER_NAMES, "ts": "ts"})
        return one_row_per_key(named, ["user_id"], ["ts"]).drop("ts")
    return select_as(plays, USER_NAMES).distinct()


def songs(catalogue: DataFrame) -> DataFrame:
    return distinct_rows(present(catalogue, "song_id"), SONG_COLUMNS)


def artists(catalogue: DataFrame, policy: str = "distinct") -> DataFrame:
    """Artists of the catalogue; "latest" keeps one row per artist."""
    named = select_as(present(catalogue, "artist_id"), ARTIST_NAMES)
    return one_row_per_key(named, ["artist_id"], []) if policy == "latest" else named.distinct()


def times(plays: DataFrame, weekday_as: str = "sunday0") -> DataFrame:
    """One row per start time of the fact."""
    moments = present(plays.select("start_time"), "start_time").distinct()
    return moments.withColumns(clock_parts(F.col("start_time"), weekday_as))


def run(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    out: str,
    json_paths: Mapping[str, str],
    truncate: bool = True,
    join: Join = equi_join,
) -> dict[str, DataFrame]:
    """Stage both JSON trees and load the five tables below ``out``.

    The log is staged through ``json_paths`` (column → path), songs by name.
    The staged rows are written before they are used, so the files are parsed
    once; the time dimension is derived from the written fact. With
    ``truncate=False`` rows are added to those of earlier runs, and ids go on
    after the largest so far.
    """
    written: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame, replace: bool = truncate) -> DataFrame:
        load(df, f"{out}/{name}", replace)
        written[name] = spark.read.parquet(f"{out}/{name}")
        return written[name]

    staged_log = stage_json_paths(spark, log_path, STAGED_LOG, json_paths, epoch_ms=["ts"])
    log = write("staging_events", staged_log, True)
    catalogue = write("staging_songs", stage_json_auto(spark, song_path, SONG_FILE), True)
    start = 0
    if not truncate and folder_exists(spark, f"{out}/songplays"):
        earlier = spark.read.parquet(f"{out}/songplays").agg(F.max("songplay_id")).first()[0]
        start = 0 if earlier is None else earlier + 1
    plays = write("songplays", songplays(log, catalogue, ids="dense", join=join, start=start))
    write("users", users(log))
    write("songs", songs(catalogue))
    write("artists", artists(catalogue))
    write("time", times(plays))
    return written
