"""Star schema as partitioned Parquet directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.keys import unique_ids
from martflow.functions.timeparts import format_start_time, from_epoch_ms, padded_parts, weekday
from martflow.operators.aggregates import distinct_rows
from martflow.operators.columns import select_as
from martflow.operators.filters import of_kind
from martflow.operators.joins import Join, equi_join
from martflow.plans.star_warehouse import ARTIST_NAMES, USER_NAMES
from martflow.schemas import LOG_FILE, SONG_FILE, SONG_PLAY
from martflow.session import materialize
from martflow.sinks.writers import write_parquet
from martflow.sources.readers import read_json, read_partitioned

TIME_COLUMNS = ["start_time", "hour", "day", "week", "month", "year", "weekday"]
PLAY_FIELDS = [
    *TIME_COLUMNS, "userId", "firstName", "lastName", "gender", "level",
    "song", "artist", "sessionId", "location", "userAgent",
]
SONGS = "song_id string, title string, artist_id string, artist_name string, duration double, year int"


def songs(catalogue: DataFrame) -> DataFrame:
    """Distinct songs under the ids they came with."""
    return catalogue.select(
        "song_id", "title", "artist_id", "artist_name", "duration", "year"
    ).distinct()


def artists(catalogue: DataFrame) -> DataFrame:
    return select_as(catalogue, ARTIST_NAMES).distinct()


def plays(log: DataFrame, text_time: bool = False) -> DataFrame:
    """Song plays with their start time and its padded text parts.

    The start time is a timestamp; ``text_time`` renders it as text, to the
    second.
    """
    moment = from_epoch_ms(F.col("ts"))
    return of_kind(log, "page", SONG_PLAY).withColumns(
        {
            "start_time": format_start_time(moment) if text_time else moment,
            **padded_parts(moment),
            "week": F.weekofyear(moment).cast("string"),
            "weekday": weekday(moment, "name"),
        }
    )


def users(played: DataFrame) -> DataFrame:
    return select_as(played, USER_NAMES).distinct()


def times(played: DataFrame) -> DataFrame:
    return distinct_rows(played, TIME_COLUMNS)


def songplays(played: DataFrame, songs: DataFrame, join: Join = equi_join) -> DataFrame:
    """Plays of known songs; the location is the listener's."""
    known = songs.select("title", "artist_name", "song_id", "artist_id")
    return join(played, known, {"song": "title", "artist": "artist_name"}, "inner").select(
        "year", "month", "start_time", F.col("userId").alias("user_id"), "level", "song_id", "artist_id",
        F.col("sessionId").alias("session_id"), "location", F.col("userAgent").alias("user_agent"),
    )


def run(spark: SparkSession, song_path: str, log_path: str, out: str, text_time: bool = False) -> None:
    """Read both JSON trees and write the five tables below ``out``.

    The plays feed three tables. They are parsed once and staged as columns
    in the shared folder, where each table reads only those it needs. Songs
    are partitioned by year, times and plays by year and month.
    """
    catalogue = read_json(spark, song_path, SONG_FILE)
    write_parquet(songs(catalogue), f"{out}/songs", ["year"])
    write_parquet(artists(catalogue), f"{out}/artists")
    log = read_json(spark, log_path, LOG_FILE)
    played = materialize(plays(log, text_time).select(*PLAY_FIELDS), "plays")
    write_parquet(users(played), f"{out}/users")
    write_parquet(times(played), f"{out}/time", ["year", "month"])
    known = read_partitioned(spark, f"{out}/songs", SONGS)
    by_month = songplays(played, known).hint("rebalance", "year", "month")
    fact = unique_ids(by_month, "songplay_id")
    write_parquet(fact, f"{out}/songplays", ["year", "month"], gather=False)
