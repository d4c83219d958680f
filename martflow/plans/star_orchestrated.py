"""Star schema in ordered steps: stage, fact, dimensions, gate.

Takes the log as it is on disk (``schemas.LOG_FILE``, ts in epoch
milliseconds) and the song catalogue (``schemas.SONG_FILE``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.keys import md5_key
from martflow.functions.timeparts import clock_parts, from_epoch_ms
from martflow.operators.aggregates import distinct_rows
from martflow.operators.columns import select_as
from martflow.operators.filters import of_kind
from martflow.operators.joins import Join, equi_join, left_join_numeric
from martflow.plans.star_warehouse import ARTIST_NAMES, SONG_COLUMNS, USER_NAMES
from martflow.schemas import SONG_PLAY


def songplays(
    log: DataFrame, catalogue: DataFrame, length_scale: int = 5, join: Join = equi_join
) -> DataFrame:
    """Every play, with the ids of songs that match in title, artist and length.

    ``length_scale`` is the number of decimals lengths are compared to; 0
    compares whole seconds, as integer warehouse columns do.
    """
    played = of_kind(log, "page", SONG_PLAY).withColumn(
        "start_time", from_epoch_ms(F.col("ts"), whole_seconds=True)
    )
    known = catalogue.select("title", "artist_name", "duration", "song_id", "artist_id")
    matched = left_join_numeric(
        played, known, {"song": "title", "artist": "artist_name"}, ("length", "duration"), length_scale, join
    )
    return matched.select(
        md5_key(F.col("sessionId"), F.col("start_time")).alias("playid"),
        "start_time",
        F.col("userId").alias("userid"),
        "level",
        F.col("song_id").alias("songid"),
        F.col("artist_id").alias("artistid"),
        F.col("sessionId").alias("sessionid"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def users(log: DataFrame) -> DataFrame:
    return select_as(of_kind(log, "page", SONG_PLAY), USER_NAMES).distinct()


def songs(catalogue: DataFrame) -> DataFrame:
    return distinct_rows(catalogue, SONG_COLUMNS)


def artists(catalogue: DataFrame) -> DataFrame:
    return select_as(catalogue, ARTIST_NAMES).distinct()


def times(plays: DataFrame) -> DataFrame:
    """One row per play, repeated times included; Sunday is day 0."""
    return plays.select("start_time").withColumns(clock_parts(F.col("start_time"), "sunday0"))
