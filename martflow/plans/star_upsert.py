"""Star schema kept up to date by keyed upserts.

Every table is merged with what it held before, so a load can be repeated and
logs can arrive in any number of pieces.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.keys import dense_ids
from martflow.functions.text import blank_to_null
from martflow.functions.timeparts import clock_parts
from martflow.operators.columns import change_columns, select_as
from martflow.operators.filters import of_kind, present
from martflow.operators.joins import Join, equi_join, resolve
from martflow.operators.pruning import PRUNE_FROM, estimated_bytes, held_rows
from martflow.operators.upsert import absent_rows, upsert_columns, upsert_do_nothing
from martflow.plans.star_warehouse import ARTIST_NAMES, PLAY_COLUMNS, SONG_COLUMNS, USER_NAMES
from martflow.schemas import SONG_PLAY
from martflow.session import materialize
from martflow.sinks.tables import keep_number, last_number, replace_table
from martflow.sinks.writers import load_table

# What tells a play, and where the log has it.
PLAY_NAMES = {
    "start_time": "ts", "user_id": "userId", "session_id": "sessionId", "level": "level", "location": "location",
    "user_agent": "userAgent",
}
PLAY_KEY = list(PLAY_NAMES)

# What a load reads of a log.
LOG_COLUMNS = ["page", *PLAY_NAMES.values(), "firstName", "lastName", "gender", "song", "artist", "length"]


def _plays(log: DataFrame) -> DataFrame:
    return of_kind(log, "page", SONG_PLAY)


def songs(target: DataFrame, catalogue: DataFrame) -> DataFrame:
    """All songs, not just the first of each file; a known song stays as it is."""
    return upsert_do_nothing(target, catalogue.select(*SONG_COLUMNS), ["song_id"], [])


def artists(target: DataFrame, catalogue: DataFrame) -> DataFrame:
    return upsert_do_nothing(target, select_as(catalogue, ARTIST_NAMES), ["artist_id"], [])


def users(target: DataFrame, log: DataFrame) -> DataFrame:
    """A known user keeps every attribute but the level, which is the last seen."""
    plays = change_columns(_plays(log), ["userId"], blank_to_null)
    seen = select_as(present(plays, "userId"), {**USER_NAMES, "ts": "ts"})
    return upsert_columns(target, seen, ["user_id"], ["level"], ["ts"])


def new_times(target: DataFrame, log: DataFrame, prune: bool = False) -> DataFrame:
    """Start times the target lacks, broken into parts; Monday is day 0."""
    moments = present(_plays(log).select(F.col("ts").alias("start_time")), "start_time")
    new = absent_rows(target.select("start_time"), moments, ["start_time"], [], prune)
    return new.withColumns(clock_parts(F.col("start_time"), "monday0"))


def times(target: DataFrame, log: DataFrame) -> DataFrame:
    return target.unionByName(new_times(target, log))


def new_plays(known: DataFrame, log: DataFrame, prune: bool = False) -> DataFrame:
    """The log's plays that the fact does not hold yet, told by ``PLAY_KEY``.

    With ``prune`` only rows of the fact that may be among them leave its scan;
    the log, which should be a staged one, is read a few times for it. Equal
    plays of one delivery are all kept.
    """
    plays = _plays(log)
    named = {c: plays[PLAY_NAMES[c]] for c in PLAY_KEY}
    held = known.select(*PLAY_KEY)
    if prune:
        held = held_rows(held, plays.select(*[column.alias(c) for c, column in named.items()]), PLAY_KEY)
    # Names of their own on one side, as plays and fact share some.
    held = held.toDF(*[f"held_{c}" for c in PLAY_KEY])
    same = [column.eqNullSafe(F.col(f"held_{c}")) for c, column in named.items()]
    return plays.join(held, reduce(and_, same), "left_anti")


def songplays(
    log: DataFrame, songs: DataFrame, artists: DataFrame, start: int = 1, join: Join = equi_join,
    known: DataFrame | None = None, prune: bool = False,
) -> DataFrame:
    """Every play, with the song's and artist's ids or nulls, numbered from
    ``start``. Plays that the fact ``known`` holds already are left out before
    their songs are looked up."""
    plays = _plays(log)
    if known is not None:
        # Written, as the range sort that numbers plays first takes a sample of them.
        plays = materialize(new_plays(known, log, prune), "new-plays")
    named = artists.select("artist_id", F.col("name").alias("artist_name"))
    catalogue = songs.select("song_id", "title", "duration", "artist_id").join(named, "artist_id")
    resolved = resolve(
        plays,
        catalogue,
        {"song": "title", "artist": "artist_name"},
        ("length", "duration"),
        ["song_id", "artist_id"],
        join=join,
    )
    named = [F.col(PLAY_NAMES[c]).alias(c) for c in PLAY_KEY]
    return dense_ids(resolved.select(*named, "song_id", "artist_id").select(*PLAY_COLUMNS), "songplay_id", PLAY_COLUMNS, start)


def load(
    spark: SparkSession, log: DataFrame, catalogue: DataFrame, tables: Mapping[str, str], root: str, delivery: str,
    join: Join = equi_join, prune_from: int = PRUNE_FROM,
) -> None:
    """Bring the five catalog tables up to date with one delivery.

    ``tables`` maps the names of ``schemas.STAR`` to catalog tables and
    ``delivery`` is part of the names of directories made below ``root``.
    Songs, artists and times only gain rows, so only new rows are written;
    users, whose level changes, are rewritten. Tables that do not need each
    other are loaded side by side. The delivery is read for each table, so it
    should be a staged one. Of a table whose keys take ``prune_from`` bytes or
    more only rows that may have a key of the delivery leave the scan; smaller
    ones are not worth the passes over the delivery.

    A delivery that comes again, whole or in part, adds no play twice: plays
    are told by ``PLAY_KEY``, what the log itself says of them, and equal plays
    within one delivery are all kept. Their numbers go on from a mark kept with
    the table and moved before they are written: a load that fails leaves a
    gap, never a number given twice.
    """
    current = {name: spark.table(table) for name, table in tables.items()}

    def append(name: str, rows: DataFrame) -> DataFrame:
        load_table(rows.select(*current[name].columns), tables[name], truncate=False)
        spark.catalog.refreshTable(tables[name])
        return spark.table(tables[name])

    def large(name: str, *keys: str) -> bool:
        return estimated_bytes(current[name].select(*keys)) >= prune_from

    def load_songs() -> DataFrame:
        new = absent_rows(current["songs"], catalogue.select(*SONG_COLUMNS), ["song_id"], [], large("songs", "song_id"))
        return append("songs", new)

    def load_artists() -> DataFrame:
        named = select_as(catalogue, ARTIST_NAMES)
        return append("artists", absent_rows(current["artists"], named, ["artist_id"], [], large("artists", "artist_id")))

    def load_time() -> None:
        append("time", new_times(current["time"], log, large("time", "start_time")))

    def load_users() -> None:
        replace_table(users(current["users"], log), tables["users"], f"{root}/users-{delivery}-{uuid4().hex}")

    with ThreadPoolExecutor(4) as pool:
        steps = [pool.submit(inheritable_thread_target(spark)(step)) for step in (load_songs, load_artists, load_time, load_users)]
        all_songs, all_artists = steps[0].result(), steps[1].result()
        so_far = last_number(spark, tables["songplays"], "songplay_id")
        known, prune = current["songplays"], large("songplays", *PLAY_KEY)
        plays = songplays(log, all_songs, all_artists, so_far + 1, join, known, prune)
        keep_number(spark, tables["songplays"], so_far + plays.count())
        append("songplays", plays)
        for step in steps:
            step.result()
