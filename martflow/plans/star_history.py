"""Users with the history of their attributes, and plays with the user as of their time.

The other star schemas keep one row per user, or one per combination of
attributes seen; here a user's level at any time can be told.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.keys import md5_key
from martflow.functions.text import blank_to_null
from martflow.operators.columns import change_columns, select_as
from martflow.operators.filters import of_kind
from martflow.operators.history import as_of, versions
from martflow.plans.star_warehouse import USER_NAMES
from martflow.schemas import SONG_PLAY

USER_ATTRIBUTES = ["first_name", "last_name", "gender", "level"]


def users(log: DataFrame, buckets: int | None = None) -> DataFrame:
    """Versions of every user over all lines of the log, each with a key of its own."""
    lines = change_columns(log, ["userId"], blank_to_null)
    seen = select_as(lines, {**USER_NAMES, "ts": "ts"})
    history = versions(seen, ["user_id"], "ts", USER_ATTRIBUTES, buckets=buckets)
    return history.select(md5_key(F.col("user_id"), F.col("valid_from")).alias("user_key"), "*")


def plays(log: DataFrame, users: DataFrame, buckets: int | None = None) -> DataFrame:
    """Song plays with the key and attributes of the user's version at their time."""
    played = of_kind(change_columns(log, ["userId"], blank_to_null), "page", SONG_PLAY).select(
        F.col("ts").alias("start_time"), F.col("userId").alias("user_id"), F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item"), "song", "artist", "location",
    )
    return as_of(played, users, ["user_id"], "start_time", ["user_key", *USER_ATTRIBUTES, "valid_from"], buckets=buckets)
