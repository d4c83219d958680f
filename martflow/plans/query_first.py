"""Event tables laid out for one question each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.aggregates import one_row_per_key
from martflow.operators.filters import lookup, not_blank
from martflow.schemas import EVENT_COLUMNS, EVENT_CSV, QUERY_FIRST
from martflow.sinks.tables import schema_of, write_distributed
from martflow.sinks.writers import write_csv
from martflow.sources.readers import read_csv


def song_events(events: DataFrame) -> DataFrame:
    """Rows that name an artist, with the columns the tables draw on."""
    return not_blank(events, "artist").select(*EVENT_COLUMNS)


def consolidate(spark: SparkSession, csv_dir: str, out: str) -> DataFrame:
    """Write the song events of all CSV files as one fully quoted data set."""
    events = song_events(read_csv(spark, csv_dir, EVENT_CSV))
    write_csv(events, out, quote_all=True)
    return read_csv(spark, out, events.schema, multi_line=True)


def table(events: DataFrame, name: str, order_by: list[str] | None = None) -> DataFrame:
    """The rows of one table: typed, one per key, the last write winning.

    ``order_by`` states the order of the writes. Without it, rows of the same
    key are ordered by their own values.
    """
    ddl, partition_key, clustering_key = QUERY_FIRST[name]
    fields = schema_of(ddl).fields
    keys = [*partition_key, *clustering_key]
    order = order_by or []
    typed = events.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields],
        *[F.col(c).alias(f"_order_{c}") for c in order],
    )
    latest = one_row_per_key(typed, keys, [f"_order_{c}" for c in order])
    return latest.select(*[f.name for f in fields])


def write_table(
    rows: DataFrame, name: str, catalog_name: str, location: str, buckets: int, layout: str = "ranged"
) -> None:
    """Lay a table out by its partition key, sorted by its whole key."""
    _, partition_key, clustering_key = QUERY_FIRST[name]
    write_distributed(
        rows, catalog_name, location, partition_key[0], [*partition_key, *clustering_key], buckets, layout
    )


def heard_in_session(history: DataFrame, session: int, item: int) -> DataFrame:
    """What was heard at one place of a session."""
    return lookup(history, {"sessionId": session, "itemInSession": item}, ["artist", "song", "length"])


def heard_by_user(plays: DataFrame, user: int, session: int) -> DataFrame:
    """A user's songs in a session, in order."""
    found = lookup(plays, {"userId": user, "sessionId": session})
    return found.orderBy("itemInSession").select(
        "itemInSession", "artist", "song", "firstName", "lastName"
    )


def listeners(users: DataFrame, song: str) -> DataFrame:
    """Everyone who heard a song."""
    return lookup(users, {"song": song}, ["firstName", "lastName"])
