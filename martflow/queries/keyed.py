"""B7, B8, B11-B13: generated keys and keyed loads.

The keyed loads split the events at the middle of their month: the earlier
half is the target, the later half arrives.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.functions.keys import dense_ids, md5_key, unique_ids
from martflow.operators.aggregates import one_row_per_key
from martflow.operators.upsert import (
    absent_rows,
    reduce_updates,
    upsert_columns,
    upsert_do_nothing,
    upsert_rows,
)
from martflow.queries.registry import query, table
from martflow.session import scratch_path
from martflow.sinks.bucketed import upsert_bucketed, write_bucketed
from martflow.sinks.writers import merge_partitions, write_parquet
from martflow.sources.readers import read_partitioned

MIDDLE = "2024-01-16"
ARRIVAL = ["ts", "event_id"]


@query(
    "surrogate_key_dense",
    """SELECT o_orderkey, o_orderdate,
              row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS order_id
       FROM orders""",
)
def surrogate_key_dense(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dense_ids(orders, "order_id", ["o_orderdate", "o_orderkey"])


@query(
    "surrogate_key_unique",
    """SELECT count(*) AS n, count(*) AS distinct_ids, count(DISTINCT l_orderkey) AS orders FROM lineitem""",
)
def surrogate_key_unique(spark, sf_dir):
    numbered = unique_ids(table(spark, sf_dir, "lineitem").select("l_orderkey"), "line_id")
    return numbered.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("line_id").alias("distinct_ids"),
        F.countDistinct("l_orderkey").alias("orders"),
    )


@query(
    "hash_key_md5",
    "SELECT event_id, md5(CAST(user_id AS VARCHAR) || CAST(ts AS VARCHAR)) AS event_key FROM events",
)
def hash_key_md5(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", md5_key(F.col("user_id"), F.col("ts")).alias("event_key"))


def _halves(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    middle = F.lit(MIDDLE).cast("timestamp_ntz")
    return events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)


@query(
    "upsert_do_nothing",
    """SELECT user_id, ts, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def upsert_do_nothing_query(spark, sf_dir):
    earlier, later = _halves(spark, sf_dir)
    target = one_row_per_key(earlier, ["user_id"], ARRIVAL, latest=False)
    return upsert_do_nothing(target, later, ["user_id"], ARRIVAL)


LINE_KEY = ["l_shipdate", "l_orderkey", "l_linenumber"]


@query(
    "upsert_pruned_target",
    """SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-07'
          OR l_shipdate BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '1995-06-03'
       QUALIFY (l_shipdate, l_orderkey, l_linenumber) NOT IN
                 (SELECT (l_shipdate, l_orderkey, l_linenumber) FROM lineitem WHERE l_linenumber <> 3)
           AND row_number() OVER (PARTITION BY l_shipdate, l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity) = 1""",
)
def upsert_pruned_target(spark, sf_dir):
    """A week's lines and some late ones, of which the table of all years holds most already."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_quantity")
    path = scratch_path(spark, "lines-by-day")
    lines.where("l_linenumber <> 3").repartitionByRange(16, *LINE_KEY).sortWithinPartitions(*LINE_KEY).write.parquet(path)
    delivery = lines.where(
        "l_shipdate BETWEEN TIMESTAMP_NTZ '1998-01-01' AND TIMESTAMP_NTZ '1998-01-07' "
        "OR l_shipdate BETWEEN TIMESTAMP_NTZ '1995-06-01' AND TIMESTAMP_NTZ '1995-06-03'"
    )
    return absent_rows(spark.read.parquet(path), delivery, LINE_KEY, ["l_partkey"], prune=True)


@query(
    "upsert_update_columns",
    """SELECT user_id, arg_min(value, (ts, event_id)) AS value,
              arg_max(event_type, (ts, event_id)) AS event_type
       FROM events GROUP BY user_id""",
)
def upsert_update_columns(spark, sf_dir):
    earlier, later = _halves(spark, sf_dir)
    target = reduce_updates(earlier, ["user_id"], ["event_type"], ARRIVAL)
    return upsert_columns(target, later, ["user_id"], ["event_type"], ARRIVAL)


@query(
    "upsert_touched_partitions",
    """SELECT user_id, event_type, CAST(week(ts) AS INTEGER) AS week, min(ts) AS ts, arg_min(value, (ts, event_id)) AS value
       FROM events GROUP BY ALL""",
)
def upsert_touched_partitions(spark, sf_dir):
    """First event per user, kind and week, in a table partitioned by week."""
    path = scratch_path(spark, "by-week")
    keys = ["user_id", "event_type", "week"]
    schema = "user_id bigint, event_type string, ts timestamp_ntz, event_id bigint, value double, week int"
    earlier, later = (half.withColumn("week", F.weekofyear("ts")) for half in _halves(spark, sf_dir))
    write_parquet(one_row_per_key(earlier, keys, ARRIVAL, latest=False), path, ["week"])
    merge_partitions(
        read_partitioned(spark, path, schema),
        later,
        path,
        ["week"],
        lambda target, incoming: upsert_do_nothing(target, incoming, keys, ARRIVAL),
    )
    return read_partitioned(spark, path, schema).drop("event_id")


@query(
    "upsert_last_write_wins",
    """SELECT user_id, event_type, ts, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def upsert_last_write_wins(spark, sf_dir):
    keys = ["user_id", "event_type"]
    earlier, later = _halves(spark, sf_dir)
    return upsert_rows(one_row_per_key(earlier, keys, ARRIVAL), later, keys, ARRIVAL)


@query(
    "upsert_bucketed",
    """SELECT user_id, event_type, arg_min(value, (ts, event_id)) AS value, max(ts) AS ts FROM events
       GROUP BY user_id, event_type""",
)
def upsert_bucketed_query(spark, sf_dir):
    """Per user and kind the first value and the last time, in hash buckets that four deliveries touch."""
    path, keys = scratch_path(spark, "buckets"), ["user_id", "event_type"]
    schema = "user_id bigint, event_type string, value double, ts timestamp_ntz"
    events = table(spark, sf_dir, "events").select(*keys, "value", "ts", "event_id").withColumn("seen", F.struct("ts", "event_id"))
    parts = [F.dayofmonth("ts") < 8, F.dayofmonth("ts").between(8, 24), F.dayofmonth("ts") == 25, F.dayofmonth("ts") > 25]
    first = reduce_updates(events.where(parts[0]).drop("event_id"), keys, ["ts"], ["seen"])
    write_bucketed(first.select(*keys, "value", "ts"), path, keys, 16)
    found = None
    for part in parts[1:]:
        delivery = events.where(part).drop("event_id")
        found = upsert_bucketed(spark, path, schema, delivery, upsert_columns, ["ts"], ["seen"])
    return found
