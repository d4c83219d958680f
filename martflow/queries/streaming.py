"""K: incremental staging, in two deliveries with a repeated run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from martflow.operators.upsert import upsert_columns, upsert_do_nothing
from martflow.queries.keyed import MIDDLE
from martflow.queries.registry import query, table
from martflow.session import scratch_path
from martflow.sinks.tables import create_table
from martflow.streaming.dedupe import stage_deduplicated
from martflow.streaming.incremental import (
    merge_partitions_incrementally,
    stage_incrementally,
    upsert_incrementally,
)

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _deliveries(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    early = F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")
    return events.where(early), events.where(~early)


@query("incremental_stage", "SELECT event_id, ts, user_id, event_type, value FROM events")
def incremental_stage(spark, sf_dir):
    root = scratch_path(spark, "stream")
    source = f"{root}/source"
    staged = None
    for delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing new
            staged = stage_incrementally(
                spark, source, "parquet", SCHEMA, f"{root}/staged", f"{root}/progress"
            )
    return staged


@query(
    "incremental_upsert",
    """SELECT user_id, arg_min(value, (ts, event_id)) AS value,
              arg_max(event_type, (ts, event_id)) AS event_type
       FROM events GROUP BY user_id""",
)
def incremental_upsert(spark, sf_dir):
    root = scratch_path(spark, "stream")
    source, name = f"{root}/source", f"users_{uuid.uuid4().hex}"
    create_table(spark, name, "user_id bigint, value double, event_type string", f"{root}/empty")

    def merge(target, incoming):
        return upsert_columns(target, incoming, ["user_id"], ["event_type"], ["ts", "event_id"])

    merged = None
    for delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").parquet(source)
        for _ in range(2):
            merged = upsert_incrementally(
                spark, source, "parquet", SCHEMA, name, f"{root}/versions", f"{root}/progress", merge
            )
    return merged


@query(
    "incremental_partitions",
    """SELECT user_id, CAST(week(ts) AS INTEGER) AS week, arg_min(event_type, (ts, event_id)) AS event_type,
              arg_min(value, (ts, event_id)) AS value
       FROM events GROUP BY ALL""",
)
def incremental_partitions(spark, sf_dir):
    """First event per user and week; the week the deliveries share is merged."""
    root = scratch_path(spark, "stream")
    source = f"{root}/source"
    keys = ["user_id", "week"]

    def prepare(batch):
        return batch.withColumn("week", F.weekofyear("ts"))

    def merge(target, incoming):
        return upsert_do_nothing(target, incoming, keys, ["ts", "event_id"])

    merged = None
    for delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").parquet(source)
        for _ in range(2):
            merged = merge_partitions_incrementally(
                spark, source, "parquet", SCHEMA, f"{root}/by-week", f"{SCHEMA}, week int", ["week"],
                f"{root}/progress", prepare, merge,
            )
    return merged.drop("event_id", "ts")


def _exports(spark, sf_dir):
    """January's events in four exports that overlap, the last of which brings the first days again."""
    day = F.dayofmonth("ts")
    events = table(spark, sf_dir, "events").drop("props")
    return [events.where(part) for part in (day <= 12, day.between(9, 20), day.between(20, 31), day <= 3)]


def _deduplicated(spark, sf_dir):
    root, found = scratch_path(spark, "stream"), None
    for export in _exports(spark, sf_dir):
        export.write.mode("append").parquet(f"{root}/source")
        for _ in range(2):  # the second run finds nothing new
            found = stage_deduplicated(
                spark, f"{root}/source", "parquet", SCHEMA, f"{root}/staged", f"{root}/progress",
                ["event_id"], "ts", "5 days",
            )
    return found


@query("incremental_dedupe", "SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events")
def incremental_dedupe(spark, sf_dir):
    return _deduplicated(spark, sf_dir).rows


@query(
    "incremental_dedupe_counts",
    """WITH exports AS (
         SELECT unnest([0, 1, 2, 3]) AS batch, unnest([1, 9, 20, 1]) AS first_day, unnest([12, 20, 31, 3]) AS last_day),
       lines AS (SELECT batch, ts, event_id FROM exports JOIN events ON day(ts) BETWEEN first_day AND last_day),
       marks AS (SELECT batch, (SELECT max(ts) - INTERVAL 5 DAY FROM lines e WHERE e.batch < exports.batch) AS watermark
                 FROM exports),
       judged AS (SELECT batch, coalesce(ts < watermark, false) AS late,
                         batch > min(batch) OVER (PARTITION BY event_id, ts) AS again
                  FROM lines JOIN marks USING (batch))
       SELECT CAST(batch AS BIGINT) AS batch, count(*) AS total, count(*) FILTER (NOT late AND NOT again) AS staged,
              count(*) FILTER (NOT late AND again) AS repeated, count(*) FILTER (late) AS late
       FROM judged GROUP BY batch""",
)
def incremental_dedupe_counts(spark, sf_dir):
    return _deduplicated(spark, sf_dir).batches.drop("watermark", "latest")
