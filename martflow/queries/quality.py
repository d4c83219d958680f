"""J: quality checks, profiles and the analytic battery."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.operators.quality import (
    cast_rejects,
    key_violations,
    nonempty_report,
    not_null_violations,
    null_counts,
    numeric_summary,
    orphans,
    source_target_counts,
)
from martflow.operators.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    merge_profiles,
    rank_errors,
    read_profile,
    sketch_profile,
)
from martflow.plans import star_warehouse
from martflow.plans.analytics import long_form, questions
from martflow.queries.registry import query, table
from martflow.queries.standins import SONGS_SQL, STAGED_LOG_SQL, songs, staged_log
from martflow.session import materialize, scratch_path
from martflow.sinks.observed import Watch, load_watched, watched_report


@query(
    "dq_nonempty_report",
    """SELECT 'orders' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM orders
       UNION ALL SELECT 'lineitem', count(*), count(*) > 0 FROM lineitem
       UNION ALL SELECT 'returns_of_nothing', count(*), count(*) > 0 FROM lineitem WHERE l_quantity < 0""",
)
def dq_nonempty_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return nonempty_report(
        {
            "orders": table(spark, sf_dir, "orders"),
            "lineitem": lines,
            "returns_of_nothing": lines.where(F.col("l_quantity") < 0),
        }
    )


def _events_with_nulls(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.when(F.col("event_type") != "signup", F.col("user_id")).alias("user_id"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") > 10, F.col("value")).alias("value"),
    )


@query(
    "profile_nulls",
    """SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS nulls FROM events
       UNION ALL SELECT 'user_id', count(*) FILTER (event_type = 'signup') FROM events
       UNION ALL SELECT 'event_type', count(*) FILTER (event_type = 'error') FROM events
       UNION ALL SELECT 'value', count(*) FILTER (NOT value > 10) FROM events""",
)
def profile_nulls(spark, sf_dir):
    return null_counts(_events_with_nulls(spark, sf_dir))


@query(
    "dq_cast_rejects",
    """SELECT 'tax' AS column_name, count(*) FILTER (l_returnflag = 'N') AS rejects FROM lineitem
       UNION ALL SELECT 'shipped', count(*) FILTER (l_linestatus = 'F') FROM lineitem""",
)
def dq_cast_rejects(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    tax = F.when(F.col("l_returnflag") == "N", "none").otherwise(F.col("l_tax").cast("string"))
    shipped = F.when(F.col("l_linestatus") == "F", "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    return cast_rejects(lines.select(tax.alias("tax"), shipped.alias("shipped")), {"tax": "double", "shipped": "date"})


def _summary_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(v) AS count, round(avg(v), 6) AS mean,
      round(stddev_samp(v), 6) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25,
      round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
      FROM (SELECT CAST({column} AS DOUBLE) AS v FROM lineitem)"""


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("profile_summary", " UNION ALL ".join(_summary_sql(c) for c in PROFILED))
def profile_summary(spark, sf_dir):
    summary = numeric_summary(table(spark, sf_dir, "lineitem"), PROFILED)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    "dq_primary_key",
    """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
            e AS (SELECT u, count(*) AS n FROM
                  (SELECT CASE WHEN event_type <> 'signup' THEN user_id END AS u FROM events) GROUP BY u)
       SELECT 'lineitem' AS table_name, count(*) FILTER (n > 1) AS repeated_keys,
              CAST(sum(n) FILTER (n > 1) AS BIGINT) AS rows_in_repeated_keys, CAST(0 AS BIGINT) AS rows_with_null_key
       FROM g
       UNION ALL
       SELECT 'events', count(*) FILTER (n > 1 AND u IS NOT NULL),
              CAST(sum(n) FILTER (n > 1 AND u IS NOT NULL) AS BIGINT),
              CAST(sum(n) FILTER (u IS NULL) AS BIGINT)
       FROM e""",
)
def dq_primary_key(spark, sf_dir):
    lines = key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    events = key_violations(_events_with_nulls(spark, sf_dir), ["user_id"])
    return lines.select(F.lit("lineitem").alias("table_name"), "*").unionByName(
        events.select(F.lit("events").alias("table_name"), "*")
    )


@query(
    "dq_foreign_key",
    """SELECT l_orderkey, count(*) AS child_rows FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
       GROUP BY l_orderkey""",
)
def dq_foreign_key(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return orphans(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query(
    "dq_not_null",
    """SELECT table_name, column_name, nulls, nulls = 0 AS passed FROM (
         SELECT 'events' AS table_name, 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS nulls FROM events
         UNION ALL SELECT 'events', 'user_id', count(*) FILTER (event_type = 'signup') FROM events
         UNION ALL SELECT 'orders', 'o_orderkey', count(*) FILTER (o_orderkey IS NULL) FROM orders)""",
)
def dq_not_null(spark, sf_dir):
    return not_null_violations(
        {
            "events": (_events_with_nulls(spark, sf_dir), ["event_id", "user_id"]),
            "orders": (table(spark, sf_dir, "orders"), ["o_orderkey"]),
        }
    )


@query(
    "dq_source_counts",
    """SELECT 'plays' AS table_name, count(*) AS source_rows, count(*) FILTER (l_returnflag = 'N') AS target_rows,
              count(*) - count(*) FILTER (l_returnflag = 'N') AS difference FROM lineitem
       UNION ALL SELECT 'users', count(*), count(*), 0 FROM customer""",
)
def dq_source_counts(spark, sf_dir):
    lines, customer = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "customer")
    return source_target_counts(
        {"plays": (lines, lines.where(F.col("l_returnflag") == "N")), "users": (customer, customer)}
    )


@query(
    "analytics_battery",
    f"""WITH {STAGED_LOG_SQL}, {SONGS_SQL},
    plays AS (SELECT DISTINCT staged.ts, userId, level, song_id, artist_id, sessionId, artist_location, userAgent
              FROM staged JOIN songs ON song = title AND artist = artist_name WHERE page = 'NextSong'),
    artists AS (SELECT DISTINCT artist_id, artist_name, artist_location AS location, artist_latitude,
                       artist_longitude FROM songs),
    users AS (SELECT DISTINCT userId, firstName, lastName, gender, level FROM log WHERE page = 'NextSong')
    SELECT 'count_songplays' AS question, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS value FROM plays
    UNION ALL SELECT 'time_interval', CAST(min(ts) AS VARCHAR), CAST(max(ts) AS VARCHAR) FROM plays
    UNION ALL SELECT * FROM (SELECT 'most_repeated_locations', location, CAST(count(location) AS VARCHAR) FROM artists
      GROUP BY location ORDER BY count(location) DESC, location LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'years_with_most_productivity', CAST("year" AS VARCHAR), CAST(count("year") AS VARCHAR)
      FROM songs GROUP BY "year" ORDER BY count("year") DESC, "year" LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'payment_analysis', level, CAST(count(level) AS VARCHAR) FROM users
      GROUP BY level ORDER BY count(level) DESC, level LIMIT 2)""",
)
def analytics_battery(spark, sf_dir):
    events, catalogue = staged_log(spark, sf_dir), songs(spark, sf_dir)
    plays = star_warehouse.songplays(events, catalogue)
    star = {
        "songplays": plays,
        "time": plays.select("start_time"),
        "artists": star_warehouse.artists(catalogue),
        "songs": star_warehouse.songs(catalogue),
        "users": star_warehouse.users(events),
    }
    return long_form(questions(star))


@query(
    "dq_watched_load",
    """WITH few AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
                           CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS customer
                    FROM orders)
       SELECT 'orders' AS table_name, 'rows' AS rule, count(*) AS value, true AS passed FROM few
       UNION ALL SELECT 'orders', 'null o_orderkey', count(*), true FROM few WHERE o_orderkey IS NULL
       UNION ALL SELECT 'orders', 'null priority', count(*), false FROM few WHERE priority IS NULL
       UNION ALL SELECT 'orders', 'unfit customer', count(*), false FROM few WHERE customer = 'x'
       UNION ALL SELECT 'large', 'rows', count(*), true FROM few WHERE o_totalprice > 100000
       UNION ALL SELECT 'none', 'rows', 0, false""",
)
def dq_watched_load(spark, sf_dir):
    """Rules judged by three writes, without reading what was written."""
    missing = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    broken = F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(F.col("o_custkey").cast("string"))
    orders = table(spark, sf_dir, "orders").withColumns({"priority": missing, "customer": broken})
    root = scratch_path(spark, "watched")
    watches = [Watch("orders", ["o_orderkey", "priority"], {"customer": "bigint"}), Watch("large"), Watch("none")]
    parts = [orders, orders.where("o_totalprice > 100000"), orders.where("o_totalprice < 0")]
    for watch, rows in zip(watches, parts):
        load_watched(rows, f"{root}/{watch.name}", True, watch)
    return watched_report(spark, watches)


MEASURES = ["l_quantity", "l_extendedprice", "late_discount", "l_orderkey"]


@query(
    "profile_sketch",
    """WITH v AS (
         SELECT unnest(['l_quantity', 'l_extendedprice', 'late_discount', 'l_orderkey']) AS column_name,
                unnest([l_quantity, l_extendedprice,
                        CASE WHEN l_shipdate >= TIMESTAMP '1996-01-01' THEN l_discount END, CAST(l_orderkey AS DOUBLE)]) AS value
         FROM lineitem)
       SELECT column_name, count(value) AS "count", count(*) - count(value) AS nulls, round(avg(value), 6) AS mean,
              min(value) AS "min", max(value) AS "max", true AS quartiles_within, true AS distinct_within
       FROM v GROUP BY column_name""",
)
def profile_sketch(spark, sf_dir):
    """Sketches of every shipping month, written, then merged; errors held against the exact values."""
    late = F.when(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"), F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").withColumn("late_discount", late)
    monthly = materialize(sketch_profile(lines.withColumn("month", F.trunc("l_shipdate", "month")), MEASURES, ["month"]), "sketches")
    found = materialize(read_profile(merge_profiles(monthly)), "profile")
    exact = lines.agg(*[F.countDistinct(c).alias(c) for c in MEASURES]).unpivot([], MEASURES, "column_name", "exact")
    errors = rank_errors(lines, MEASURES, found)
    within = F.greatest("p25_error", "p50_error", "p75_error") <= 2 * RANK_ERROR
    close = F.abs(F.col("distinct") / F.col("exact") - 1) <= DISTINCT_ERROR
    return found.join(errors, "column_name").join(exact, "column_name").select(
        "column_name", "count", "nulls", F.round("mean", 6).alias("mean"), "min", "max",
        within.alias("quartiles_within"), close.alias("distinct_within"),
    )
