"""H, I1: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.functions.text import (
    commas_to_spaces,
    element,
    exact_number,
    joined_text,
    to_int,
)
from martflow.functions.timeparts import (
    calendar_parts,
    clock_parts,
    format_start_time,
    from_epoch_ms,
    padded_parts,
    parse_date,
    sas_date,
    to_epoch_ms,
    weekday,
)
from martflow.queries.registry import query, table

TS = "ts"


def _events(spark, sf_dir, **columns):
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in columns.items()])


@query("fn_epoch_ms", "SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events")
def fn_epoch_ms(spark, sf_dir):
    return _events(spark, sf_dir, start_time=from_epoch_ms(to_epoch_ms(F.col(TS))))


@query("fn_epoch_ms_trunc", "SELECT event_id, date_trunc('second', ts) AS start_time FROM events")
def fn_epoch_ms_trunc(spark, sf_dir):
    return _events(spark, sf_dir, start_time=from_epoch_ms(to_epoch_ms(F.col(TS)), whole_seconds=True))


@query("fn_format_ts", "SELECT event_id, strftime(ts, '%d-%m-%Y %H:%M:%S') AS start_time FROM events")
def fn_format_ts(spark, sf_dir):
    return _events(spark, sf_dir, start_time=format_start_time(F.col(TS)))


@query(
    "fn_format_parts",
    """SELECT event_id, strftime(ts, '%H') AS "hour", strftime(ts, '%d') AS "day",
              strftime(ts, '%m') AS "month", strftime(ts, '%Y') AS "year"
       FROM events""",
)
def fn_format_parts(spark, sf_dir):
    return _events(spark, sf_dir, **padded_parts(F.col(TS)))


@query("fn_week", "SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS week FROM orders")
def fn_week(spark, sf_dir):
    week = clock_parts(F.col("o_orderdate"))["week"]
    return table(spark, sf_dir, "orders").select("o_orderkey", week.alias("week"))


@query(
    "fn_date_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS "hour", CAST(day(ts) AS INTEGER) AS "day",
              CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS "month",
              CAST(year(ts) AS INTEGER) AS "year", CAST(isodow(ts) - 1 AS INTEGER) AS weekday
       FROM events""",
)
def fn_date_parts(spark, sf_dir):
    return _events(spark, sf_dir, **clock_parts(F.col(TS)))


@query(
    "fn_weekday_all",
    """SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS monday0, CAST(dayofweek(ts) AS INTEGER) AS sunday0,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS sunday1, strftime(ts, '%a') AS name
       FROM events""",
)
def fn_weekday_all(spark, sf_dir):
    conventions = ("monday0", "sunday0", "sunday1", "name")
    return _events(spark, sf_dir, **{c: weekday(F.col(TS), c) for c in conventions})


@query(
    "fn_yearday",
    "SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INTEGER) AS yearday FROM orders",
)
def fn_yearday(spark, sf_dir):
    yearday = calendar_parts(F.col("o_orderdate"))["yearday"]
    return table(spark, sf_dir, "orders").select("o_orderkey", yearday.alias("yearday"))


@query(
    "fn_parse_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso,
              CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS european
       FROM events""",
)
def fn_parse_date(spark, sf_dir):
    iso = F.date_format(TS, "yyyy-MM-dd")
    european = F.when(F.col("event_type") == "error", "not a date").otherwise(F.date_format(TS, "dd/MM/yyyy"))
    return _events(
        spark,
        sf_dir,
        iso=parse_date(iso).cast("string"),
        european=parse_date(european, "dd/MM/yyyy").cast("string"),
    )


@query(
    "fn_sas_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
       FROM orders""",
)
def fn_sas_date(spark, sf_dir):
    number = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double")
    known = F.when(F.col("o_orderstatus") != "P", number)
    return table(spark, sf_dir, "orders").select("o_orderkey", sas_date(known).cast("string").alias("day"))


@query("fn_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS name FROM part")
def fn_trim(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", F.trim(padded).alias("name"))


@query(
    "fn_split_part",
    """SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN CAST(c_nationkey AS VARCHAR) END AS state
       FROM customer""",
)
def fn_split_part(spark, sf_dir):
    region = F.when(F.col("c_nationkey") < 20, F.concat(F.lit("US-"), F.col("c_nationkey"))).otherwise("US")
    return table(spark, sf_dir, "customer").select("c_custkey", element(region, "-", 1).alias("state"))


@query(
    "fn_replace_comma",
    """SELECT p_partkey, CASE WHEN p_size > 5 THEN replace(p_name || ',' || p_brand, ',', ' ') END AS label
       FROM part""",
)
def fn_replace_comma(spark, sf_dir):
    label = F.when(F.col("p_size") > 5, F.concat_ws(",", "p_name", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", commas_to_spaces(label).alias("label"))


@query("fn_concat", "SELECT event_id, user_id || event_type || CAST(ts AS VARCHAR) AS label FROM events")
def fn_concat(spark, sf_dir):
    return _events(spark, sf_dir, label=joined_text(F.col("user_id"), F.col("event_type"), F.col(TS)))


@query(
    "fn_casts",
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS whole,
              CASE WHEN l_returnflag <> 'N' THEN l_tax END AS tax,
              CAST(CAST(l_extendedprice AS DECIMAL(18,0)) AS BIGINT) AS rounded
       FROM lineitem""",
)
def fn_casts(spark, sf_dir):
    text = F.when(F.col("l_returnflag") == "N", "none").otherwise(F.col("l_tax").cast("string"))
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        to_int(price.cast("string")).alias("whole"),
        text.try_cast("double").alias("tax"),
        exact_number(price, 0).cast("bigint").alias("rounded"),
    )
