"""D, G, I2: projections, filters, unions, previews and ordered reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.functions.text import blank_to_null
from martflow.operators.columns import (
    cast_to_int,
    change_columns,
    process,
    rename_and_drop,
    select_as,
    select_positions,
)
from martflow.operators.combine import distinct_values, in_order, preview, stack_frames
from martflow.operators.filters import after, all_of, lookup, not_blank, of_kind, present
from martflow.queries.registry import query, table


@query("project_subset", "SELECT o_orderkey, o_orderstatus FROM orders")
def project_subset(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")


@query("project_rename", "SELECT c_custkey AS user_id, c_name AS full_name FROM customer")
def project_rename(spark, sf_dir):
    return select_as(table(spark, sf_dir, "customer"), {"c_custkey": "user_id", "c_name": "full_name"})


@query(
    "project_rename_drop",
    "SELECT s_suppkey AS id, s_nationkey, s_acctbal AS balance FROM supplier",
)
def project_rename_drop(spark, sf_dir):
    return rename_and_drop(
        table(spark, sf_dir, "supplier"), {"s_suppkey": "id", "s_acctbal": "balance"}, ["s_name"]
    )


@query("project_positional", "SELECT p_brand, p_partkey, p_retailprice FROM part")
def project_positional(spark, sf_dir):
    return select_positions(table(spark, sf_dir, "part"), [2, 0, 5])


@query(
    "bulk_cast_int",
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
              CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice
       FROM lineitem""",
)
def bulk_cast_int(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").cast("string").alias("l_extendedprice")
    )
    return cast_to_int(lines, ["l_quantity", "l_extendedprice"])


@query(
    "bulk_transform",
    "SELECT p_partkey, upper(p_name) AS p_name, upper(p_type) AS p_type, p_brand FROM part",
)
def bulk_transform(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return change_columns(part, ["p_name", "p_type"], F.upper)


@query("filter_event_type", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def filter_event_type(spark, sf_dir):
    return of_kind(table(spark, sf_dir, "events"), "event_type", "purchase").select("event_id", "user_id")


def _blanked(spark, sf_dir):
    """Orders whose priority is blank where they are pending."""
    orders = table(spark, sf_dir, "orders")
    priority = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    return orders.select("o_orderkey", "o_orderdate", priority.alias("priority"))


@query(
    "filter_not_null",
    "SELECT o_orderkey, o_orderpriority AS priority FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL",
)
def filter_not_null(spark, sf_dir):
    blanked = change_columns(_blanked(spark, sf_dir), ["priority"], blank_to_null)
    return present(blanked, "priority").select("o_orderkey", "priority")


@query(
    "filter_blank",
    "SELECT o_orderkey, o_orderpriority AS priority FROM orders WHERE o_orderstatus <> 'P'",
)
def filter_blank(spark, sf_dir):
    return not_blank(_blanked(spark, sf_dir), "priority").select("o_orderkey", "priority")


@query("filter_after_date", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > DATE '2000-01-01'")
def filter_after_date(spark, sf_dir):
    return after(table(spark, sf_dir, "orders"), "o_orderdate", "2000-01-01").select("o_orderkey", "o_orderdate")


@query(
    "filter_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_returnflag = 'N' AND l_quantity > 10 AND l_shipdate > DATE '2000-01-01'""",
)
def filter_conjunction(spark, sf_dir):
    wanted = all_of(
        F.col("l_returnflag") == "N",
        F.col("l_quantity") > 10,
        F.col("l_shipdate") > F.lit("2000-01-01").cast("date"),
    )
    return table(spark, sf_dir, "lineitem").where(wanted).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "point_lookup_pair",
    "SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 1 AND l_linenumber = 3",
)
def point_lookup_pair(spark, sf_dir):
    keys = {"l_orderkey": 1, "l_linenumber": 3}
    return lookup(table(spark, sf_dir, "lineitem"), keys, ["l_partkey", "l_quantity"])


@query(
    "point_lookup_user_session",
    "SELECT event_id, ts, value FROM events WHERE user_id = 10 AND event_type = 'purchase'",
)
def point_lookup_user_session(spark, sf_dir):
    keys = {"user_id": 10, "event_type": "purchase"}
    return lookup(table(spark, sf_dir, "events"), keys, ["event_id", "ts", "value"])


@query("point_lookup_value", "SELECT p_partkey, p_brand FROM part WHERE p_name = 'blue bolt'")
def point_lookup_value(spark, sf_dir):
    return lookup(table(spark, sf_dir, "part"), {"p_name": "blue bolt"}, ["p_partkey", "p_brand"])


@query(
    "union_dates",
    """SELECT DISTINCT CAST(d AS VARCHAR) AS day FROM (
         SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL
         SELECT CAST(o_orderdate AS DATE) + 10 FROM orders WHERE o_orderstatus <> 'P')""",
)
def union_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    both = orders.select(
        day.alias("placed"), F.when(F.col("o_orderstatus") != "P", F.date_add(day, 10)).alias("due")
    )
    return distinct_values(both, ["placed", "due"], "day").select(F.col("day").cast("string"))


@query(
    "union_files",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
)
def union_files(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS id", "s_name AS name")
    return stack_frames(customer, supplier)


@query(
    "preview_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def preview_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, 5, [F.desc("o_totalprice"), "o_orderkey"])


@query(
    "ordered_within_key",
    """SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS place
       FROM events WHERE event_type = 'click'""",
)
def ordered_within_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    clicks = in_order(events, F.col("event_type") == "click", ["ts", "event_id"], "place")
    return clicks.drop("event_type")


@query(
    "transform_callback",
    """SELECT c_custkey AS id, trim(replace(c_name, '#', ' ')) AS name FROM customer WHERE c_acctbal > 0""",
)
def transform_callback(spark, sf_dir):
    return process(
        table(spark, sf_dir, "customer"),
        lambda df: df.where(F.col("c_acctbal") > 0),
        lambda df: select_as(df, {"c_custkey": "id", "c_name": "name"}),
        lambda df: change_columns(df, ["name"], lambda c: F.trim(F.replace(c, F.lit("#"), F.lit(" ")))),
    )
