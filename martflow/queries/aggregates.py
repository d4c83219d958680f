"""F, G3: aggregation, distinct, pivots and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.operators.aggregates import (
    distinct_rows,
    first_per_group,
    group_counts,
    group_mean,
    mean_and_first,
    mixed_measures,
    one_row_per_key,
    pivot_first,
    row_count,
    time_interval,
    top_groups,
)
from martflow.queries.registry import query, table

STATUSES = {"F": "filled", "O": "open", "P": "pending"}


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query("agg_time_interval", "SELECT min(ts) AS first_time, max(ts) AS last_time FROM events")
def agg_time_interval(spark, sf_dir):
    return time_interval(table(spark, sf_dir, "events"), "ts")


def _with_nulls(spark, sf_dir):
    """Orders whose status is null where they are pending."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))


@query(
    "agg_group_count",
    """SELECT status, count(status) AS n FROM (SELECT nullif(o_orderstatus, 'P') AS status FROM orders)
       GROUP BY status""",
)
def agg_group_count(spark, sf_dir):
    return group_counts(_with_nulls(spark, sf_dir), "status", "n")


@query(
    "agg_group_mean",
    """SELECT p_brand, p_type, round(avg(p_retailprice), 6) AS mean_price FROM part GROUP BY p_brand, p_type""",
)
def agg_group_mean(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("price", F.col("p_retailprice").cast("string"))
    means = group_mean(part, ["p_brand", "p_type"], "price", "mean_price")
    return means.withColumn("mean_price", F.round("mean_price", 6))


@query(
    "agg_mixed",
    """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS mean_quantity,
              round(avg(l_discount), 6) AS mean_discount, round(sum(l_extendedprice), 2) AS price,
              sum(l_linenumber::DOUBLE) AS numbers
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_mixed(spark, sf_dir):
    totals = mixed_measures(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"l_quantity": "mean_quantity", "l_discount": "mean_discount"},
        {"l_extendedprice": "price", "l_linenumber": "numbers"},
    )
    return totals.withColumns(
        {
            "mean_quantity": F.round("mean_quantity", 6),
            "mean_discount": F.round("mean_discount", 6),
            "price": F.round("price", 2),
        }
    )


@query(
    "agg_first",
    """SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id""",
)
def agg_first(spark, sf_dir):
    return first_per_group(table(spark, sf_dir, "events"), ["user_id"], ["event_type"], ["ts", "event_id"])


@query(
    "agg_mean_first",
    """SELECT user_id, round(avg(value), 6) AS mean_value, arg_min(event_type, (ts, event_id)) AS event_type,
              arg_min(props, (ts, event_id)) AS props
       FROM events GROUP BY user_id""",
)
def agg_mean_first(spark, sf_dir):
    means = mean_and_first(
        table(spark, sf_dir, "events"), ["user_id"], "value", "mean_value", ["event_type", "props"], ["ts", "event_id"]
    )
    return means.withColumn("mean_value", F.round("mean_value", 6))


@query(
    "pivot_first",
    """SELECT o_custkey, min(o_orderkey) FILTER (o_orderstatus = 'F') AS filled,
              min(o_orderkey) FILTER (o_orderstatus = 'O') AS open,
              min(o_orderkey) FILTER (o_orderstatus = 'P') AS pending
       FROM orders GROUP BY o_custkey""",
)
def pivot_first_query(spark, sf_dir):
    return pivot_first(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", "o_orderkey", STATUSES)


@query(
    "pivot_rollup",
    """WITH fine AS (
         SELECT c_nationkey, c_custkey, c_acctbal, min(o_totalprice) FILTER (o_orderstatus = 'F') AS filled,
                min(o_totalprice) FILTER (o_orderstatus = 'O') AS open,
                min(o_totalprice) FILTER (o_orderstatus = 'P') AS pending
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, c_custkey, c_acctbal)
       SELECT c_nationkey, round(avg(c_acctbal), 4) AS mean_balance, round(sum(filled), 2) AS filled,
              round(sum(open), 2) AS open, round(sum(pending), 2) AS pending
       FROM fine GROUP BY c_nationkey""",
)
def pivot_rollup(spark, sf_dir):
    # Orders are reduced per customer before customers are joined to them.
    fine = pivot_first(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", "o_totalprice", STATUSES
    )
    customer = table(spark, sf_dir, "customer")
    joined = fine.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rolled = mixed_measures(
        joined, ["c_nationkey"], {"c_acctbal": "mean_balance"}, {c: c for c in STATUSES.values()}
    )
    return rolled.withColumns(
        {"mean_balance": F.round("mean_balance", 4), **{c: F.round(c, 2) for c in STATUSES.values()}}
    )


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def distinct_rows_query(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_shipdate"])


@query("dedupe_rows", "SELECT DISTINCT * FROM lineitem")
def dedupe_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return distinct_rows(lines.union(lines))


@query(
    "dedupe_by_key_latest",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def dedupe_by_key_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    return one_row_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "topk_groups_5",
    "SELECT p_name, count(p_name) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 5",
)
def topk_groups_5(spark, sf_dir):
    return top_groups(table(spark, sf_dir, "part"), "p_name", "n", 5)


@query(
    "topk_groups_2",
    """SELECT status, count(status) AS n FROM (SELECT nullif(o_orderstatus, 'P') AS status FROM orders)
       GROUP BY status ORDER BY n DESC, status LIMIT 2""",
)
def topk_groups_2(spark, sf_dir):
    return top_groups(_with_nulls(spark, sf_dir), "status", "n", 2)
