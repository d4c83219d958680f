"""C: catalog tables, layouts and length limits."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from martflow.operators.joins import equi_join, replicate
from martflow.plans.query_first import song_events, table as question_table, write_table
from martflow.queries.registry import query, table
from martflow.queries.standins import LOG_SQL, log
from martflow.session import scratch_path
from martflow.sinks.clustered import lookup_clustered, write_clustered
from martflow.sinks.tables import create_table, length_violations, write_distributed
from martflow.sinks.writers import load_table


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query("create_table_roundtrip", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier")
def create_table_roundtrip(spark, sf_dir):
    name = _name("suppliers")
    ddl = "id BIGINT, name VARCHAR(32), balance DOUBLE"
    location = scratch_path(spark, "table")
    create_table(spark, name, ddl, location)
    create_table(spark, name, ddl, location)  # changes nothing
    load_table(table(spark, sf_dir, "supplier").drop("s_nationkey"), name, truncate=True)
    return spark.table(name)


@query(
    "layout_bucketed_agg",
    """SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey""",
)
def layout_bucketed_agg(spark, sf_dir):
    name = _name("lines")
    lines = table(spark, sf_dir, "lineitem")
    write_distributed(lines, name, scratch_path(spark, "table"), "l_orderkey", ["l_orderkey", "l_linenumber"], 8)
    return spark.table(name).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "layout_broadcast_join",
    """SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def layout_broadcast_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    nation = replicate(table(spark, sf_dir, "nation"))
    joined = equi_join(customer, nation, {"c_nationkey": "n_nationkey"})
    return joined.select("c_custkey", "n_name", "n_regionkey")


@query(
    "layout_query_first",
    f"""WITH {LOG_SQL}
    SELECT sessionId, count(*) AS items, count(DISTINCT itemInSession) AS places,
           max(itemInSession) AS last_item
    FROM (SELECT DISTINCT sessionId, itemInSession FROM log WHERE artist <> '') GROUP BY sessionId""",
)
def layout_query_first(spark, sf_dir):
    name = _name("session_history")
    rows = question_table(song_events(log(spark, sf_dir)), "session_history")
    write_table(rows, "session_history", name, scratch_path(spark, "table"), 8)
    return spark.table(name).groupBy("sessionId").agg(
        F.count(F.lit(1)).alias("items"),
        F.countDistinct("itemInSession").alias("places"),
        F.max("itemInSession").alias("last_item"),
    )


@query(
    "varchar_violations",
    """SELECT 'p_name' AS column_name, count(*) FILTER (length(p_name) > 9) AS violations FROM part
       UNION ALL SELECT 'p_brand', count(*) FILTER (length(p_brand) > 7) FROM part
       UNION ALL SELECT 'p_type', count(*) FILTER (length(p_type) > 32) FROM part""",
)
def varchar_violations(spark, sf_dir):
    return length_violations(table(spark, sf_dir, "part"), {"p_name": 9, "p_brand": 7, "p_type": 32})


CLUSTERED = ["l_orderkey", "l_suppkey", "l_shipdate"]


@query(
    "layout_clustered_lookup",
    """SELECT 'second key' AS lookup, l_orderkey, l_suppkey, l_shipdate, l_quantity FROM lineitem WHERE l_suppkey = 7
       UNION ALL SELECT 'first and third', l_orderkey, l_suppkey, l_shipdate, l_quantity FROM lineitem
       WHERE l_orderkey BETWEEN 100 AND 400 AND l_shipdate >= TIMESTAMP '1996-01-01'
       UNION ALL SELECT 'all', l_orderkey, l_suppkey, l_shipdate, l_quantity FROM lineitem
       WHERE l_orderkey <= 1000 AND l_suppkey BETWEEN 3 AND 5 AND l_shipdate < TIMESTAMP '1995-01-01'""",
)
def layout_clustered_lookup(spark, sf_dir):
    """One layout that answers questions by any of its keys, written in two loads."""
    path = scratch_path(spark, "clustered")
    lines = table(spark, sf_dir, "lineitem").select(*CLUSTERED, "l_quantity")
    write_clustered(lines.where("l_quantity > 5"), path, CLUSTERED, 64)
    write_clustered(lines.where("l_quantity <= 5"), path, CLUSTERED, 8, append=True)

    def asked(label, wanted):
        return lookup_clustered(spark, path, lines.schema, wanted).select(F.lit(label).alias("lookup"), "*")

    before = dt.datetime(1995, 1, 1) - dt.timedelta(microseconds=1)
    second = asked("second key", {"l_suppkey": 7})
    pair = asked("first and third", {"l_orderkey": (100, 400), "l_shipdate": (dt.datetime(1996, 1, 1), None)})
    every = asked("all", {"l_orderkey": (None, 1000), "l_suppkey": (3, 5), "l_shipdate": (None, before)})
    return second.unionByName(pair).unionByName(every)
