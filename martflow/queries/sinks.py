"""B1-B6, B9, B10: file sinks and load modes, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.queries.registry import query, table
from martflow.session import scratch_path
from martflow.sinks.writers import load, write_csv, write_parquet
from martflow.sources.readers import read_csv, read_partitioned

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


@query("sink_parquet_overwrite", "SELECT * FROM orders")
def sink_parquet_overwrite(spark, sf_dir):
    path = scratch_path(spark, "sink")
    write_parquet(table(spark, sf_dir, "customer"), path)
    write_parquet(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query(
    "sink_parquet_partitioned",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS "year",
              strftime(o_orderdate, '%m') AS "month"
       FROM orders""",
)
def sink_parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "sink")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
    )
    write_parquet(orders, path, ["year", "month"])
    return read_partitioned(spark, path, orders.schema)


@query("sink_csv_header", "SELECT * FROM supplier")
def sink_csv_header(spark, sf_dir):
    path = scratch_path(spark, "sink")
    write_csv(table(spark, sf_dir, "supplier"), path)
    return read_csv(spark, path, SUPPLIER)


@query("sink_csv_semicolon", "SELECT s_suppkey || ';' || s_name || ';' || s_nationkey AS line FROM supplier")
def sink_csv_semicolon(spark, sf_dir):
    path = scratch_path(spark, "sink")
    write_csv(table(spark, sf_dir, "supplier").drop("s_acctbal"), path, sep=";")
    return spark.read.csv(path, header=True, sep="\u0001").toDF("line")


@query(
    "sink_csv_quote_all",
    """SELECT '"' || c_custkey || '","' || c_mktsegment || '"' AS line FROM customer""",
)
def sink_csv_quote_all(spark, sf_dir):
    path = scratch_path(spark, "sink")
    write_csv(table(spark, sf_dir, "customer"), path, columns=["c_custkey", "c_mktsegment"], quote_all=True)
    return spark.read.text(path).toDF("line").where(F.col("line") != '"c_custkey","c_mktsegment"')


def _loaded(spark, sf_dir, truncate):
    """Suppliers loaded, then customers loaded on top in the given way."""
    path = scratch_path(spark, "load")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    load(supplier, path, truncate=True)
    load(customer, path, truncate=truncate)
    return spark.read.parquet(path)


BOTH_SQL = """SELECT s_suppkey AS id, s_name AS name FROM supplier
              UNION ALL SELECT c_custkey AS id, c_name AS name FROM customer"""


@query("load_append", "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem")
def load_append(spark, sf_dir):
    path = scratch_path(spark, "load")
    lineitem = table(spark, sf_dir, "lineitem")
    load(lineitem, path, truncate=False)
    load(lineitem, path, truncate=False)
    return spark.read.parquet(path)


@query("load_truncate", "SELECT c_custkey AS id, c_name AS name FROM customer")
def load_truncate(spark, sf_dir):
    return _loaded(spark, sf_dir, truncate=True)


@query("load_no_truncate", BOTH_SQL)
def load_no_truncate(spark, sf_dir):
    return _loaded(spark, sf_dir, truncate=False)
