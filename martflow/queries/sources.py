"""A: file scans and staging, each as a write-then-read round trip."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from martflow.functions.timeparts import to_epoch_ms
from martflow.queries.registry import query, table
from martflow.session import materialize, scratch_path
from martflow.sources.drift import drift_report, extract, field, stage_variant
from martflow.sources.ledger import read_staged, stage_run
from martflow.sources.readers import (
    list_files,
    read_any,
    read_csv,
    read_csv_typed,
    read_json,
    read_partitioned,
    read_tree,
)
from martflow.sources.staging import json_rejects, stage_csv, stage_json_auto, stage_json_paths, templated

EVENT = "event_id bigint, ms bigint, user_id bigint, event_type string, value double"
EVENT_SQL = "SELECT event_id, epoch_us(ts) // 1000 AS ms, user_id, event_type, value FROM events"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", to_epoch_ms(F.col("ts")).alias("ms"), "user_id", "event_type", "value"
    )


def _event_tree(spark, sf_dir, label):
    """Events as JSON files three directories deep, clicks apart from the rest."""
    root = scratch_path(spark, label)
    events = _events(spark, sf_dir)
    is_click = F.col("event_type") == "click"
    events.where(is_click).write.json(f"{root}/A/A/C")
    events.where(~is_click).write.json(f"{root}/A/B/R")
    return root


@query("scan_json_schema", EVENT_SQL)
def scan_json_schema(spark, sf_dir):
    root = _event_tree(spark, sf_dir, "json")
    return read_json(spark, f"{root}/*/*/*/*.json", EVENT)


@query("scan_json_inferred", EVENT_SQL)
def scan_json_inferred(spark, sf_dir):
    root = _event_tree(spark, sf_dir, "json")
    return read_json(spark, f"{root}/*/*/*/*.json")


@query("scan_recursive", EVENT_SQL)
def scan_recursive(spark, sf_dir):
    root = _event_tree(spark, sf_dir, "tree")
    # A file of another kind in the same tree is passed over.
    table(spark, sf_dir, "nation").write.csv(f"{root}/A/other")
    return read_tree(spark, root, ".json", "json", EVENT)


@query(
    "scan_csv_dir",
    """SELECT p_partkey, p_name || ', "' || p_brand || '"' AS label, p_retailprice FROM part""",
)
def scan_csv_dir(spark, sf_dir):
    path = scratch_path(spark, "csv")
    label = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("label")
    part = table(spark, sf_dir, "part").select("p_partkey", label, "p_retailprice")
    part.repartition(4).write.csv(path, header=True, quote='"', escape='"')
    return read_csv(spark, path, "p_partkey bigint, label string, p_retailprice double")


@query(
    "scan_csv_header_cast",
    """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice,
              CASE WHEN o_orderstatus <> 'P' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END
                AS priority
       FROM orders""",
)
def scan_csv_header_cast(spark, sf_dir):
    path = scratch_path(spark, "csv")
    priority = F.when(F.col("o_orderstatus") == "P", "none").otherwise(F.substring("o_orderpriority", 1, 1))
    orders = table(spark, sf_dir, "orders")
    orders.select("o_orderkey", "o_custkey", "o_totalprice", priority.alias("priority")).write.csv(
        path, header=True
    )
    types = {"o_orderkey": "bigint", "o_custkey": "int", "o_totalprice": "double", "priority": "int"}
    return read_csv_typed(spark, path, types)


CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("scan_csv_semicolon", "SELECT * FROM customer")
def scan_csv_semicolon(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "customer").write.csv(path, header=True, sep=";")
    return read_csv(spark, path, CUSTOMER, sep=";")


@query(
    "scan_generic_format",
    """SELECT format, customer.* FROM customer,
       (VALUES ('parquet'), ('json'), ('csv'), ('orc')) AS f(format)""",
)
def scan_generic_format(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    scans = []
    for fmt in ("parquet", "json", "csv", "orc"):
        path = scratch_path(spark, fmt)
        options = {"header": "true"} if fmt == "csv" else {}
        customer.write.format(fmt).options(**options).save(path)
        scans.append(read_any(spark, path, fmt, CUSTOMER, **options).select(F.lit(fmt).alias("format"), "*"))
    first, *rest = scans
    for scan in rest:
        first = first.union(scan)
    return first


@query(
    "scan_parquet_partitioned",
    "SELECT event_id, user_id, value, strftime(ts, '%d') AS day FROM events",
)
def scan_parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    events = table(spark, sf_dir, "events")
    dated = events.select("event_id", "user_id", "value", F.date_format("ts", "dd").alias("day"))
    dated.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return read_partitioned(spark, path, "event_id bigint, user_id bigint, value double, day string")


@query(
    "stage_json_paths",
    """SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS item
       FROM events""",
)
def stage_json_paths_query(spark, sf_dir):
    path = scratch_path(spark, "json")
    events = table(spark, sf_dir, "events")
    line = F.struct(
        "event_id",
        to_epoch_ms(F.col("ts")).alias("ts"),
        F.struct(F.col("user_id").alias("id")).alias("user"),
        F.col("event_type").alias("page"),
        F.from_json("props", "k int").alias("props"),
    )
    events.select(F.to_json(line).alias("value")).write.text(path)
    return stage_json_paths(
        spark,
        path,
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, item int",
        {
            "event_id": "$.event_id",
            "ts": "$.ts",
            "user_id": "$.user.id",
            "event_type": "$.page",
            "item": "$.props.k",
        },
        epoch_ms=["ts"],
    )


@query(
    "stage_json_auto",
    """SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN value END AS value,
              CAST(NULL AS VARCHAR) AS page, event_type
       FROM events""",
)
def stage_json_auto_query(spark, sf_dir):
    path = scratch_path(spark, "json")
    events = table(spark, sf_dir, "events")
    line = F.struct(
        F.col("event_id").alias("Event_Id"),
        F.col("user_id").alias("USER_ID"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.col("event_type").alias("Event_Type"),
        F.col("props").alias("unused"),
    )
    events.select(F.to_json(line).alias("value")).write.text(path)
    return stage_json_auto(
        spark, path, "event_id bigint, user_id bigint, value double, page string, event_type string"
    )


@query("stage_epoch_ms", "SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def stage_epoch_ms(spark, sf_dir):
    path = scratch_path(spark, "json")
    _events(spark, sf_dir).write.json(path)
    return stage_json_paths(
        spark, path, "event_id bigint, ts timestamp_ntz", {"event_id": "$.event_id", "ts": "$.ms"}, ["ts"]
    )


@query(
    "stage_csv_positional",
    """SELECT s_suppkey AS id, s_name AS label, s_acctbal AS amount FROM supplier
       UNION ALL
       SELECT c_custkey AS id, c_name AS label, c_acctbal AS amount FROM customer""",
)
def stage_csv_positional(spark, sf_dir):
    headed, bare = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    supplier.write.csv(headed, header=True, sep="|")
    customer.write.csv(bare, sep="|")
    target = "id bigint, label string, amount double"
    return stage_csv(spark, headed, target, sep="|").union(
        stage_csv(spark, bare, target, sep="|", ignore_header=0)
    )


@query(
    "stage_templated_path",
    "SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS run_year FROM orders",
)
def stage_templated_path(spark, sf_dir):
    root = scratch_path(spark, "runs")
    orders = table(spark, sf_dir, "orders").withColumn("run", F.year("o_orderdate"))
    orders.hint("rebalance", "run").write.partitionBy("run").parquet(root)
    years = [r["run"] for r in orders.select("run").distinct().collect()]
    staged = None
    for year in sorted(years):  # one run per logical year
        path = templated("{root}/run={day:%Y}", root=root, day=date(year, 1, 1))
        run = spark.read.parquet(path).select(
            "o_orderkey", "o_custkey", F.lit(year).alias("run_year")
        )
        staged = run if staged is None else staged.union(run)
    return staged


@query("file_inventory", "SELECT DISTINCT event_type AS folder, true AS has_bytes FROM events")
def file_inventory(spark, sf_dir):
    root = scratch_path(spark, "inventory")
    events = table(spark, sf_dir, "events")
    events.hint("rebalance", "event_type").write.partitionBy("event_type").parquet(root)
    folder = F.regexp_extract("path", "event_type=([^/]+)/", 1)
    return (
        list_files(spark, root, "*.parquet")
        .groupBy(folder.alias("folder"))
        .agg((F.sum("length") > 0).alias("has_bytes"))
    )


@query(
    "stage_rejects",
    """SELECT CASE event_id % 3 WHEN 0 THEN '{broken ' || event_id
                   ELSE '{"event_id":"x' || event_id || '","page":"' || event_type || '"}' END AS line,
              CASE event_id % 3 WHEN 0 THEN 'no object' ELSE 'event_id' END AS reason
       FROM events WHERE event_id % 3 < 2""",
)
def stage_rejects(spark, sf_dir):
    path = scratch_path(spark, "json")
    page = F.concat(F.lit('","page":"'), "event_type", F.lit('"}'))
    line = (
        F.when(F.expr("event_id % 3 = 0"), F.concat(F.lit("{broken "), "event_id"))
        .when(F.expr("event_id % 3 = 1"), F.concat(F.lit('{"event_id":"x'), "event_id", page))
        .otherwise(F.concat(F.lit('{"EVENT_ID":"'), "event_id", page))
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return json_rejects(spark, path, "event_id bigint, page string")


@query(
    "stage_ledger",
    """SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events WHERE day(ts) <= 4""",
)
def stage_ledger(spark, sf_dir):
    """Four days' files, staged out of order and more than once; the second day has a late file."""
    root, schema = scratch_path(spark, "by-day"), "event_id bigint, user_id bigint, event_type string, value double"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    late = (F.dayofmonth("day") == 2) & (F.col("event_id") % 3 == 0)

    def deliver(rows):
        rows.hint("rebalance", "day").write.mode("append").partitionBy("day").json(f"{root}/in")

    def run(*days):
        for d in days:
            template = f"{root}/in/day={{day:%Y-%m-%d}}/*.json"
            stage_run(spark, template, date(2024, 1, d), spark.read.schema(schema).json, f"{root}/staged")

    deliver(events.where((F.dayofmonth("day") <= 4) & ~late))
    run(3, 1, 1, 2)
    deliver(events.where(late))
    run(4, 2, 2, 1)
    return read_staged(spark, f"{root}/staged", schema)


DRIFTING = "event_id bigint, user_id bigint, value double, props string"


def _drifting(spark, sf_dir):
    """Events as JSON lines; from the 11th on with a device, from the 21st on with texts for users and no props."""
    root, day = scratch_path(spark, "drifting"), F.dayofmonth("ts")
    events = table(spark, sf_dir, "events").withColumn("device", F.struct(F.concat(F.lit("d"), F.expr("event_id % 5")).alias("id")))
    same = ["event_id", "value"]
    events.where(day <= 10).select(*same, "user_id", "props").write.mode("append").json(root)
    events.where(day.between(11, 20)).select(*same, "user_id", "props", "device").write.mode("append").json(root)
    named = F.concat(F.lit("u"), "user_id").alias("user_id")
    events.where(day > 20).select(*same, named, "device").write.mode("append").json(root)
    return materialize(stage_variant(spark, root, DRIFTING), "staged-variant")


@query(
    "stage_variant",
    """SELECT event_id, CASE WHEN day(ts) <= 20 THEN user_id END AS user_id, value,
              CASE WHEN day(ts) <= 20 THEN props END AS props,
              CASE WHEN day(ts) > 20 THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_text,
              CASE WHEN day(ts) > 10 THEN 'd' || event_id % 5 END AS device
       FROM events""",
)
def stage_variant_query(spark, sf_dir):
    """Typed columns, and two fields taken later from the lines as staged."""
    staged = extract(_drifting(spark, sf_dir), {"device": "struct<id: string>"})
    return staged.select(*[c.split()[0] for c in DRIFTING.split(", ")], field("user_id", "string").alias("user_text"), F.col("device.id").alias("device"))


@query(
    "stage_drift",
    """SELECT 'event_id' AS field, 'bigint' AS declared, count(*) AS lines, 'as declared' AS status FROM events
       UNION ALL SELECT 'user_id', 'bigint', count(*), 'changed' FROM events
       UNION ALL SELECT 'value', 'double', count(value), 'as declared' FROM events
       UNION ALL SELECT 'props', 'string', count(props), 'as declared' FROM events WHERE day(ts) <= 20
       UNION ALL SELECT 'device', NULL, count(*), 'new' FROM events WHERE day(ts) > 10""",
)
def stage_drift(spark, sf_dir):
    return drift_report(_drifting(spark, sf_dir), DRIFTING).select("field", "declared", "lines", "status")
