"""Staging by logical date, in any order, any number of times.

A ledger says which version of which file was staged, by which load and for
which date. A run takes the files of its date that the ledger lacks; its rows
count when its line is in the ledger, which is written last. So a run that is
repeated stages nothing, a run that crashed left nothing behind that anyone
reads, an older date may be filled in at any time, and a file that was
delivered anew replaces the rows of its earlier version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.joins import replicate
from martflow.session import folder_exists
from martflow.sources.staging import templated

VERSION = ["path", "length", "modified"]
LEDGER = "path string, length bigint, modified timestamp, day date, load string, staged_at timestamp"

# Reads files with a given list of paths; a plain scan, which knows each row's file.
Read = Callable[[list[str]], DataFrame]


def inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """The files a path pattern fits: name to read them by, path as rows tell it
    (an encoded URI), size and time; contents are not read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(
        F.col("path").alias("name"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """Every version of every file that was staged below ``target``."""
    path = f"{target}/_ledger"
    return spark.read.schema(LEDGER).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], LEDGER)


def current_versions(entries: DataFrame) -> DataFrame:
    """The version of each file that counts: the one staged last."""
    last = F.max_by(F.struct("load", "day"), F.struct("staged_at", "modified", "load"))
    return entries.groupBy("path").agg(last.alias("of")).select("path", "of.load", "of.day")


def unstaged(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Files of an inventory whose version is not in the ledger."""
    return files.join(entries.select(*VERSION).distinct(), VERSION, "left_anti").select(*files.columns)


def stage_run(spark: SparkSession, template: str, day: date, read: Read, target: str) -> int:
    """Stage the files of one logical date that are not staged yet; how many they were.

    ``template`` is a path pattern with ``{day}`` in it. ``read`` must be a scan
    with no shuffle, so that rows can tell their file. A date without files is
    a run of nothing, not an error. Two runs at a time over the same files
    would stage them twice; the one that ends last counts.
    """
    pattern = templated(template, day=day)
    try:
        files = inventory(spark, pattern).collect()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        files = []
    schema = "name string, path string, length bigint, modified timestamp"
    new = unstaged(spark.createDataFrame(files, schema), ledger(spark, target)).collect() if files else []
    if not new:
        return 0
    load = uuid.uuid4().hex
    rows = read([r.name for r in new]).withColumn("_file", F.col("_metadata.file_path"))
    rows.write.mode("errorifexists").parquet(f"{target}/rows/load={load}")
    entries = spark.createDataFrame(new, schema).select(*VERSION).withColumns(
        {"day": F.lit(day), "load": F.lit(load), "staged_at": F.current_timestamp()}
    )
    entries.coalesce(1).write.mode("append").parquet(f"{target}/_ledger")
    return len(new)


def read_staged(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The staged rows, each file in the version that counts, with their logical ``day``.

    Loads without a line in the ledger are not read. The ledger's lines, one
    per file, are copied to the rows where they are few, else shuffled.
    """
    entries = ledger(spark, target)
    loads = [r.load for r in entries.select("load").distinct().collect()]
    if not loads:
        return spark.createDataFrame([], f"{schema}, day date")
    rows = spark.read.schema(f"{schema}, _file string, load string").parquet(f"{target}/rows").where(F.col("load").isin(loads))
    current = current_versions(entries).select(F.col("path").alias("_file"), "load", "day")
    return rows.join(replicate(current), ["_file", "load"]).drop("_file", "load")
