"""Incremental staging of a directory that keeps growing.

A file-source stream remembers which files it has read, so each run stages
only what is new and a repeated run stages nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from martflow.session import delete_folder, folder_exists
from martflow.sinks.tables import replace_table
from martflow.sinks.writers import Merge, merge_partitions, write_parquet
from martflow.sources.readers import read_partitioned


def run_available(
    spark: SparkSession,
    source: str,
    fmt: str,
    schema: str,
    progress: str,
    on_batch: Callable[[DataFrame, int], None],
    files_per_batch: int | None = None,
    **options,
) -> None:
    """Hand every unseen file below ``source`` to ``on_batch``, then stop.

    ``progress`` is the stream's checkpoint, in shared storage. After a
    failure the last batch is handed over again under the same number.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.load(source)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stage_incrementally(
    spark: SparkSession, source: str, fmt: str, schema: str, target: str, progress: str,
    files_per_batch: int | None = None, **options,
) -> DataFrame:
    """Append unseen files to a staging directory, each row exactly once.

    A batch owns one partition directory and overwrites it when replayed.
    Before the first file has come the result is an empty frame of the schema.
    """

    def stage(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    run_available(spark, source, fmt, schema, progress, stage, files_per_batch, **options)
    if not folder_exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch bigint").parquet(target).drop("batch")


def upsert_incrementally(
    spark: SparkSession, source: str, fmt: str, schema: str, table: str, root: str, progress: str,
    merge: Merge, files_per_batch: int | None = None, **options,
) -> DataFrame:
    """Merge unseen files into an existing catalog table, batch by batch.

    For tables small enough to be rewritten with every batch, such as
    dimensions. ``merge(target, incoming)`` is one of the upserts; replaying a
    batch merges the same rows again and changes nothing. Each batch writes a
    new version of the table below ``root`` and switches to it. A batch has two
    directories to choose from, so the one being read is never the one being
    written. The version before the current one is kept for readers still at
    it, older ones are deleted.
    """

    def apply(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        current = session.table(table)
        read_from = current.inputFiles()
        versions = (f"{root}/batch-{number}-a", f"{root}/batch-{number}-b")
        target = next(v for v in versions if not any(v in path for path in read_from))
        replace_table(merge(current, batch), table, target)
        for outdated in ("a", "b") if number >= 2 else ():
            delete_folder(session, f"{root}/batch-{number - 2}-{outdated}")

    run_available(spark, source, fmt, schema, progress, apply, files_per_batch, **options)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def merge_partitions_incrementally(
    spark: SparkSession, source: str, fmt: str, schema: str, path: str, target_schema: str,
    partition_by: Sequence[str], progress: str, prepare: Callable[[DataFrame], DataFrame], merge: Merge,
    files_per_batch: int | None = None, **options,
) -> DataFrame:
    """Merge unseen files into a partitioned directory, rewriting only what they touch.

    For tables too large to be rewritten. ``prepare`` gives the incoming rows
    the target's columns; ``merge`` is one of the upserts, on keys that
    include or determine the partition columns.
    """
    write_parquet(spark.createDataFrame([], target_schema), path, partition_by, mode="append", gather=False)

    def apply(batch: DataFrame, number: int) -> None:
        target = read_partitioned(batch.sparkSession, path, target_schema)
        merge_partitions(target, prepare(batch), path, partition_by, merge)

    run_available(spark, source, fmt, schema, progress, apply, files_per_batch, **options)
    spark.catalog.refreshByPath(path)
    return read_partitioned(spark, path, target_schema)
