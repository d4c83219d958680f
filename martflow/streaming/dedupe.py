"""Lines that a growing directory brings more than once are staged once.

The file source remembers files, not rows: a log that is exported again under
another name comes again. Here each batch is compared with the keys of the
lines staged before it. What is remembered is bounded by a watermark, the
greatest time of all earlier batches less a delay: keys older than it are
forgotten, and a line older than it, of which nobody can say any more whether
it is new, is set aside and counted rather than staged or lost.

Everything a batch writes is in directories under its number, and it reads
only those of lower numbers. A batch that is handed over again after a failure
writes the same once more.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.aggregates import one_row_per_key
from martflow.operators.pruning import PRUNE_FROM, estimated_bytes, held_rows
from martflow.operators.upsert import without_keys
from martflow.session import delete_folder, folder_exists
from martflow.streaming.incremental import run_available

COUNTS = "batch bigint, watermark string, latest string, total bigint, staged bigint, repeated bigint, late bigint"


class Deduplicated(NamedTuple):
    """Lines staged once, lines set aside as late, and what each batch did."""

    rows: DataFrame
    late: DataFrame
    batches: DataFrame


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not folder_exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return spark.read.schema(f"{schema}, batch bigint").parquet(path)


def _write(rows: DataFrame, path: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={number}")


def stage_deduplicated(
    spark: SparkSession, source: str, fmt: str, schema: str, target: str, progress: str,
    keys: Sequence[str], at: str, delay: str, order_by: Sequence[str] = (),
    files_per_batch: int | None = None, prune_from: int = PRUNE_FROM, **options,
) -> Deduplicated:
    """Stage unseen files below ``target`` so that no key comes twice.

    ``keys`` tell a line and ``at`` is its time; a repeated line has the same
    of both. ``delay`` is an interval, as in ``"2 days"``: how much earlier
    than the latest line so far a line may be. Of a key's rows in one batch the
    first counts, by ``order_by``. Null keys equal null keys. Rows without a
    time cannot age; they are set aside with the late ones.
    """
    kind = dict(spark.createDataFrame([], schema).dtypes)
    told = list(dict.fromkeys([*keys, at]))
    seen_schema = ", ".join(f"`{c}` {kind[c]}" for c in told)
    paths = {name: f"{target}/{name}" for name in ("rows", "late", "seen", "batches")}

    def moment(text: str | None):
        return F.lit(text).cast(kind[at])

    def stage(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = _read(session, paths["batches"], COUNTS.split(", ", 1)[1]).where(F.col("batch") < number)
        latest = before.agg(F.max(F.col("latest").cast(kind[at])).cast("string")).first()[0]
        mark = (moment(latest) - F.expr(f"INTERVAL {delay}")).cast(kind[at])
        aged = F.col(f"`{at}`").isNull() if latest is None else F.coalesce(F.col(f"`{at}`") < mark, F.lit(True))

        _write(batch.where(aged), paths["late"], number)
        fresh = one_row_per_key(batch.where(~aged), told, order_by, latest=False)
        # Of earlier keys only those that can still come again; their times prune older files.
        known = _read(session, paths["seen"], seen_schema).where(F.col("batch") < number)
        known = (known if latest is None else known.where(F.col(f"`{at}`") >= mark)).select(*told)
        if estimated_bytes(known) >= prune_from:
            known = held_rows(known, batch.select(*told), told)
        new = without_keys(fresh, known, told).select(*batch.columns)
        _write(new, paths["rows"], number)
        staged = session.read.schema(schema).parquet(f"{paths['rows']}/batch={number}")
        _write(staged.select(*told), paths["seen"], number)

        late = session.read.schema(schema).parquet(f"{paths['late']}/batch={number}").count()
        counts = batch.agg(
            (F.lit(None) if latest is None else mark).cast("string").alias("watermark"),
            F.max(F.col(f"`{at}`")).cast("string").alias("latest"), F.count(F.lit(1)).alias("total"),
        ).withColumns({"staged": F.lit(staged.count()).cast("long"), "late": F.lit(late).cast("long")})
        counts = counts.withColumn("repeated", F.col("total") - F.col("staged") - F.col("late"))
        names = [c.split()[0] for c in COUNTS.split(", ")[1:]]
        _write(counts.select(*names).coalesce(1), paths["batches"], number)
        if latest is not None:
            _forget(session, before.where(F.col("latest").cast(kind[at]) < mark), paths["seen"])

    run_available(spark, source, fmt, schema, progress, stage, files_per_batch, **options)
    batches = _read(spark, paths["batches"], COUNTS.split(", ", 1)[1])
    return Deduplicated(
        _read(spark, paths["rows"], schema).drop("batch"), _read(spark, paths["late"], schema).drop("batch"),
        batches.select(*[c.split()[0] for c in COUNTS.split(", ")]),
    )


def _forget(spark: SparkSession, aged: DataFrame, seen: str) -> None:
    """Delete the keys of batches all of whose lines are older than the watermark."""
    for row in aged.select("batch").collect():
        delete_folder(spark, f"{seen}/batch={row.batch}")
