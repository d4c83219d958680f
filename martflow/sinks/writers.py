"""File sinks and load modes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from martflow.session import materialize

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    gather: bool = True,
) -> None:
    """Parquet below ``path``, one directory per value of ``partition_by``.

    A partitioned write first gathers the rows of each value, so that every
    directory gets few files; the rebalance hint lets AQE split a value that
    is larger than one partition should be. ``gather=False`` saves that
    shuffle where rows already lie together. ``mode="errorifexists"`` refuses
    an existing target.
    """
    if partition_by:
        if gather:
            df = df.hint("rebalance", *partition_by)
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, rows_per_file: int = 500_000) -> None:
    """JSON lines, compressed: names repeat in every line, so a tenth of the bytes is left.

    A compressed file is read by one task, so no file gets more than
    ``rows_per_file`` rows. File names end in ``.json.gz``.
    """
    df.write.option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).json(path)


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    columns: Sequence[str] | None = None,
    quote_all: bool = False,
    mode: str = "overwrite",
) -> None:
    """CSV with a header line in every file; ``read_csv`` returns what was written.

    Outer spaces are kept. A null is an empty field and empty text a quoted
    one. Where that cannot tell them apart, with all fields quoted or in a
    single column, a null is written as ``\\N``. Text with line breaks is
    quoted and needs ``multi_line`` when it is read.
    """
    chosen = df.select(*columns) if columns else df
    null = r"\N" if quote_all or len(chosen.columns) == 1 else ""
    chosen.write.mode(mode).csv(
        path, header=True, sep=sep, quote='"', escape='"', quoteAll=quote_all, nullValue=null, emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def load(df: DataFrame, path: str, truncate: bool) -> None:
    """Load a table directory: replace its rows, or add to them."""
    df.write.mode("overwrite" if truncate else "append").parquet(path)


def _in_partitions(target: DataFrame, touched: Sequence[Row], names: Sequence[str]) -> Column:
    """Whether a row lies in one of the partitions, as a filter on literals."""

    def value(name: str, v) -> Column:
        return F.lit(v).cast(target.schema[name].dataType)

    if len(names) == 1:
        name = names[0]
        known = [value(name, r[0]) for r in touched if r[0] is not None]
        held = F.col(name).isin(*known) if known else F.lit(False)
        return held | F.col(name).isNull() if any(r[0] is None for r in touched) else held
    held = F.lit(False)
    for r in touched:
        here = [F.col(n).isNull() if v is None else F.col(n) == value(n, v) for n, v in zip(names, r, strict=True)]
        held = held | reduce(and_, here)
    return held


def merge_partitions(
    target: DataFrame, incoming: DataFrame, path: str, partition_by: Sequence[str], merge: Merge
) -> None:
    """Merge new rows into the partitions they touch; all others stay as they are.

    ``target`` is the scan of ``path`` and ``merge(target, incoming)`` one of
    the upserts, on keys that include or determine the partition columns. Only
    touched partitions are read, merged and replaced; a null partition value is
    a partition like others. The touched values, names of partitions, are put
    into the plan as literals, so the scan is pruned before it runs. The merged
    rows are staged in the shared folder before anything is overwritten.
    """
    names = list(partition_by)
    current = target.filter(_in_partitions(target, incoming.select(*names).distinct().collect(), names))
    merged = materialize(merge(current, incoming), "merged-partitions")
    (
        merged.hint("rebalance", *names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*names)
        .parquet(path)
    )


def load_table(df: DataFrame, table: str, truncate: bool) -> None:
    """Load a catalog table by column position, as ``INSERT ... SELECT`` does."""
    df.write.insertInto(table, overwrite=truncate)
