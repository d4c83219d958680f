"""A load in dependency order: staging, fact, dimensions, quality gate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from martflow.operators.quality import enforce, nonempty_report
from martflow.sinks.observed import Watch, load_watched, watched_report

# Builds a table from those written before it, by name.
Build = Callable[[Mapping[str, DataFrame]], DataFrame]


def run_load(
    spark: SparkSession,
    out: str,
    staged: Mapping[str, DataFrame],
    fact: Mapping[str, Build],
    dimensions: Mapping[str, Build],
    truncate: bool = True,
    not_null: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Write staging tables, then the fact, then the dimensions, and check them.

    Raw sources are parsed once, into staging tables that are always replaced;
    fact and dimensions are replaced or added to. A dimension may draw on the
    fact but not on another dimension. Returns the row counts of the fact and
    the dimensions, or raises when one of them came out empty or has a null in
    a column that ``not_null`` names for it. Rows are counted as they are
    written; only a table that was added to is asked for its row count.
    """
    written: dict[str, DataFrame] = {}
    watches: dict[str, Watch] = {}

    def write(name: str, df: DataFrame, replace: bool) -> None:
        watches[name] = Watch(name, (not_null or {}).get(name, ()), may_be_empty=not replace)
        load_watched(df, f"{out}/{name}", replace, watches[name])
        written[name] = spark.read.schema(df.schema).parquet(f"{out}/{name}")

    for name, source in staged.items():
        write(name, source, replace=True)
    tables = {**fact, **dimensions}
    for name, build in tables.items():
        write(name, build(written), truncate)
    enforce(watched_report(spark, [watches[name] for name in tables]))
    if not truncate:
        return enforce(nonempty_report({name: written[name] for name in tables}))
    counts = [(name, watches[name].rows, True) for name in tables]
    return spark.createDataFrame(counts, "table_name string, row_count bigint, passed boolean")
