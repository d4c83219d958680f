"""Catalog tables: declaration, replacement and physical layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martflow.session import scratch_path


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def drop_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def create_table(
    spark: SparkSession, name: str, ddl: str, location: str, partition_by: Sequence[str] = ()
) -> None:
    """An external Parquet table with the declared columns, unless it exists."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{parts} LOCATION '{location}'")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def reset_tables(spark: SparkSession, declared: Mapping[str, str], root: str) -> None:
    """Drop and re-create empty tables.

    ``declared`` maps names to columns, referenced tables before those that
    refer to them; they are dropped in the opposite order. Each table starts
    in a directory of its own that holds no earlier rows.
    """
    for name in reversed(declared):
        drop_table(spark, name)
    for name, ddl in declared.items():
        fresh = scratch_path(spark, name).rsplit("/", 1)[1]
        create_table(spark, name, ddl, f"{root}/{fresh}")


def replace_table(df: DataFrame, name: str, location: str) -> None:
    """Point a table at a new directory holding ``df``.

    Safe when ``df`` reads the table itself: the rows go to ``location``,
    which must be unused (else this raises), and only a finished write is switched to. Readers
    see the old rows or the new ones, never a mixture.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(location)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=location, source="parquet")


LAST_NUMBER = "martflow.last_number"


def last_number(spark: SparkSession, table: str, column: str) -> int:
    """The last number given to a row of a table, 0 if none was.

    Kept as a property of the table; a table without it is looked through once.
    """
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(LAST_NUMBER)
    if kept is not None:
        return int(kept)
    return spark.table(table).agg(F.coalesce(F.max(column), F.lit(0))).first()[0]


def keep_number(spark: SparkSession, table: str, number: int) -> None:
    """Remember the last number given, before the rows that have it are written."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LAST_NUMBER}' = '{number}')")


def write_distributed(
    df: DataFrame,
    table: str,
    location: str,
    key: str,
    sort_by: Sequence[str],
    buckets: int,
    layout: str = "bucketed",
    files_per_bucket: int = 1,
) -> None:
    """A table laid out for joins, aggregates and lookups on ``key``.

    "bucketed": grouped by ``key`` without a shuffle, and a point lookup opens
    one bucket. All rows of a key are in one bucket; ``files_per_bucket``
    spreads the writing of each bucket, and so of a hot key, over as many
    tasks, but a scan by buckets reads it in one.

    "ranged": for keys that may be hot. Rows are range-partitioned on the sort
    columns, so a hot key spans several files, lookups skip files by their
    column statistics, and readers that group by ``key`` shuffle.

    The caller chooses; the data never change the layout.
    """
    if layout == "bucketed":
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
        dealt = df.repartition(buckets * files_per_bucket, key, *([spread] if files_per_bucket > 1 else []))
        writer = dealt.write.bucketBy(buckets, key).sortBy(*sort_by)
    elif layout == "ranged":
        ties = {"_tie": F.xxhash64(*df.columns), "_copy": F.spark_partition_id()}
        ranged = df.withColumns(ties).repartitionByRange(buckets, *sort_by, *ties)
        writer = ranged.sortWithinPartitions(*sort_by).drop(*ties).write
    else:
        raise ValueError(f"no such layout: {layout}")
    writer.format("parquet").mode("overwrite").option("path", location).saveAsTable(table)


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows per column whose text is longer than the column allows."""
    counted = df.agg(
        *[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()]
    )
    return counted.unpivot([], list(limits), "column_name", "violations")


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
