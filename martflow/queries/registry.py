"""The table of named queries, each beside the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its equivalent SQL."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its file footers are read for the schema once only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)
