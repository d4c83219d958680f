"""Code tables kept as CSV whose text fields hold unquoted commas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    return spark.read.text(path).where((F.trim("value") != "") & (F.trim("value") != header))


def read_code_names(
    spark: SparkSession, path: str, code: str, name: str, code_type: str = "int"
) -> DataFrame:
    """``code,name`` lines, cut at the first comma only.

    Lines without a comma, or whose code does not fit ``code_type``, keep a
    null code so that a report can count them.
    """
    value = F.col("value")
    cut = F.instr(value, ",")
    raw_code = F.when(cut > 0, F.trim(F.substring(value, F.lit(1), cut - 1)))
    raw_name = F.when(cut > 0, F.trim(F.substring(value, cut + 1, F.length(value)))).otherwise(
        F.trim(value)
    )
    return _lines(spark, path, f"{code},{name}").select(
        raw_code.try_cast(code_type).alias(code), raw_name.alias(name)
    )


def read_code_name_tail(spark: SparkSession, path: str, code: str, name: str, tail: str) -> DataFrame:
    """``code,name,tail`` lines: first field, last field, all between as name.

    A line of two fields has no tail.
    """
    fields = F.split("value", ",")
    n = F.size(fields)
    return _lines(spark, path, f"{code},{name},{tail}").select(
        F.trim(fields[0]).alias(code),
        F.when(n == 2, F.trim(F.get(fields, F.lit(1))))
        .when(n > 2, F.trim(F.array_join(F.slice(fields, F.lit(2), n - 2), ",")))
        .alias(name),
        F.when(n > 2, F.trim(F.get(fields, n - 1))).alias(tail),
    )
