"""Staging of JSON lines whose fields change over time.

Columns of a fixed schema lose what the schema does not name. Here every line
is kept whole as a VARIANT beside its typed columns; a report says which
fields came that nobody declared, which declared ones no longer come, and
which changed their type; and a field found later is taken from what was
staged, without reading the source again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BODY = "body"

# How types of a VARIANT's values are called where they differ from the declared ones by size alone.
WHOLE = ("tinyint", "smallint", "int", "bigint")


def json_path(name: str) -> str:
    """The path of a top-level field; its name must not have both kinds of quotes."""
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"no path to a field named {name}")
    return f"$[{quote}{name}{quote}]"


def field(name: str, kind: str) -> Column:
    """A top-level field of the staged lines, null where it is missing or does not fit the type."""
    return F.try_variant_get(BODY, json_path(name), kind)


def stage_variant(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines as typed columns of ``schema`` and, whole, as the column ``body``.

    Names are compared exactly. A line that is no JSON has a null body and
    nulls for all columns. Names of the schema must not be ``body``.
    """
    declared = StructType.fromDDL(schema)
    lines = spark.read.text(path).select(F.try_parse_json("value").alias(BODY))
    return lines.select(*[field(f.name, f.dataType.simpleString()).alias(f.name) for f in declared], BODY)


def extract(staged: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Staged lines with further fields (name → type) taken from their bodies."""
    return staged.withColumns({name: field(name, kind) for name, kind in fields.items()})


def fields_seen(staged: DataFrame) -> DataFrame:
    """Each top-level field of the lines by the types it came in: lines and lines
    with a null. Combined before the shuffle: one row per field and type and task."""
    found = staged.select(BODY).where(F.schema_of_variant(BODY).startswith("OBJECT"))
    exploded = found.lateralJoin(staged.sparkSession.tvf.variant_explode(F.col(BODY).outer()))
    kind = F.lower(F.schema_of_variant("value"))
    return exploded.groupBy(F.col("key").alias("field"), kind.alias("type")).agg(F.count(F.lit(1)).alias("lines"))


def drift_report(staged: DataFrame, schema: str) -> DataFrame:
    """One row per field that was declared or seen: ``field``, ``declared`` and
    ``seen`` types, ``lines`` it came in, ``nulls`` among them, ``status``.

    The status is "new" for fields nobody declared, "missing" for those that
    never came with a value, "changed" where a value's type is not the declared
    one, else "as declared". Whole numbers of any size count as one type, and
    so do fractions, which whole numbers fit, and texts fit dates and times.
    """
    declared = StructType.fromDDL(schema)
    spark = staged.sparkSession
    names = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in declared], "field string, declared string")
    valued = F.col("type") != "void"
    seen = fields_seen(staged).groupBy("field").agg(
        F.sum("lines").alias("lines"), F.coalesce(F.sum(F.when(~valued, F.col("lines"))), F.lit(0)).alias("nulls"),
        F.array_sort(F.collect_set(F.when(valued, F.col("type")))).alias("seen"),
    )
    both = names.join(seen, "field", "full")
    wanted = _family(F.col("declared"))
    fits = F.forall("seen", lambda t: (_family(t) == wanted) | ((wanted == "fraction") & (_family(t) == "whole")))
    status = (
        F.when(F.col("declared").isNull(), "new")
        .when(F.coalesce(F.size("seen"), F.lit(0)) <= 0, "missing")
        .when(fits, "as declared")
        .otherwise("changed")
    )
    return both.select(
        "field", "declared", F.array_join(F.coalesce("seen", F.array().cast("array<string>")), ", ").alias("seen"),
        F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("nulls", F.lit(0)).alias("nulls"), status.alias("status"),
    )


def _family(kind: Column) -> Column:
    return (
        F.when(kind.isin(*WHOLE) | kind.rlike(r"^decimal\([0-9]+,0\)$"), "whole")
        .when(kind.isin("float", "double") | kind.startswith("decimal"), "fraction")
        .when(kind.isin("date", "timestamp", "timestamp_ntz"), "string")
        .otherwise(F.regexp_extract(kind, r"^\w+", 0))
    )
