"""Raw files into typed staging frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martflow.functions.timeparts import from_epoch_ms


def _target(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _typed(text: Column, type_name: str, epoch_ms: bool) -> Column:
    if epoch_ms:
        return from_epoch_ms(text.try_cast("bigint"))
    return text if type_name == "string" else text.try_cast(type_name)


def stage_json_paths(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType,
    paths: Mapping[str, str],
    epoch_ms: Iterable[str] = (),
) -> DataFrame:
    """JSON lines to columns through an explicit column → JSON path map.

    Paths are names joined by dots below the root, as in ``$.user.id``. Columns
    named in ``epoch_ms`` hold epoch milliseconds and become timestamps.
    """
    millis = set(epoch_ms)
    steps = {column: path.removeprefix("$.").split(".") for column, path in paths.items()}
    # The paths make up one nested schema of text, so a line is parsed once.
    parsed = spark.read.schema(_nested(list(steps.values()))).json(path)
    return parsed.select(
        *[
            _typed(
                F.col(".".join(f"`{step}`" for step in steps[f.name])),
                f.dataType.simpleString(),
                f.name in millis,
            ).alias(f.name)
            for f in _target(schema)
        ]
    )


def _nested(paths: list[list[str]]) -> StructType:
    """The smallest schema in which every path leads to a text field."""
    children: dict[str, list[list[str]]] = {}
    for first, *rest in paths:
        children.setdefault(first, []).extend([rest] if rest else [])
    return StructType(
        [StructField(name, _nested(below) if below else StringType()) for name, below in children.items()]
    )


def stage_json_auto(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType,
    epoch_ms: Iterable[str] = (),
    strict: bool = False,
) -> DataFrame:
    """JSON lines to columns of the same name, whatever the case of the keys.

    Keys the schema does not name are ignored; columns no key fits are null. A
    line that is no JSON object gives a row of nulls and a value that does not
    fit its type a null: ``json_rejects`` finds them, and ``strict`` makes the
    first one fail the job instead.
    """
    lines, typed, reason = _auto_columns(spark, path, schema, epoch_ms)
    if strict:
        message = F.concat(reason, F.lit(": "), F.col("value"))
        lines = lines.filter(F.when(reason.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))
    return lines.select(*[column.alias(name) for name, column in typed.items()])


def json_rejects(
    spark: SparkSession, path: str | list[str], schema: str | StructType, epoch_ms: Iterable[str] = ()
) -> DataFrame:
    """(``line``, ``reason``) for each line ``stage_json_auto`` cannot take
    whole: "no object", or the columns whose values do not fit."""
    lines, _, reason = _auto_columns(spark, path, schema, epoch_ms)
    return lines.select(F.col("value").alias("line"), reason.alias("reason")).filter("reason IS NOT NULL")


def _auto_columns(
    spark: SparkSession, path: str | list[str], schema: str | StructType, epoch_ms: Iterable[str]
) -> tuple[DataFrame, dict[str, Column], Column]:
    """Parsed lines, the schema's columns over them, and why a line is rejected or null."""
    millis = {name.lower() for name in epoch_ms}
    # One parse per line, into its keys in lower case and their values. Where a
    # line holds a key in two spellings the first one counts.
    pairs = F.from_json("value", "map<string,string>")
    lines = spark.read.text(path).select("value", pairs.alias("pairs"))
    fields = lines.select(
        "value",
        F.col("pairs").isNull().alias("broken"),
        F.transform(F.map_keys("pairs"), F.lower).alias("names"),
        F.map_values("pairs").alias("texts"),
    )

    typed, misfits = {}, []
    for f in _target(schema):
        text = F.get("texts", (F.array_position("names", f.name.lower()) - 1).cast("int"))
        typed[f.name] = _typed(text, f.dataType.simpleString(), f.name.lower() in millis)
        misfits.append(F.when(text.isNotNull() & typed[f.name].isNull(), F.lit(f.name)))
    names = F.concat_ws(",", *misfits)
    reason = F.when(F.col("broken"), "no object").when(names != "", names)
    return fields, typed, reason


def stage_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType,
    sep: str = ",",
    ignore_header: int = 1,
) -> DataFrame:
    """CSV to columns by position: file column *i* fills schema column *i*.

    Spark skips at most one line per file, so only 0 and 1 are accepted.
    """
    if ignore_header not in (0, 1):
        raise ValueError("ignore_header must be 0 or 1")
    return spark.read.schema(_target(schema)).csv(
        path, header=ignore_header == 1, sep=sep, enforceSchema=True, quote='"', escape='"'
    )


def templated(path: str, **context) -> str:
    """Fill a path template such as ``log/{date:%Y/%m}`` from the run context."""
    return path.format(**context)
