"""File scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Schema = str | StructType


def read_json(spark: SparkSession, path: str | list[str], schema: Schema | None = None) -> DataFrame:
    """JSON lines below a path or glob.

    Without a schema Spark reads the files once more just to find one, so
    large sources should state theirs.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_tree(
    spark: SparkSession, root: str, suffix: str, fmt: str, schema: Schema | None = None, **options
) -> DataFrame:
    """Every file with the given suffix at any depth below ``root``."""
    reader = (
        spark.read.format(fmt)
        .options(**options)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
    )
    return (reader.schema(schema) if schema else reader).load(root)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """CSV files that each start with a header line, as one frame.

    Quoted fields may hold separators; a doubled quote stands for a quote. An
    empty field and ``\\N`` are null, a quoted empty field is empty text.
    Without a schema every column is text and a file whose header differs from
    the first file's is refused. ``multi_line`` allows line breaks in quoted
    fields, but then no file can be split among tasks.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.csv(
        path, header=True, sep=sep, quote='"', escape='"', nullValue=r"\N", multiLine=multi_line,
        enforceSchema=schema is not None,
    )


def read_csv_typed(
    spark: SparkSession, path: str, types: Mapping[str, str], sep: str = ","
) -> DataFrame:
    """Header CSV read as text, with the named columns cast afterwards.

    Columns are found by header name, in whatever order the files have them;
    all files must have the same header. Text that does not fit its type
    becomes null.
    """
    text = read_csv(spark, path, sep=sep)
    return text.withColumns({c: F.trim(F.col(f"`{c}`")).try_cast(t) for c, t in types.items()})


def read_any(
    spark: SparkSession, path: str, fmt: str, schema: Schema | None = None, **options
) -> DataFrame:
    """A scan whose format and options come from configuration."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_partitioned(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """A partitioned Parquet directory with its columns' types declared.

    Left to itself partition discovery turns the text ``01`` into a number.
    """
    return spark.read.schema(schema).parquet(path)


def list_files(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """Path, size and time of every file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )
