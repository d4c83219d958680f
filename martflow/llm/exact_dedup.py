"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Copies are merged inside each task, then among the rows of a digest that share
a salt, then among the salts' winners. Every one of these groupings has the
whole text among its keys, so texts are compared in full at each stage and two
texts with one digest stay apart. A text held by a third of all rows sends one
row per task to the first shuffle and one row per salt to the second.

Defined results: null text counts as empty. Upper-case A-Z alone is folded.
Rows with a null id form groups like others; such a row stays only if its
group has no id at all. Rows that repeat both id and text are equally kept.
Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import join_per_key
from martflow.session import materialize

SALTS = 16


def normalised(text: Column) -> Column:
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def copy_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per text that several rows share, or that shares its digest.

    Columns: ``digest``, ``keep_id``, ``group_size``, ``texts`` (texts of that
    digest) and ``body``, the text itself where ``texts`` is above 1.
    """
    rows = docs.select(
        F.col(key).alias("_id"), normalised(F.col(text)).alias("_text")
    ).withColumns({"_digest": digest(F.col("_text")), "_salt": F.pmod(F.xxhash64("_id"), F.lit(salts))})
    salted = rows.groupBy("_digest", "_salt", "_text").agg(
        F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n")
    )
    # Dealt by digest, so that the last grouping and the count of texts per
    # digest need no further shuffle. A digest has one row per text and salt.
    winners = (
        salted.repartition("_digest")
        .groupBy("_digest", "_text")
        .agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))
        .withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("_digest")))
    )
    shared = winners.filter((F.col("group_size") > 1) | (F.col("texts") > 1)).select(
        F.col("_digest").alias("digest"),
        "keep_id",
        "group_size",
        "texts",
        F.when(F.col("texts") > 1, F.col("_text")).alias("body"),
    )
    return materialize(shared, "copy-groups")


def exact_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Per row: ``key``, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Of equal texts the row with the largest id stays.
    """
    groups = copy_groups(docs, key, text, salts, digest)
    rows = docs.select(
        F.col(key).alias("_id"),
        digest(normalised(F.col(text))).alias("digest"),
        normalised(F.col(text)).alias("body"),
    )
    plain = groups.filter(F.col("texts") == 1).drop("body", "texts")
    clashing = groups.filter(F.col("texts") > 1).drop("texts")
    if clashing.isEmpty():
        alone = rows.drop("body")
        parts = []
    else:
        of_clash = clashing.select("digest").distinct()
        alone = rows.join(of_clash, "digest", "left_anti").drop("body")
        parts = [rows.join(clashing, ["digest", "body"]).drop("body")]
    parts.append(join_per_key(alone, plain, ["digest"], "group_size", docs.count()))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    in_group = F.col("group_size").isNotNull()
    keep = F.when(in_group, F.col("keep_id")).otherwise(F.col("_id"))
    return found.select(
        F.col("_id").alias(key),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    Rows are judged, not ids: the row with the largest id stays, a null id
    being the least; of rows that share it any one. The rows are written once,
    numbered, so that all steps mean the same row by a number.
    """
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_n"))
    numbered = materialize(numbered, "numbered-rows")
    told = numbered.select(F.struct(F.col(f"_row.`{key}`").alias("id"), "_n").alias("_told"), F.col(f"_row.`{text}`").alias("_text"))
    gone = exact_dedup(told, "_told", "_text").filter(~F.col("kept")).select(F.col("_told._n").alias("_n"))
    return numbered.join(gone, "_n", "left_anti").select(*[F.col(f"_row.`{c}`") for c in docs.columns])
