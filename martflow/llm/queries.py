"""The operators over their whole tables, under names ``opN_...``."""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import conversations, decontaminate, exact_dedup, hard_negatives, html_text, language, licenses, mixing, ngram_join, pii, sharding, toxicity, url_filters
from martflow.llm.common import held_out, prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql:
            ORACLE[name] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share in a mix of 150 % of all words, and where the run reads it."""
    return mixing.mixture(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", "positions", "places"
    )


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return sharding.shard_positions(documents(spark, sf_dir), 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


@query(
    "op10_exact_dedup",
    """
    WITH t AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
      FROM documents
    )
    SELECT doc_id,
           max(doc_id) OVER (PARTITION BY body) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY body) AS kept,
           sha256(body) AS text_sha256
    FROM t
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts."""
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).withColumnRenamed("digest", "text_sha256")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return language.identify(documents(spark, sf_dir))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with the words that reveal it."""
    found = pii.findings(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"),
        *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.written(pii.base_of(F.col("spans"))), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(docs, toxicity.fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    found = decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "matched", "item_words")


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-copy component of every document: 4 words, similarity 0.85."""
    return ngram_join.jaccard_components(documents(spark, sf_dir))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    """Canonical digests, and the licence whose own canonical text has that digest.

    SQL's regular expressions cannot state the further folding of titles and
    copyright lines; a document that is a known text but for these is found by
    the query alone.
    """

    def digest(body: str) -> str:
        low = body.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        low = re.sub(licenses.COPYRIGHT, r"\1", low)
        for spelling, usual in licenses.SPELLINGS:
            low = low.replace(spelling, usual)
        return hashlib.sha256(re.sub("[^a-z0-9]+", " ", low).strip().encode()).hexdigest()

    spelt = "t"
    for spelling, usual in licenses.SPELLINGS:
        spelt = f"replace({spelt}, '{spelling}', '{usual}')"
    names = " ".join(f"WHEN '{digest(body)}' THEN {_sql_text(name)}" for name, body in licenses.bodies())
    return f"""
    WITH folded AS (
      SELECT doc_id, regexp_replace(
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        {_sql_text(licenses.COPYRIGHT)}, '\\1', 'g') AS t
      FROM documents
    ), digested AS (
      SELECT doc_id, sha256(trim(regexp_replace({spelt}, '[^a-z0-9]+', ' ', 'g'))) AS digest FROM folded
    )
    SELECT doc_id, digest, CASE digest {names} END AS license FROM digested
    """


@query("op6_licenses", _license_sql())
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its canonical digest and the known licence it is."""
    return licenses.scan(documents(spark, sf_dir), licenses.known_digests(spark)).drop("folded_digest")


def _url_sql() -> str:
    """Rules in the order in which they decide, as one CASE each for rule, pattern and verdict."""

    def first(rules, test):
        rules = sorted(rules, key=lambda r: (-len(r.pattern), r.verdict != "block", r.pattern))
        return "CASE " + " ".join(f"WHEN {test(r)} THEN {_sql_text(r.pattern)}" for r in rules) + " END"

    def is_listed(r):
        host, path = r.pattern.split("/", 1)
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"

    def is_pattern(r):
        return f"regexp_matches(seen, {_sql_text(url_filters.regex_of(r))})"

    verdicts = " ".join(f"WHEN {_sql_text(r.pattern)} THEN '{r.verdict}'" for r in url_filters.RULES)
    folded = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH t AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages
    ), parts AS (
      SELECT page_id, {folded.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
             substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS behind
      FROM t
    ), judged AS (
      SELECT page_id, host, regexp_extract(behind, '^[^?#]*') AS path, {folded.format("host || behind")} AS seen
      FROM parts
    ), named AS (
      SELECT page_id, host, path, {first(url_filters.LISTED, is_listed)} AS rule,
             CASE WHEN seen <> '' THEN {first(url_filters.PATTERNS, is_pattern)} END AS fits
      FROM judged
    )
    SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN fits END AS pattern,
           coalesce(CASE coalesce(rule, fits) {verdicts} END, 'allow') AS verdict
    FROM named
    """


@query("op12_url_filters", _url_sql())
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return url_filters.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after some damage."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repairs(conversations.damage(rows), every=rows)


@query("op13_hard_negatives")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the label of every seventh is moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.quantised(rows.withColumn("label", moved)), "vec_id % 100 = 0")
