"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a verdict and a pattern in the syntax of ad-block lists:

    ||   the host or one of its subdomains begins here     *  any characters
    |    first: the url begins here; last: it ends here    ^  a separator or the end

All else stands for itself. Patterns see the url from its host on. A *listed*
rule is a host and a path prefix, written ``host/path``; it decides before
every other, and its path is compared case for case. Other rules ignore the
case of A-Z.

A literal token of a pattern is a run of letters and digits that must be a
whole such run of every url it fits, so each rule is filed under one of its
tokens alone: the one fewest urls have. A url's tokens fetch its candidates,
and only for these are regular expressions run. Rules without a token are
filed under the empty token, which every url has.

Of the rules that fit, listed ones come first, then longer ones, then those
that block, then the least pattern. With none, the verdict is ``allow``.

Nulls and urls without ``://`` have an empty host and path and fit no rule.
Repeated rows and ids are judged each for itself; other columns are not read.
An empty table gives an empty result, an empty rule list allows everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import map_batches
from martflow.operators.joins import replicate
from martflow.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\z)"
SUBDOMAINS = r"\A(?:[^/?#]*\.)?"


class Rule(NamedTuple):
    verdict: str
    pattern: str
    listed: bool = False


# Fixed values of the contract.
LISTED = [
    Rule("allow", "org/", True),
    Rule("block", "example.org/es/", True),
    Rule("block", "example.org/en/1", True),
    Rule("allow", "com/fr/", True),
    Rule("block", "com/de/", True),
]

# Link farms, pharmacies, gambling, adult pages, files that are not pages, and
# addresses of accounts, carts, calendars and adverts.
PATTERNS = [
    *[Rule("block", p) for p in (
        "-pills.", "||cheap-pills.", "||spam-", "-farm.", "||*.viagra.", "||*casino*.", "||*poker*.",
        "||xxx.", "||*.xxx^", "/porn/", "/casino/", "/login^", "/signin^", "/cart^", "/checkout^", "/calendar/",
        "||ads.", "||adserver.", "/adclick^", "?replytocom=", "&replytocom=", "/wp-login.php", "/feed/|",
        ".jpg|", ".jpeg|", ".png|", ".gif|", ".zip|", ".exe|", ".mp4|", ".css|", ".js|",
    )],
    *[Rule("allow", p) for p in ("||*.edu/", "||*.gov/", "||docs.", "/wiki/")],
]

RULES = LISTED + PATTERNS


def regex_of(rule: Rule) -> str:
    """The regular expression a rule stands for, as Java and RE2 read it."""
    pattern = f"||{rule.pattern}" if rule.listed else rule.pattern.translate(str.maketrans(UPPER, LOWER))
    head = tail = ""
    if pattern.startswith("||"):
        head, pattern = SUBDOMAINS, pattern[2:]
    elif pattern.startswith("|"):
        head, pattern = r"\A", pattern[1:]
    if rule.listed:
        return head + _literal(pattern)
    if pattern.endswith("|"):
        tail, pattern = r"\z", pattern[:-1]
    wild = {"*": r"[\s\S]*", "^": SEPARATOR}
    return head + "".join(wild.get(p) or _literal(p) for p in re.split(r"([*^])", pattern)) + tail


def _literal(text: str) -> str:
    return re.sub(r"([!-/:-@\[-^`{-~])", r"\\\1", text)


def tokens_of(rule: Rule) -> list[str]:
    """The runs of letters and digits that a url must have whole to fit the rule."""
    pattern = f"||{rule.pattern}" if rule.listed else rule.pattern
    pattern = pattern.translate(str.maketrans(UPPER, LOWER))
    starts, ends = pattern.startswith("|"), pattern.endswith("|") and not rule.listed
    pattern = pattern.strip("|") if not rule.listed else pattern[2:]
    whole = []
    for run in re.finditer(TOKEN, pattern):
        before, after = pattern[: run.start()][-1:], pattern[run.end() :][:1]
        open_wild = "" if rule.listed else "*"
        left = starts if not before else before != open_wild
        right = ends if not after else after != open_wild
        if left and right:
            whole.append(run.group())
    return sorted(set(whole))


def rule_rows(spark: SparkSession, rules: Iterable[Rule] = RULES) -> DataFrame:
    """A rule list as a table of ``verdict``, ``pattern``, ``listed``."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, pattern string, listed boolean")


def read_rules(rules: DataFrame) -> DataFrame:
    """Rules with their regular expressions and tokens; blank patterns are no rules."""

    def make():
        def read(batch):
            found = [Rule(v, p, bool(s)) for v, p, s in zip(batch["verdict"], batch["pattern"], batch["listed"])]
            found = [r for r in found if r.pattern and r.verdict]
            return {
                "verdict": [r.verdict for r in found],
                "pattern": [r.pattern for r in found],
                "listed": [r.listed for r in found],
                "regex": [regex_of(r) for r in found],
                "tokens": [tokens_of(r) for r in found],
            }

        return read

    schema = "verdict string, pattern string, listed boolean, regex string, tokens array<string>"
    return map_batches(rules.select("verdict", "pattern", "listed"), make, schema)


def fold(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_parts(url: Column) -> dict[str, Column]:
    """Host (A-Z lower-cased) and path, both empty where there is no ``://``; and
    the url from its host on."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest))
    return {
        "host": fold(host),
        "path": F.regexp_extract(behind, r"\A[^?#]*", 0),
        "subject": F.concat(fold(host), behind),
    }


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule under its token that is rarest in ``tokens``, a column ``token``
    of one row per url and token; ties go to the least token."""
    filed = rules.withColumn("token", F.explode_outer("tokens")).drop("tokens")
    wanted = materialize(filed.select("token").where("token IS NOT NULL").distinct(), "rule-tokens")
    counts = tokens.join(replicate(wanted), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = (
        filed.join(counts, "token", "left")
        .groupBy("verdict", "pattern", "listed", "regex")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("of"))
    )
    return rarest.select(F.coalesce("of.token", F.lit("")).alias("token"), "verdict", "pattern", "listed", "regex")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Every fit of a rule to one of the distinct ``url``, found through the index."""
    parts = url_parts(F.col("url"))
    subjects = urls.select("url", parts["subject"].alias("subject")).where("subject <> ''")
    held = F.array_distinct(F.regexp_extract_all(fold(F.col("subject")), F.lit(TOKEN), F.lit(0)))
    index = materialize(index_rules(rules, subjects.select(F.explode(held).alias("token"))), "rule-index")
    fetched = subjects.select("url", "subject", F.explode(F.array_append(held, F.lit(""))).alias("token"))
    seen = F.when(F.col("listed"), F.col("subject")).otherwise(fold(F.col("subject")))
    candidates = fetched.join(replicate(index), "token").where(F.regexp_like(seen, F.col("regex")))
    return candidates.select("url", "verdict", "pattern", "listed")


def judge(pages: DataFrame, rules: DataFrame | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """The verdict on every row of ``pages``, with its host, path and the rule that decided.

    ``rule`` is the listed rule, ``pattern`` the other rule; at most one is set.
    """
    if rules is None:
        rules = rule_rows(pages.sparkSession)
    rows = pages.select(F.col(key).alias(key), F.col(url).alias("url"))
    rules = materialize(read_rules(rules), "url-rules")
    fits = matches(rows.select("url").where("url IS NOT NULL").distinct(), rules)
    first = F.min_by(
        F.struct("verdict", "pattern", "listed"),
        F.struct(
            (~F.col("listed")).alias("a"),
            (-F.length("pattern")).alias("b"),
            (F.col("verdict") != "block").alias("c"),
            F.col("pattern").alias("d"),
        ),
    )
    decided = materialize(fits.groupBy("url").agg(first.alias("by")), "url-verdicts")
    parts = url_parts(F.col("url"))
    return rows.join(replicate(decided), "url", "left").select(
        key,
        parts["host"].alias("host"),
        parts["path"].alias("path"),
        F.when(F.col("by.listed"), F.col("by.pattern")).alias("rule"),
        F.coalesce("by.verdict", F.lit("allow")).alias("verdict"),
        F.when(~F.col("by.listed"), F.col("by.pattern")).alias("pattern"),
    )


def kept(pages: DataFrame, rules: DataFrame | None = None, url: str = "url") -> DataFrame:
    """The rows of ``pages`` whose url is allowed, with all their columns."""
    judged = judge(pages.select(F.col(url).alias("u")), rules, "u", "u")
    blocked = materialize(judged.where("verdict = 'block'").select(F.col("u").alias("_u")).distinct(), "url-blocked")
    return pages.join(replicate(blocked), pages[url] == F.col("_u"), "left_anti")
