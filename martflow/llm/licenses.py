"""Licence scans by canonical digest, in DataFrame operations only.

A text is normalised - case, copyright lines, equivalent spellings, then all
punctuation and white space - and digested whole. For the lookup it is folded
further: titles and copyright lines in any form at its head, copyright lines
with a sign and a year or a placeholder anywhere, names of holders, list marks
and the FSF's addresses; the digest of that is joined to those of the known
licences, whole texts in ``known_licenses`` and the notices below. Texts that
differ only in such things are the same licence. Only texts that hold a stem
that no known licence is without (``STEMS``) are folded; others are none.

Defined results: null text counts as empty, and empty text is no licence. Null
and repeated ids are carried as they are. Two known texts with one digest: the
smaller name. Other columns are not read.
"""

from __future__ import annotations

import string
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import by_ids
from martflow.session import materialize

COPYRIGHT = r"(^|\n)[^a-z\n]*copyright[ \t]+(\(c\)|©|[0-9]{4})[^\n]*"
# Spellings taken as equal, applied in this order.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("organisation", "organization"),
    ("non-commercial", "noncommercial"),
    ("https", "http"),
    ("&", " and "),
)
# Lines dropped from the head, one after another, as long as one fits.
HEAD = (
    r"\G[^\p{L}\p{N}(©]*+(?:\(?copyright\b(?! (?:notice|law|holder|owner))|\(c\)|©|copy;|copr\.|portions copyright|all rights reserved"
    r"|spdx-license-identifier|https?://|51 franklin|59 temple|675 mass"
    r"|(?:version [0-9][^\n]{0,30}|\(?licen[sc]e|creative commons legal code|cc0 1\.0 universal|\(?(?:the )?unlicense"
    r"|\(?(?:(?:the|new|modified|revised|simplified|[0-9]-clause|zero-clause) )*+\"?(?:mit|expat|isc|0?bsd|apache"
    r"|gnu (?:[a-z]+ ){0,2}(?:public|documentation)|mozilla public|artistic)\b[^\n]{0,40}\blicen[sc]e\b[^\n]{0,40})(?=[^\p{L}\p{N}\n]*+(?:\n|$)))"
    r"[^\n]*+(?:\n|$)"
)
SIGNED = r"(^|\n)[^\p{L}\p{N}\n(©]*+(?:(?:\(c\)|©)[ \t]*(?:copyright[ \t]*)?[0-9]{4}|copyright[ \t]+[\[{<])[^\n]*"
# Of canonical text: what differs from one owner or printing to another.
SLOTS = (
    (r"(neither the names?) .{1,120}? (nor the names? of) (?:its|their|any|the) ", "$1 $2 "),
    (r"(this software is provided by) .{1,120}? (as is)", "$1 $2"),
    (r"(in no event shall) .{1,120}? (be liable)", "$1 $2"),
    (r"(?: [0-9])? (redistributions of source|redistributions in binary|neither the name)", " $1"),
    (r" (?:675 mass ave cambridge ma 02139|59 temple place suite 330 boston ma 02111 1307|51 franklin st(?:reet)? fifth floor boston ma 02110 1301)(?: usa)?", ""),
)
# Letters in a row, one of which stands in every known text however it is spelt.
STEMS = ("licen", "warrant")
END_OF_TERMS = "END OF TERMS AND CONDITIONS"  # what follows tells how to apply a licence
# Texts of public licences and notices.
KNOWN = {
    **{p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "known_licenses").glob("*.txt"))},
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
}


def canonical(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    plain = F.regexp_replace(folded, COPYRIGHT, "$1")
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(usual))
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def folded(text: Column) -> Column:
    """The canonical text without what differs between copies of one licence."""
    plain = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase + "\r", string.ascii_lowercase + "\n")
    plain = canonical(F.regexp_replace(F.regexp_replace(plain, HEAD, ""), SIGNED, "$1"))
    for slot, kept in SLOTS:
        plain = F.regexp_replace(plain, slot, kept)
    return F.trim(plain)


def bodies(texts: dict[str, str] = KNOWN) -> list[tuple[str, str]]:
    """(name, text) of each licence, and of each without what follows its terms."""
    whole = sorted(texts.items())
    return whole + [(name, body[: body.index(END_OF_TERMS) + len(END_OF_TERMS)]) for name, body in whole if END_OF_TERMS in body]


def known_digests(spark: SparkSession, texts: dict[str, str] = KNOWN) -> DataFrame:
    """(``digest`` of the folded text, ``license``), one row per digest. Written."""
    rows = spark.createDataFrame(bodies(texts), "license string, body string")
    digests = rows.select(F.sha2(folded(F.col("body")), 256).alias("digest"), "license")
    return materialize(digests.groupBy("digest").agg(F.min("license").alias("license")), "licenses")


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", stems: tuple[str, ...] = STEMS) -> DataFrame:
    """Per row: ``key``, ``digest`` of the canonical text, ``folded_digest``, by
    which a licence is looked up, null without a stem, and ``license`` or null.
    Every text of ``known`` must hold one of ``stems``; without any, all is folded."""
    low = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    may_be_known = reduce(Column.__or__, [F.contains(low, F.lit(stem)) for stem in stems], F.lit(not stems))
    rows = docs.select(
        F.col(key),
        F.sha2(canonical(F.col(text)), 256).alias("digest"),
        F.when(may_be_known, F.sha2(folded(F.col(text)), 256)).alias("folded_digest"),
    )
    found = by_ids(rows, known.withColumnRenamed("digest", "folded_digest"), "folded_digest", "left")
    return found.select(key, "digest", "folded_digest", "license")
