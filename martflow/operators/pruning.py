"""Reading of a large table only what a small delivery can meet.

A keyed load compares a delivery with a table that may be thousands of times
its size. Two filters derived from the delivery keep the rest of the table
out of the shuffle; neither ever removes a row whose key the delivery has.

*Ranges*: least and greatest values of each key, and of the leading one in a
few separate pieces, become literals of the scan, where they prune partitions,
files and row groups.

*Bits*: a blocked Bloom filter of the delivery's keys, four bits in one 64-bit
word per key. Its size is fixed by the number of keys and bounded by
``MAX_WORDS``; it is built by one aggregate and tested by a broadcast join
inside the scan's stage. A delivery with more keys than it can tell apart goes
without.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Words of the Bloom filter: at most 2^18 rows of a word's number and its bits, 4 MB.
MAX_WORDS = 1 << 18
KEYS_PER_WORD = 4

# Pieces the leading key's range is cut into, so that gaps between them are not read.
PIECES = 16

# Bytes of a table's keys from which filters are worth the passes over the delivery they take.
PRUNE_FROM = 64 << 20

# Longest text that is put into a plan.
MAX_LITERAL = 1000


def estimated_bytes(df: DataFrame) -> int:
    """What Catalyst, from file sizes and the columns used, takes a frame's size to be."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _ordered(kind: DataType) -> bool:
    """Whether a scan's statistics order values of this type as comparisons do."""
    if isinstance(kind, StringType):
        return kind == StringType()
    return isinstance(kind, (IntegralType, DecimalType, DateType, TimestampType, TimestampNTZType))


def _within(name: str, kind: DataType, low, high) -> Column:
    column = F.col(f"`{name}`")
    return (column >= F.lit(low).cast(kind)) & (column <= F.lit(high).cast(kind))


def _pieces(delivery: DataFrame, name: str, low, high) -> list[tuple]:
    """Least and greatest values of the parts of a key's range that hold any."""
    kind = delivery.schema[name].dataType
    if isinstance(kind, (StringType, DecimalType)) or low == high:
        return [(low, high)]

    def number(value: Column) -> Column:
        if isinstance(kind, DateType):
            return F.unix_date(value).cast("double")
        # Any grouping of the values is right, so the session's zone does no harm.
        return (value.cast("timestamp") if isinstance(kind, TimestampNTZType) else value).cast("double")

    start, end = number(F.lit(low).cast(kind)), number(F.lit(high).cast(kind))
    share = (number(F.col(f"`{name}`")) - start) / (end - start)
    piece = F.least(F.floor(share * PIECES), F.lit(PIECES - 1))
    found = delivery.where(F.col(f"`{name}`").isNotNull()).groupBy(piece.alias("piece"))
    return [(r.low, r.high) for r in found.agg(F.min(name).alias("low"), F.max(name).alias("high")).collect()]


def key_ranges(delivery: DataFrame, keys: Sequence[str]) -> tuple[Column, int]:
    """A filter on literals that every row with one of the delivery's keys passes,
    and the number of the delivery's rows.

    The first of ``keys`` is the leading one. A null key passes where the
    delivery has one too. Keys of types that scans do not order are not used.
    """
    used = [k for k in keys if _ordered(delivery.schema[k].dataType)]
    spans = [f(F.col(f"`{k}`")).alias(f"{k}_{n}") for k in used for n, f in (("low", F.min), ("high", F.max))]
    nulls = [F.coalesce(F.bool_or(F.col(f"`{k}`").isNull()), F.lit(False)).alias(f"{k}_null") for k in used]
    row = delivery.agg(F.count(F.lit(1)).alias("_n"), *spans, *nulls).first()
    if not row["_n"]:
        return F.lit(False), 0
    passed = F.lit(True)
    for i, key in enumerate(used):
        kind, low, high = delivery.schema[key].dataType, row[f"{key}_low"], row[f"{key}_high"]
        ways = [F.col(f"`{key}`").isNull()] if row[f"{key}_null"] else []
        if low is not None:
            if isinstance(low, str) and max(len(low), len(high)) > MAX_LITERAL:
                continue
            pieces = _pieces(delivery, key, low, high) if i == 0 else [(low, high)]
            ways += [_within(key, kind, *piece) for piece in pieces]
        passed = passed & reduce(or_, ways)
    return passed, row["_n"]


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _mask(hashed: str) -> Column:
    """Four bits of a word, from the upper bits of a key's hash."""
    bits = [f"shiftleft(1L, CAST(shiftrightunsigned({hashed}, {at}) & 63 AS INT))" for at in (40, 46, 52, 58)]
    return F.expr(" | ".join(bits))


def key_bits(delivery: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """The Bloom filter: at most ``words`` rows (a power of two) of ``_word`` and ``_bits``."""
    hashed = delivery.select(_hash(keys).alias("_hash"))
    return hashed.groupBy(F.expr(f"_hash & {words - 1}L").alias("_word")).agg(F.bit_or(_mask("_hash")).alias("_bits"))


def _marked(target: DataFrame, delivery: DataFrame, keys: Sequence[str], how: str) -> tuple[DataFrame, Column]:
    """The target, with what the filters need, and whether a row passes them."""
    alike = [k for k in keys if target.schema[k].dataType == delivery.schema[k].dataType]
    if not alike:
        return target, F.lit(True)
    wanted = delivery.select(*[F.col(f"`{k}`") for k in alike])
    passed, count = key_ranges(wanted, alike)
    if not count or count > MAX_WORDS * KEYS_PER_WORD * 2:
        return target, passed
    words = 1 << 6
    while words < MAX_WORDS and words * KEYS_PER_WORD < count:
        words *= 2
    bits = F.broadcast(key_bits(wanted, alike, words))
    near = target.where(passed) if how == "inner" else target
    hashed = near.withColumn("_hash", _hash(alike)).withColumn("_word", F.expr(f"_hash & {words - 1}L"))
    return hashed.join(bits, "_word", how), passed & (F.col("_bits").bitwiseAND(_mask("_hash")) == _mask("_hash"))


def held_rows(target: DataFrame, delivery: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``target`` whose key may be in ``delivery``, and few others.

    No row whose key the delivery has is lost, null keys included. The
    delivery, a written table, is read a few times. The target is not
    shuffled. Keys whose types differ between the two are not used.
    """
    marked, passed = _marked(target, delivery, keys, "inner")
    return marked.where(passed).select(*[F.col(f"`{c}`") for c in target.columns])


def split_rows(target: DataFrame, delivery: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``held_rows`` and all other rows of ``target``, neither of them shuffled."""
    marked, passed = _marked(target, delivery, keys, "left")
    columns = [F.col(f"`{c}`") for c in target.columns]
    held = F.coalesce(passed, F.lit(False))
    return marked.where(held).select(*columns), marked.where(~held).select(*columns)
