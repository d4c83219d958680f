"""Buckets of nearly equal numbers of rows, in the order of a column."""

from __future__ import annotations

import os.path
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Equal parts of a column's range that buckets are put together from.
CELLS = 4096

# Bytes of a text that tell its place among others, after what all have in common.
TEXT_BYTES = 6

# What infinities and NaN count as.
MOST = 1e300

Buckets = Callable[[Column], Column]


def ordered_number(value: Column, kind: DataType, common: str = "") -> Column:
    """A number that never falls as the value grows, whatever the session's zone.

    Texts that all begin with ``common`` are told apart by the bytes after it.
    """
    if isinstance(kind, StringType):
        after = F.substring(F.encode(value, "UTF-8"), len(common.encode()) + 1, TEXT_BYTES)
        return F.conv(F.rpad(F.hex(after), TEXT_BYTES * 2, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, TimestampNTZType):
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        return F.unix_date(value.cast("date")) * F.lit(86_400.0) + clock
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        finite = F.least(F.nanvl(value, F.lit(MOST)).cast("double"), F.lit(MOST))
        return F.greatest(finite, F.lit(-MOST))
    return (F.unix_micros(value) if isinstance(kind, TimestampType) else value).cast("double")


def _common(low: str, high: str) -> str:
    """What all texts between two begin with."""
    return os.path.commonprefix([low, high])


def even_buckets(rows: DataFrame, wanted: Mapping[str, int]) -> dict[str, Buckets]:
    """For each column a function from its values to bucket numbers from 0, of which there are ``wanted``.

    Two aggregates decide for all columns at once: their ranges, and the rows
    of each of ``CELLS`` equal parts, which are put together to buckets. Values beyond the range fall into the outermost
    buckets, equal values into one. Null has no bucket.
    """
    kinds = {c: rows.schema[c].dataType for c in wanted}
    ends = [f(F.col(f"`{c}`")).alias(f"{n}_{c}") for c in wanted for n, f in (("low", F.min), ("high", F.max))]
    # The numbers of the ends are the ends of the numbers, as these never fall; those of texts need both ends first.
    spans = [
        ordered_number(f(F.col(f"`{c}`")), kinds[c]).alias(f"{n}_number_{c}")
        for c in wanted
        for n, f in (("low", F.min), ("high", F.max))
        if not isinstance(kinds[c], StringType)
    ]
    row = rows.agg(*ends, *spans, *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in wanted]).first()
    common = {
        c: _common(row[f"low_{c}"], row[f"high_{c}"]) if row[f"n_{c}"] and isinstance(kinds[c], StringType) else ""
        for c in wanted
    }
    used = [c for c, n in wanted.items() if n > 1 and row[f"n_{c}"] and row[f"low_{c}"] != row[f"high_{c}"]]
    if not used:
        return {c: lambda value: F.when(value.isNotNull(), 0) for c in wanted}

    def number(c: str) -> Callable[[Column], Column]:
        return lambda value: ordered_number(value, kinds[c], common[c])

    texts = [number(c)(F.lit(row[f"{n}_{c}"])).alias(f"{n}_{c}") for c in used if isinstance(kinds[c], StringType) for n in ("low", "high")]
    of_texts = rows.sparkSession.range(1).select(*texts).first() if texts else None

    def span(c: str, end: str) -> float:
        return of_texts[f"{end}_{c}"] if isinstance(kinds[c], StringType) else row[f"{end}_number_{c}"]

    def cell(c: str, value: Column) -> Column:
        low, high = span(c, "low"), span(c, "high")
        if low == high:
            return F.lit(0)
        share = F.floor((number(c)(value) - F.lit(low)) / F.lit(high - low) * CELLS)
        return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), share)).cast("int")

    each = [F.struct(F.lit(i).alias("i"), cell(c, F.col(f"`{c}`")).alias("cell")) for i, c in enumerate(used)]
    present = [F.when(F.col(f"`{c}`").isNotNull(), s) for c, s in zip(used, each)]
    if len(used) == 1:
        placed = rows.where(F.col(f"`{used[0]}`").isNotNull()).select(each[0].alias("at"))
    else:
        placed = rows.select(F.explode(F.array_compact(F.array(*present))).alias("at"))
    counted = placed.groupBy("at").count().collect()
    sizes = {(r["at"]["i"], r["at"]["cell"]): r["count"] for r in counted}

    found: dict[str, Buckets] = {c: lambda value: F.when(value.isNotNull(), 0) for c in wanted}
    for i, c in enumerate(used):
        bucket_of, before = [], 0
        for j in range(CELLS):
            bucket_of.append(min(wanted[c] - 1, before * wanted[c] // row[f"n_{c}"]))
            before += sizes.get((i, j), 0)

        def bucket(value: Column, c: str = c, bucket_of: str = str(bucket_of)) -> Column:
            # As text the list is one node of the plan; the optimizer turns it into a literal array.
            return F.when(value.isNotNull(), F.element_at(F.from_json(F.lit(bucket_of), "array<int>"), cell(c, value) + 1))

        held = [0] * wanted[c]
        for j, b in enumerate(bucket_of):
            held[b] += sizes.get((i, j), 0)
        bucket.even = max(held) * wanted[c] <= 2 * row[f"n_{c}"]
        found[c] = bucket
    return found


def even(bucket: Buckets) -> bool:
    """Whether there are several buckets and none holds more than twice its share of the rows they were made from."""
    return getattr(bucket, "even", False)
