"""Text cleaning and tolerant casts. All map-only expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th piece (from 0) of ``text``; null when there is none.

    ``separator`` is taken literally.
    """
    return F.get(F.split(text, rf"\Q{separator}\E"), F.lit(index))


def commas_to_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(" "))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def joined_text(*values: Column) -> Column:
    """Values as text, one after the other; null if any is null."""
    return F.concat(*[v.cast("string") for v in values])


def to_int(value: Column) -> Column:
    """Integer, truncating fractions; null for text that is no number."""
    return value.try_cast("double").try_cast("int")


def exact_number(value: Column, scale: int = 5) -> Column:
    """A number as ``decimal(18, scale)``, safe to compare for equality.

    Scale 0 reproduces warehouse columns declared ``numeric(18,0)``, which
    round to whole numbers.
    """
    return value.try_cast(f"decimal(18,{scale})")
