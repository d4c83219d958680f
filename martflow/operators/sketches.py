"""Profiles that add up: sketches per day, merged for any span of days.

An exact profile reads and shuffles all values each time it is asked for. A
sketch of a day's values has a bounded size, is made when the day is loaded,
and is merged with those of other days to give what one pass over all of them
would: quantiles by KLL sketches, distinct values by HyperLogLog sketches,
and counts, nulls, extremes and sums as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items a KLL sketch keeps at its top level; the rank of a quantile it tells is
# off by no more than RANK_ERROR of the rows, with 99 % confidence.
KLL_SIZE = 400
RANK_ERROR = 0.0068

# Binary logarithm of the registers of an HLL sketch; three standard errors.
HLL_SIZE = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_SIZE / 2)

PARTS = ["column_name", "rows", "nulls", "low", "high", "total", "quantiles", "distinct"]


def _numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per value: its column and the value as a double; NaN counts as missing."""
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.nanvl(v, F.lit(None)).alias("value")) for c, v in zip(columns, values)]
    return df.select(*by, F.inline(F.array(*pairs)))


def sketch_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row of sketches per column and group, e.g. per day. Combined before
    the shuffle, so a group of any size sends one row per task."""
    value = F.col("value")
    return _numbers(df, columns, by).groupBy(*by, "column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(value.isNull()).alias("nulls"), F.min(value).alias("low"),
        F.max(value).alias("high"), F.sum(value).alias("total"), F.kll_sketch_agg_double(value, KLL_SIZE).alias("quantiles"),
        F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), HLL_SIZE).alias("distinct"),
    )


def merge_profiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger groups from those of smaller ones."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def quantile(sketch: Column, fraction: float) -> Column:
    """A value whose rank is within ``RANK_ERROR`` of the fraction."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(fraction)))


def read_profile(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile that sketches tell: counts, mean, extremes, about the quartiles and the distinct values."""
    present = F.col("rows") - F.col("nulls")
    quartiles = {
        f"p{round(100 * f)}": F.when(present > 0, quantile(F.when(present > 0, F.col("quantiles")), f)) for f in (0.25, 0.5, 0.75)
    }
    return sketches.select(
        *by, "column_name", present.alias("count"), "nulls", F.when(present > 0, F.col("total") / present).alias("mean"),
        F.col("low").alias("min"), *[q.alias(name) for name, q in quartiles.items()], F.col("high").alias("max"),
        F.when(present > 0, F.hll_sketch_estimate("distinct")).otherwise(0).alias("distinct"),
    )


def rank_errors(df: DataFrame, columns: Sequence[str], profile: DataFrame) -> DataFrame:
    """How far the ranks of a profile's quartiles are from what they should be, as shares of the values.

    The exact check of a profile over all of ``df``: its quartiles, a few
    numbers per column, are brought to the values by a broadcast.
    """
    fractions = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    values = _numbers(df, columns, ()).where("value IS NOT NULL")
    ranked = values.join(F.broadcast(profile.select("column_name", *fractions)), "column_name")
    shares = [f(F.col("value"), F.col(p)).alias(f"{p}_{n}") for p in fractions for n, f in (("below", _below), ("upto", _upto))]
    counted = ranked.groupBy("column_name").agg(*shares)
    off = {p: F.greatest(F.lit(0.0), F.col(f"{p}_below") - f, f - F.col(f"{p}_upto")) for p, f in fractions.items()}
    return counted.select("column_name", *[o.alias(f"{p}_error") for p, o in off.items()])


def _below(value: Column, mark: Column) -> Column:
    return F.avg((value < mark).cast("double"))


def _upto(value: Column, mark: Column) -> Column:
    return F.avg((value <= mark).cast("double"))
