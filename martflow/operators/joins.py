"""Joins between facts, dimensions and lookups.

No side is forced to be broadcast. Catalyst and AQE broadcast what they
measure to be below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
sort-merge, with AQE splitting skewed partitions. ``replicate`` adds a hint
behind a check of its own. ``salted_join`` spreads hot keys itself; operators
with a ``join`` argument take it, or a partial of it, in place of the plain
``equi_join``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.text import exact_number
from martflow.operators.aggregates import first_row
from martflow.operators.filters import all_of
from martflow.session import materialize

# (left, right, on, how) -> joined
Join = Callable[[DataFrame, DataFrame, Mapping[str, str], str], DataFrame]


def equi_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join on pairs of columns (left → right); the right keys are dropped."""
    l, r = left.alias("l"), right.alias("r")
    condition = all_of(*[F.col(f"l.`{a}`") == F.col(f"r.`{b}`") for a, b in on.items()])
    return l.join(r, condition, how).select(
        "l.*", *[F.col(f"r.`{c}`") for c in right.columns if c not in on.values()]
    )


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float) -> list[int]:
    """Hashes of the key values that hold more than ``share`` of the rows.

    A frequent-items sketch of fixed size: it misses no such value, may name
    others besides, and returns at most ``1 / share`` of them.
    """
    hashed = df.select(F.xxhash64(*keys).alias("h"))
    return hashed.stat.freqItems(["h"], share).first()[0]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    share: float = 0.01,
    salts: int = 64,
) -> DataFrame:
    """``equi_join`` for two large sides where some keys fill much of the left.

    Left rows of hot keys are dealt over ``salts`` sub-keys by their other
    columns and, as copies agree in those, by their input partition. The right
    rows of those keys alone are repeated to meet them. Null keys count as hot
    when frequent. Results are those of the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = heavy_hitters(left, list(on), share)
    if not hot:
        return equi_join(left, right, on, how)

    left_hot = F.xxhash64(*on).isin(hot)
    # Right rows are compared with the hot values themselves, as the join
    # compares them: keys of unlike types have unlike hashes.
    values = left.filter(left_hot).select(*on).distinct().collect()
    right_hot = F.lit(False)
    for row in values:
        if None not in row:
            same = [
                F.col(f"`{b}`") == F.lit(v).cast(left.schema[a].dataType)
                for (a, b), v in zip(on.items(), row, strict=True)
            ]
            right_hot = right_hot | F.coalesce(all_of(*same), F.lit(False))

    dealt = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    left_salted = left.withColumn("_salt", F.when(left_hot, dealt).otherwise(F.lit(0)))
    copies = F.when(right_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right_salted = right.withColumn("_salt_r", F.explode(copies))
    return equi_join(left_salted, right_salted, {**on, "_salt": "_salt_r"}, how).drop("_salt")


def replicate(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a table for copying to every executor, if it is small enough.

    At most ``max_rows + 1`` rows are looked at. A larger table comes back
    unmarked and is joined by shuffling.
    """
    size = (
        df.limit(max_rows + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
        .first()
    )
    return F.broadcast(df) if size["n"] <= max_rows and size["b"] <= max_bytes else df


def left_join_numeric(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    number: tuple[str, str],
    scale: int = 5,
    join: Join = equi_join,
) -> DataFrame:
    """Left join on text keys and one number, compared as an exact decimal."""
    a, b = number
    left_keyed = left.withColumn("_n", exact_number(F.col(a), scale))
    right_keyed = right.withColumn("_nr", exact_number(F.col(b), scale)).drop(b)
    return join(left_keyed, right_keyed, {**on, "_n": "_nr"}, "left").drop("_n")


def resolve(
    fact: DataFrame,
    catalogue: DataFrame,
    on: Mapping[str, str],
    number: tuple[str, str],
    ids: Sequence[str],
    scale: int = 5,
    join: Join = equi_join,
) -> DataFrame:
    """Add the ids of the one matching catalogue row, or nulls.

    The catalogue is first reduced to one row per key, the smallest ids
    winning, so the fact keeps exactly its rows. The reduced catalogue is
    written before it is joined: its true size then decides whether it is
    broadcast, and if not, AQE can split a hot key of the fact, which it
    cannot while the other side comes straight from an aggregate on that key.
    """
    text_keys = list(on.values())
    numeric = exact_number(F.col(number[1]), scale)
    reduced = (
        catalogue.groupBy(*text_keys, numeric.alias(number[1]))
        .agg(F.min(F.struct(*ids)).alias("_ids"))
        .select(*text_keys, number[1], "_ids.*")
    )
    unique = materialize(reduced, "catalogue")
    return left_join_numeric(fact, unique, on, number, scale, join)


def decode(
    fact: DataFrame,
    lookup: DataFrame,
    code: str,
    lookup_code: str,
    names: Mapping[str, str],
    join: Join = equi_join,
) -> DataFrame:
    """Add the columns a code stands for, under new names (lookup → output).

    Codes without an entry get nulls. The same lookup can be used again for
    another column of the fact in another role.
    """
    chosen = lookup.select(
        F.col(lookup_code).alias("_code"), *[F.col(c).alias(out) for c, out in names.items()]
    )
    return join(fact, chosen, {code: "_code"}, "left")


def enrich(fact: DataFrame, *lookups: tuple[DataFrame, str, str, Mapping[str, str]]) -> DataFrame:
    """``decode`` several codes in turn: (lookup, code, lookup code, names) each."""
    for table, code, lookup_code, names in lookups:
        fact = decode(fact, table, code, lookup_code, names)
    return fact


def mean_by_attribute(
    measures: DataFrame,
    key: str,
    value: Column,
    attributes: DataFrame,
    attribute_key: str,
    attribute: str,
    name: str,
    first: Sequence[str] = (),
    order_by: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Mean of a measure per attribute of its key, e.g. per state of its city.

    Measures are summed per key before the join, so only one row per key is
    shuffled to it. Keys without an entry form the group whose attribute is
    null, or are left out by an inner join. ``first`` adds columns of the
    group's first measure in a stated order.
    """
    aggregates = [F.sum(value).alias("_s"), F.count(value).alias("_n")]
    if first:
        aggregates.append(first_row(first, order_by).alias("_row"))
    per_key = measures.groupBy(key).agg(*aggregates)
    joined = equi_join(per_key, attributes.select(attribute_key, attribute), {key: attribute_key}, how)
    total, n = F.sum("_s"), F.sum("_n")
    means = [F.when(n > 0, total / n).alias(name)]
    if first:
        means.append(F.min("_row").alias("_row"))
    return joined.groupBy(attribute).agg(*means).select(attribute, name, *[f"_row.{c}" for c in first])
