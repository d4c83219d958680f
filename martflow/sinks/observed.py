"""Checks made by the write itself.

A check that follows a load reads again what was just written. Here the rows
are counted as they pass into the table: the metrics are part of the plan of
the write, one set of numbers comes back, and a gate decides afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martflow.sinks.writers import load

REPORT = "table_name string, rule string, value bigint, passed boolean"


class Watch:
    """Rules for one table, judged by the rows that pass on their way into it.

    ``not_null``: columns that may hold no null. ``types``: columns of text
    whose values, where present, must fit a type. ``may_be_empty``: whether no
    row at all is well. Every rule becomes one aggregate of the passing rows,
    which sit right below the write, so a repeated task is counted once.
    """

    def __init__(
        self, name: str, not_null: Sequence[str] = (), types: Mapping[str, str] | None = None, may_be_empty: bool = False
    ):
        self.name, self.may_be_empty = name, may_be_empty
        self.metrics = {"rows": F.count(F.lit(1))}
        for c in not_null:
            self.metrics[f"null {c}"] = F.count_if(F.col(f"`{c}`").isNull())
        for c, kind in (types or {}).items():
            unfit = F.col(f"`{c}`").isNotNull() & F.trim(F.col(f"`{c}`")).try_cast(kind).isNull()
            self.metrics[f"unfit {c}"] = F.count_if(unfit)
        self.observation: Observation | None = None

    def on(self, df: DataFrame) -> DataFrame:
        """The rows, counted as they are written. One watch watches one write."""
        if self.observation is not None:
            raise ValueError(f"{self.name} is watched already")
        self.observation = Observation()
        return df.observe(self.observation, *[metric.alias(rule) for rule, metric in self.metrics.items()])

    def lines(self) -> list[tuple[str, str, int, bool]]:
        """One line per rule; the write must have ended."""
        if self.observation is None:
            raise ValueError(f"{self.name} was not written")
        found = self.observation.get
        lines = []
        for rule in self.metrics:
            value = int(found.get(rule) or 0)
            lines.append((self.name, rule, value, self.may_be_empty or value > 0 if rule == "rows" else value == 0))
        return lines

    @property
    def rows(self) -> int:
        return self.lines()[0][2]


def load_watched(df: DataFrame, path: str, truncate: bool, watch: Watch) -> None:
    """``load``, with the rules of a watch judged on the way."""
    load(watch.on(df), path, truncate)


def watched_report(spark: SparkSession, watches: Sequence[Watch]) -> DataFrame:
    """One line per table and rule, from the writes that were watched; nothing is read."""
    return spark.createDataFrame([line for w in watches for line in w.lines()], REPORT)


def count_difference(spark: SparkSession, source: Watch, target: Watch) -> DataFrame:
    """Rows that went into two tables, one made of the other, and how many fewer the latter has."""
    rows = [(target.name, source.rows, target.rows, source.rows - target.rows)]
    return spark.createDataFrame(rows, "table_name string, source_rows bigint, target_rows bigint, difference bigint")
