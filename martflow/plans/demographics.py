"""Population by state, from lines per city and race."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martflow.operators.aggregates import mixed_measures, pivot_first
from martflow.operators.columns import change_columns
from martflow.schemas import CITY_COLUMNS, IMMIGRATION_MART, RACES, STATE_MEANS, STATE_SUMS
from martflow.sinks.tables import schema_of


def by_city(source: DataFrame) -> DataFrame:
    """One row per city, with a column for each race."""
    counted = change_columns(source, ["Count"], lambda c: c.try_cast("double"))
    return pivot_first(counted, CITY_COLUMNS, "Race", "Count", RACES)


def by_state(source: DataFrame) -> DataFrame:
    """Cities rolled up to states. Median age is the plain mean over cities."""
    races = {c: c for c in RACES.values()}
    rolled = mixed_measures(by_city(source), ["State", "State Code"], STATE_MEANS, {**STATE_SUMS, **races})
    named = rolled.withColumnsRenamed({"State": "state", "State Code": "state_code"})
    return named.select(*schema_of(IMMIGRATION_MART["demographic"]).names)
