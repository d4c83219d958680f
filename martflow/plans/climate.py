"""Mean temperatures by state and by country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.timeparts import parse_date
from martflow.operators.aggregates import first_per_group, group_mean, mean_and_first
from martflow.operators.columns import select_as
from martflow.operators.filters import after, of_kind, present
from martflow.operators.joins import equi_join, mean_by_attribute

# The country whose states are reported, the day readings start after.
HOME_COUNTRY = "United States"
SINCE = "2000-01-01"


def readings(temperatures: DataFrame, since: str | None = SINCE) -> DataFrame:
    """Readings that have a value, dated strictly after ``since``."""
    dated = temperatures.withColumn("date", parse_date(F.col("dt")))
    valued = present(dated, "AverageTemperature")
    return after(valued, "date", since) if since else valued


def city_states(cities: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """One state per city name: of several, the first in the alphabet."""
    home = select_as(of_kind(cities, "country", country), {"city": "city", "admin_name": "state"})
    return first_per_group(home, ["city"], ["state"], ["state"])


def by_state(temperatures: DataFrame, cities: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """Mean per state; cities of no known state form the null group."""
    home = of_kind(readings(temperatures), "Country", country)
    value = F.col("AverageTemperature").try_cast("double")
    return mean_by_attribute(
        home, "City", value, city_states(cities, country), "city", "state", "average_temperature"
    )


def by_country(temperatures: DataFrame, since: str | None = SINCE) -> DataFrame:
    mean = group_mean(readings(temperatures, since), ["Country"], "AverageTemperature", "average_temperature")
    return mean.withColumnRenamed("Country", "country")


def by_country_position(temperatures: DataFrame, since: str | None = None) -> DataFrame:
    """Mean per country over all its readings, with the position of the first."""
    means = mean_and_first(
        readings(temperatures, since), ["Country"], "AverageTemperature", "average_temperature",
        ["Latitude", "Longitude"], ["date", "City"],
    )
    return means.withColumnRenamed("Country", "country")


def by_state_code(
    temperatures: DataFrame, cities: DataFrame, abbreviations: DataFrame, country: str = HOME_COUNTRY
) -> DataFrame:
    """Mean and position per state, under the state's two-letter code.

    Only cities with a known state and states with a code take part. The
    position is that of the state's first reading by date and city.
    """
    home = of_kind(readings(temperatures), "Country", country)
    value = F.col("AverageTemperature").try_cast("double")
    per_state = mean_by_attribute(
        home, "City", value, city_states(cities, country), "city", "state", "average_temperature",
        first=["Latitude", "Longitude"], order_by=["date", "City"], how="inner",
    )
    coded = equi_join(per_state, abbreviations, {"state": "State"})
    return coded.select(F.col("Code").alias("state"), "average_temperature", "Latitude", "Longitude")
