"""Immigration fact and its date dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.timeparts import calendar_parts, sas_date
from martflow.operators.columns import cast_to_int, change_columns
from martflow.operators.combine import distinct_values
from martflow.operators.joins import enrich
from martflow.schemas import ARRIVAL_COLUMNS, ARRIVAL_DATES, ARRIVAL_INTS, DATE_PARTS


def arrivals(source: DataFrame) -> DataFrame:
    """The useful columns: integers, dates, and no row twice."""
    chosen = cast_to_int(source.select(*ARRIVAL_COLUMNS), ARRIVAL_INTS)
    return change_columns(chosen, ARRIVAL_DATES, sas_date).distinct()


def fact(
    source: DataFrame, lookups: Mapping[str, DataFrame], born_key: str = "i94cit"
) -> DataFrame:
    """Arrivals with the names behind their five codes.

    ``lookups`` holds ``airports``, ``countries``, ``modes`` and ``visas``.
    Countries are looked up twice, as country of birth (by ``born_key``) and
    of residence. Duplicates are removed before the names are added: rows and
    lookup entries being distinct, so is what they join to, and the shuffle
    carries the source columns only.
    """
    airports = lookups["airports"].withColumn("state_code", F.trim("state_code")).distinct()
    countries, modes, visas = (lookups[k].distinct() for k in ("countries", "modes", "visas"))
    return enrich(
        arrivals(source),
        (airports, "i94port", "airport_code", {"airport_name": "airport_name", "state_code": "state_code"}),
        (countries, born_key, "country_code", {"country": "born_country"}),
        (countries, "i94res", "country_code", {"country": "residence_country"}),
        (modes, "i94mode", "mode_code", {"mode": "mode"}),
        (visas, "i94visa", "visa_code", {"visa": "visa"}),
    )


def dates(fact: DataFrame) -> DataFrame:
    """Every date of arrival or departure, with its calendar parts."""
    days = distinct_values(fact, ARRIVAL_DATES, "date")
    return days.withColumns(calendar_parts(F.col("date"))).select("date", *DATE_PARTS)


def dates_of(source: DataFrame) -> DataFrame:
    """The date dimension straight from the source, reading its two date columns only."""
    numbers = cast_to_int(source.select(*ARRIVAL_DATES), ARRIVAL_DATES)
    return dates(change_columns(numbers, ARRIVAL_DATES, sas_date))
