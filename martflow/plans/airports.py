"""Airport dimension of one country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.text import commas_to_spaces, element
from martflow.operators.columns import change_columns
from martflow.operators.filters import of_kind, present
from martflow.schemas import AIRPORT_COLUMNS


def airports(source: DataFrame, country: str = "US") -> DataFrame:
    """Airports with an IATA code; the state is cut out of the region code."""
    kept = of_kind(present(source.select(*AIRPORT_COLUMNS), "iata_code"), "iso_country", country)
    stated = kept.withColumn("state", element(F.col("iso_region"), "-", 1)).drop("iso_region")
    return change_columns(stated, stated.columns, commas_to_spaces)
