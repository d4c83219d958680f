"""The immigration mart as a whole: source files to CSV tables to checked tables."""

from __future__ import annotations

from dataclasses import MISSING, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession

from martflow.operators.quality import enforce, nonempty_report
from martflow.plans import airports, climate, demographics, immigration
from martflow.schemas import IMMIGRATION_MART
from martflow.sinks.tables import create_table
from martflow.sinks.writers import load_table, write_csv
from martflow.sources.lookups import read_code_name_tail, read_code_names
from martflow.sources.readers import read_any, read_csv
from martflow.sources.staging import stage_csv

# The airport names hold commas of their own.
SEPARATORS = {"airport": ";"}


@dataclass(frozen=True)
class Inputs:
    """Where the sources are. Arrivals may be in any format Spark can load."""

    arrivals: str
    airport_codes: str
    country_codes: str
    mode_codes: str
    visa_codes: str
    temperatures: str
    cities: str
    airports: str
    demographics: str
    arrivals_format: str = "parquet"
    arrivals_options: dict[str, str] = field(default_factory=dict)


INPUT_NAMES = [f.name for f in fields(Inputs) if f.default is MISSING and f.default_factory is MISSING]


def lookups(spark: SparkSession, inputs: Inputs) -> dict[str, DataFrame]:
    return {
        "airports": read_code_name_tail(
            spark, inputs.airport_codes, "airport_code", "airport_name", "state_code"
        ),
        "countries": read_code_names(spark, inputs.country_codes, "country_code", "country"),
        "modes": read_code_names(spark, inputs.mode_codes, "mode_code", "mode"),
        "visas": read_code_names(spark, inputs.visa_codes, "visa_code", "visa"),
    }


def tables(spark: SparkSession, inputs: Inputs, country: str, country_code: str) -> dict[str, DataFrame]:
    """Every table of the mart, not yet computed."""
    source = read_any(spark, inputs.arrivals, inputs.arrivals_format, **inputs.arrivals_options)
    temperatures, cities = read_csv(spark, inputs.temperatures), read_csv(spark, inputs.cities)
    return {
        "i94": immigration.fact(source, lookups(spark, inputs)),
        "date": immigration.dates_of(source),
        "us_states_temperature": climate.by_state(temperatures, cities, country),
        "world_temperature": climate.by_country(temperatures),
        "airport": airports.airports(read_csv(spark, inputs.airports), country_code),
        "demographic": demographics.by_state(read_csv(spark, inputs.demographics, sep=";")),
    }


def build(
    spark: SparkSession,
    inputs: Inputs,
    out: str,
    country: str = climate.HOME_COUNTRY,
    country_code: str = "US",
) -> None:
    """Write every table as CSV below ``out``."""
    for name, df in tables(spark, inputs, country, country_code).items():
        write_csv(df, f"{out}/{name}", sep=SEPARATORS.get(name, ","))


def publish(spark: SparkSession, out: str, database: str, root: str) -> DataFrame:
    """Stage the CSV tables by position into typed tables, and check them.

    The fact comes first and the gate last. Returns the row counts, or raises
    when a table came out empty.
    """
    published = {}
    for name, ddl in IMMIGRATION_MART.items():
        table = f"{database}.{name}"
        create_table(spark, table, ddl, f"{root}/{name}")
        staged = stage_csv(spark, f"{out}/{name}", ddl, sep=SEPARATORS.get(name, ","))
        load_table(staged, table, truncate=True)
        published[name] = spark.table(table)
    return enforce(nonempty_report(published))
