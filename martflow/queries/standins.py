"""Mart inputs derived from the test tables, as DataFrames and as SQL.

Song catalogue: ``part``, one song per part, under a title of its own.
Activity log: ``lineitem`` with its part as the song and its supplier as the
listener; some lines name no song and some a song the catalogue lacks.
Arrivals: ``orders`` with codes, some without an entry in their lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.timeparts import from_epoch_ms, to_epoch_ms
from martflow.queries.registry import table
from martflow.schemas import RACES

SONGS_SQL = """
songs AS (
  SELECT 1 AS num_songs,
         'A' || substr(p_brand, 7) AS artist_id,
         CASE WHEN p_type <> 'ECONOMY' THEN CAST(length(p_type) AS DOUBLE) END AS artist_latitude,
         CASE WHEN p_type <> 'ECONOMY' THEN CAST(-length(p_type) AS DOUBLE) END AS artist_longitude,
         p_type AS artist_location,
         p_brand AS artist_name,
         'S' || p_partkey AS song_id,
         p_name || ' ' || p_partkey AS title,
         p_retailprice AS duration,
         CASE WHEN p_size < 10 THEN 0 ELSE 1960 + p_size END AS "year"
  FROM part
)"""


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    located = F.col("p_type") != "ECONOMY"
    width = F.length("p_type").cast("double")
    return part.select(
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("A"), F.substring("p_brand", 7, 100)).alias("artist_id"),
        F.when(located, width).alias("artist_latitude"),
        F.when(located, -width).alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.lit("S"), F.col("p_partkey")).alias("song_id"),
        F.concat_ws(" ", "p_name", "p_partkey").alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.when(F.col("p_size") < 10, 0).otherwise(F.col("p_size") + 1960).alias("year"),
    )


LOG_SQL = """
log AS (
  SELECT CASE WHEN l_quantity > 1 THEN p_brand END AS artist,
         'Logged In' AS auth,
         split_part(s_name, '#', 1) AS firstName,
         CASE WHEN s_nationkey < 12 THEN 'F' ELSE 'M' END AS gender,
         l_linenumber AS itemInSession,
         split_part(s_name, '#', 2) AS lastName,
         CASE WHEN l_quantity > 1 THEN p_retailprice END AS length,
         CASE WHEN l_linestatus = 'F' THEN 'free' ELSE 'paid' END AS level,
         'Nation ' || s_nationkey AS location,
         'PUT' AS method,
         CASE l_returnflag WHEN 'N' THEN 'NextSong' WHEN 'A' THEN 'Home' ELSE 'Help' END AS page,
         s_acctbal AS registration,
         CAST(l_orderkey AS INTEGER) AS sessionId,
         CASE WHEN l_quantity > 1 AND l_discount = 0 THEN upper(p_name) || ' ' || p_partkey
              WHEN l_quantity > 1 THEN p_name || ' ' || p_partkey END AS song,
         200 AS status,
         epoch_ms(l_shipdate) + CAST(round(l_extendedprice * 100) AS BIGINT) AS ts,
         'agent/' || l_linenumber AS userAgent,
         CAST(l_suppkey AS VARCHAR) AS userId
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log as it is on disk: ts in epoch milliseconds."""
    lineitem = table(spark, sf_dir, "lineitem")
    # What a song or listener is called is made once for each, not for every line.
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_retailprice",
        F.concat_ws(" ", "p_name", "p_partkey").alias("title"),
        F.concat_ws(" ", F.upper("p_name"), "p_partkey").alias("unknown"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_acctbal",
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(F.col("s_nationkey") < 12, "F").otherwise("M").alias("sex"),
        F.concat(F.lit("Nation "), F.col("s_nationkey")).alias("place"),
    )
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    heard = F.col("l_quantity") > 1
    return joined.select(
        F.when(heard, F.col("p_brand")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("first_name").alias("firstName"),
        F.col("sex").alias("gender"),
        F.col("l_linenumber").alias("itemInSession"),
        F.col("last_name").alias("lastName"),
        F.when(heard, F.col("p_retailprice")).alias("length"),
        F.when(F.col("l_linestatus") == "F", "free").otherwise("paid").alias("level"),
        F.col("place").alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("l_returnflag") == "N", "NextSong")
        .when(F.col("l_returnflag") == "A", "Home")
        .otherwise("Help")
        .alias("page"),
        F.col("s_acctbal").alias("registration"),
        F.col("l_orderkey").cast("int").alias("sessionId"),
        F.when(heard, F.when(F.col("l_discount") == 0, F.col("unknown")).otherwise(F.col("title"))).alias("song"),
        F.lit(200).alias("status"),
        (to_epoch_ms(F.col("l_shipdate")) + F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("ts"),
        F.concat(F.lit("agent/"), F.col("l_linenumber")).alias("userAgent"),
        F.col("l_suppkey").cast("string").alias("userId"),
    )


def staged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with ts as a timestamp."""
    return log(spark, sf_dir).withColumn("ts", from_epoch_ms(F.col("ts")))


STAGED_LOG_SQL = LOG_SQL + """,
staged AS (SELECT * REPLACE (make_timestamp(ts * 1000) AS ts) FROM log)"""

ARRIVALS_SQL = """
arrivals AS (
  SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
         CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
         CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
         CAST(day(o_orderdate) AS DOUBLE) AS i94cit,
         CAST(month(o_orderdate) * 2 AS DOUBLE) AS i94res,
         'N' || day(o_orderdate) AS i94port,
         CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
         CAST(dayofweek(o_orderdate) AS DOUBLE) AS i94mode,
         CASE WHEN o_orderstatus <> 'P'
              THEN CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) + 10 AS DOUBLE)
         END AS depdate,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS i94visa,
         CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS gender,
         o_orderpriority AS airline
  FROM orders
),
airports AS (SELECT 'N' || n_nationkey AS airport_code, n_name AS airport_name,
                    ' R' || n_regionkey || '  ' AS state_code FROM nation),
countries AS (SELECT n_nationkey AS country_code, n_name AS country FROM nation),
modes AS (SELECT r_regionkey AS mode_code, r_name AS mode FROM region),
visas AS (SELECT r_regionkey + 2 AS visa_code, lower(r_name) AS visa FROM region)"""


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date"))
    return orders.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.dayofmonth("o_orderdate").cast("double").alias("i94cit"),
        (F.month("o_orderdate") * 2).cast("double").alias("i94res"),
        F.concat(F.lit("N"), F.dayofmonth("o_orderdate")).alias("i94port"),
        day.cast("double").alias("arrdate"),
        (F.dayofweek("o_orderdate") - 1).cast("double").alias("i94mode"),
        F.when(F.col("o_orderstatus") != "P", (day + 10).cast("double")).alias("depdate"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("i94visa"),
        F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "O", "M").alias("gender"),
        F.col("o_orderpriority").alias("airline"),
    )


def arrival_lookups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return {
        "airports": nation.select(
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("airport_code"),
            F.col("n_name").alias("airport_name"),
            F.concat(F.lit(" R"), F.col("n_regionkey"), F.lit("  ")).alias("state_code"),
        ),
        "countries": nation.select(
            F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("country")
        ),
        "modes": region.select(F.col("r_regionkey").alias("mode_code"), F.col("r_name").alias("mode")),
        "visas": region.select(
            (F.col("r_regionkey") + 2).alias("visa_code"), F.lower("r_name").alias("visa")
        ),
    }


CLIMATE_SQL = """
readings AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS VARCHAR) END AS AverageTemperature,
         c_mktsegment || ' ' || c_nationkey AS City,
         CASE WHEN c_nationkey < 22 THEN 'Home' ELSE 'Away' END AS Country,
         c_nationkey || 'N' AS Latitude,
         length(c_mktsegment) || 'W' AS Longitude
  FROM orders JOIN customer ON o_custkey = c_custkey
),
cities AS (
  SELECT CASE WHEN c_nationkey < 22 THEN 'Home' ELSE 'Away' END AS country,
         c_mktsegment || ' ' || c_nationkey AS city,
         c_mktsegment AS admin_name
  FROM customer WHERE c_nationkey < 18
),
abbreviations AS (SELECT DISTINCT c_mktsegment AS State, substr(c_mktsegment, 1, 2) AS Code FROM customer),
kept AS (
  SELECT *, CAST(AverageTemperature AS DOUBLE) AS v, CAST(dt AS DATE) AS date
  FROM readings WHERE AverageTemperature IS NOT NULL AND CAST(dt AS DATE) > DATE '2000-01-01'
),
city_state AS (
  SELECT city, min(admin_name) AS state FROM cities WHERE country = 'Home' GROUP BY city
)"""


def climate(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Temperature readings from orders, cities and state codes from customers."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    city = F.concat_ws(" ", "c_mktsegment", "c_nationkey")
    country = F.when(nation < 22, "Home").otherwise("Away")
    readings = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("AverageTemperature"),
        city.alias("City"),
        country.alias("Country"),
        F.concat(nation, F.lit("N")).alias("Latitude"),
        F.concat(F.length("c_mktsegment"), F.lit("W")).alias("Longitude"),
    )
    cities = customer.where(nation < 18).select(
        country.alias("country"), city.alias("city"), F.col("c_mktsegment").alias("admin_name")
    )
    codes = customer.select(
        F.col("c_mktsegment").alias("State"), F.substring("c_mktsegment", 1, 2).alias("Code")
    ).distinct()
    return {"readings": readings, "cities": cities, "abbreviations": codes}


DEMOGRAPHICS_SQL = """
races AS (
  SELECT * FROM (VALUES """ + ", ".join(f"('{i}', '{r}')" for i, r in enumerate(RACES, 1)) + """) AS r(digit, race)
),
lines AS (
  SELECT c_name AS "City", 'State ' || c_nationkey AS "State",
         CAST(c_nationkey + 20 AS VARCHAR) AS "Median Age",
         CAST(c_custkey AS VARCHAR) AS "Male Population",
         CAST(c_custkey + 7 AS VARCHAR) AS "Female Population",
         CAST(c_custkey * 2 + 7 AS VARCHAR) AS "Total Population",
         CASE WHEN c_acctbal > 0 THEN CAST(c_custkey + 1 AS VARCHAR) END AS "Number of Veterans",
         CAST(c_custkey + 3 AS VARCHAR) AS "Foreign-born",
         CAST(length(c_mktsegment) AS VARCHAR) AS "Average Household Size",
         'S' || c_nationkey AS "State Code",
         race AS "Race",
         CAST(count(*) AS VARCHAR) AS "Count"
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN races ON substr(o_orderpriority, 1, 1) = digit
  GROUP BY ALL
)"""


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and race lines: customers are cities, order priorities races."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    digit = F.substring("o_orderpriority", 1, 1)
    race = F.get(F.array(*[F.lit(r) for r in RACES]), digit.cast("int") - 1)
    # Orders are counted per customer before the join.
    counts = orders.groupBy("o_custkey", race.alias("Race")).agg(F.count(F.lit(1)).cast("string").alias("Count"))
    key = F.col("c_custkey")
    return counts.join(customer, F.col("o_custkey") == key).select(
        F.col("c_name").alias("City"),
        F.concat(F.lit("State "), F.col("c_nationkey")).alias("State"),
        (F.col("c_nationkey") + 20).cast("string").alias("Median Age"),
        key.cast("string").alias("Male Population"),
        (key + 7).cast("string").alias("Female Population"),
        (key * 2 + 7).cast("string").alias("Total Population"),
        F.when(F.col("c_acctbal") > 0, (key + 1).cast("string")).alias("Number of Veterans"),
        (key + 3).cast("string").alias("Foreign-born"),
        F.length("c_mktsegment").cast("string").alias("Average Household Size"),
        F.concat(F.lit("S"), F.col("c_nationkey")).alias("State Code"),
        "Race",
        "Count",
    )


AIRPORTS_SQL = """
airports AS (
  SELECT replace(c_name, '#', ', ') AS name,
         CASE WHEN c_nationkey < 15 THEN 'US' ELSE 'CA' END AS iso_country,
         CASE WHEN c_nationkey = 3 THEN 'US' ELSE 'US-' || c_nationkey END AS iso_region,
         CASE WHEN c_nationkey <> 4 THEN 'Town, ' || c_mktsegment END AS municipality,
         CASE WHEN c_acctbal > 0 THEN 'I' || c_custkey END AS iata_code,
         c_acctbal AS elevation
  FROM customer
)"""


def airport_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.replace("c_name", F.lit("#"), F.lit(", ")).alias("name"),
        F.when(nation < 15, "US").otherwise("CA").alias("iso_country"),
        F.when(nation == 3, "US").otherwise(F.concat(F.lit("US-"), nation)).alias("iso_region"),
        F.when(nation != 4, F.concat(F.lit("Town, "), F.col("c_mktsegment"))).alias("municipality"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("I"), F.col("c_custkey"))).alias("iata_code"),
        F.col("c_acctbal").alias("elevation"),
    )
