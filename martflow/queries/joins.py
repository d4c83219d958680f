"""E: joins.

Plays are line items with the name, brand and price of their part. The
catalogue keeps one part per (name, brand), since names repeat.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.operators.aggregates import one_row_per_key
from martflow.operators.joins import (
    decode,
    enrich,
    equi_join,
    left_join_numeric,
    mean_by_attribute,
    resolve,
    salted_join,
)
from martflow.queries.registry import query, table
from martflow.queries.standins import (
    ARRIVALS_SQL,
    LOG_SQL,
    SONGS_SQL,
    arrival_lookups,
    arrivals,
    log,
    songs,
)
from martflow.session import materialize

CATALOGUE_SQL = """
catalogue AS (
  SELECT p_name AS title, p_brand AS artist, min(p_partkey) AS song_id,
         arg_min(p_retailprice, p_partkey) AS duration
  FROM part GROUP BY p_name, p_brand
),
plays AS (
  SELECT l_orderkey, l_linenumber, l_partkey, p_name AS song,
         CASE WHEN l_quantity > 1 THEN p_brand END AS singer, p_retailprice AS length
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def _plays(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem")
    return equi_join(
        lines, part.select("p_partkey", "p_name", "p_brand", "p_retailprice"), {"l_partkey": "p_partkey"}
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("p_name").alias("song"),
        F.when(F.col("l_quantity") > 1, F.col("p_brand")).alias("singer"),
        F.col("p_retailprice").alias("length"),
    )


def _catalogue(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    named = part.select(
        F.col("p_name").alias("title"), F.col("p_brand").alias("artist"),
        F.col("p_partkey").alias("song_id"), F.col("p_retailprice").alias("duration"),
    )
    return materialize(one_row_per_key(named, ["title", "artist"], ["song_id"], latest=False), "catalogue")


ON = {"song": "title", "singer": "artist"}

INNER_SQL = f"""WITH {CATALOGUE_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, song, singer, song_id
FROM plays JOIN catalogue ON song = title AND singer = artist"""


@query("join_inner_two_key", INNER_SQL)
def join_inner_two_key(spark, sf_dir):
    joined = equi_join(_plays(spark, sf_dir), _catalogue(spark, sf_dir), ON)
    return joined.drop("length", "duration")


@query("join_inner_salted", INNER_SQL)
def join_inner_salted(spark, sf_dir):
    joined = salted_join(_plays(spark, sf_dir), _catalogue(spark, sf_dir), ON, share=0.005, salts=8)
    return joined.drop("length", "duration")


@query(
    "join_left_three_key",
    f"""WITH {CATALOGUE_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, song, singer, length, song_id
    FROM plays LEFT JOIN catalogue ON song = title AND singer = artist
     AND CAST(length AS DECIMAL(18,5)) = CAST(duration AS DECIMAL(18,5))""",
)
def join_left_three_key(spark, sf_dir):
    return left_join_numeric(_plays(spark, sf_dir), _catalogue(spark, sf_dir), ON, ("length", "duration"))


@query(
    "join_resolve_or_null",
    f"""WITH {LOG_SQL}, {SONGS_SQL},
    one AS (SELECT title, artist_name, CAST(duration AS DECIMAL(18,5)) AS d, min((song_id, artist_id)) AS ids
            FROM songs GROUP BY ALL)
    SELECT sessionId, itemInSession, ts, song, ids[1] AS song_id, ids[2] AS artist_id
    FROM log LEFT JOIN one ON song = title AND artist = artist_name AND CAST(length AS DECIMAL(18,5)) = d""",
)
def join_resolve_or_null(spark, sf_dir):
    resolved = resolve(
        log(spark, sf_dir),
        songs(spark, sf_dir),
        {"song": "title", "artist": "artist_name"},
        ("length", "duration"),
        ["song_id", "artist_id"],
    )
    return resolved.select("sessionId", "itemInSession", "ts", "song", "song_id", "artist_id")


@query(
    "join_lookup_decode",
    f"""WITH {ARRIVALS_SQL}
    SELECT cicid, i94port, airport_name, state_code FROM arrivals
    LEFT JOIN airports ON i94port = airport_code""",
)
def join_lookup_decode(spark, sf_dir):
    airports = arrival_lookups(spark, sf_dir)["airports"]
    names = {"airport_name": "airport_name", "state_code": "state_code"}
    return decode(arrivals(spark, sf_dir), airports, "i94port", "airport_code", names).select(
        "cicid", "i94port", *names
    )


@query(
    "join_role_playing",
    """SELECT l_orderkey, l_linenumber, cn.n_name AS buyer_nation, sn.n_name AS seller_nation
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN nation cn ON day(o_orderdate) = cn.n_nationkey
       LEFT JOIN nation sn ON day(l_shipdate) = sn.n_nationkey""",
)
def join_role_playing(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    nation = table(spark, sf_dir, "nation")
    fact = equi_join(lines, orders, {"l_orderkey": "o_orderkey"}).select(
        "l_orderkey",
        "l_linenumber",
        F.dayofmonth("o_orderdate").alias("buyer"),
        F.dayofmonth("l_shipdate").alias("seller"),
    )
    return enrich(
        fact,
        (nation, "buyer", "n_nationkey", {"n_name": "buyer_nation"}),
        (nation, "seller", "n_nationkey", {"n_name": "seller_nation"}),
    ).drop("buyer", "seller")


@query(
    "join_enrich_chain",
    f"""WITH {ARRIVALS_SQL}
    SELECT cicid, airport_name, b.country AS born_country, r.country AS residence_country, mode, visa
    FROM arrivals LEFT JOIN airports ON i94port = airport_code
    LEFT JOIN countries b ON i94cit = b.country_code
    LEFT JOIN countries r ON i94res = r.country_code
    LEFT JOIN modes ON i94mode = mode_code
    LEFT JOIN visas ON i94visa = visa_code""",
)
def join_enrich_chain(spark, sf_dir):
    found = arrival_lookups(spark, sf_dir)
    return enrich(
        arrivals(spark, sf_dir),
        (found["airports"], "i94port", "airport_code", {"airport_name": "airport_name"}),
        (found["countries"], "i94cit", "country_code", {"country": "born_country"}),
        (found["countries"], "i94res", "country_code", {"country": "residence_country"}),
        (found["modes"], "i94mode", "mode_code", {"mode": "mode"}),
        (found["visas"], "i94visa", "visa_code", {"visa": "visa"}),
    ).select("cicid", "airport_name", "born_country", "residence_country", "mode", "visa")


@query(
    "join_left_then_agg",
    """SELECT c_mktsegment AS segment, round(avg(o_totalprice), 4) AS mean_price
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
       GROUP BY c_mktsegment""",
)
def join_left_then_agg(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    means = mean_by_attribute(
        orders, "o_custkey", F.col("o_totalprice"), customer, "c_custkey", "c_mktsegment", "mean_price"
    )
    return means.select(F.col("c_mktsegment").alias("segment"), F.round("mean_price", 4).alias("mean_price"))


@query(
    "join_inner_rename",
    """SELECT s_suppkey, s_name, n_regionkey AS code FROM supplier
       JOIN nation ON 'NATION_' || s_nationkey = n_name""",
)
def join_inner_rename(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").withColumn(
        "nation", F.concat(F.lit("NATION_"), F.col("s_nationkey"))
    )
    joined = equi_join(supplier, table(spark, sf_dir, "nation"), {"nation": "n_name"})
    return joined.select("s_suppkey", "s_name", F.col("n_regionkey").alias("code"))
