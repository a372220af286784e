"""Review-domain inputs derived from the driver's tables, in Spark and in SQL.

The driver's tables hold parts, line items, documents and events, not places
and reviews. Each input below is one row per source row, computed by the
same arithmetic in Spark and in the oracle SQL, so results can be compared
exactly and the work grows with the tables:

* ``places_raw``   (PL) - one place per part;
* ``reviews_raw``  (RV) - one review per line item, with derived nulls;
* ``texts``        (TX) - documents as review texts;
* ``events_raw``   (EV) - events as epoch-millisecond records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Address endings by p_partkey % 5 and the state code each one denotes.
# "Kansas City, MO" exercises the leftmost-match quirk.
_ADDRESS_TAILS = [
    (" Main St, Austin, TX 78701", "TX"),
    (" Ocean Dr, Miami, Florida", "FL"),
    (" Grand Blvd, Kansas City, MO", "MO"),
    (" Elm St, Charleston, West Virginia", "WV"),
    (" Oak Ave, Portland, Oregon", "OR"),
]


def _by_mod(key, values):
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(key % len(values) == i, F.lit(v)) if expr is None
                else expr.when(key % len(values) == i, F.lit(v)))
    return expr


def places_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL: Google-places-shaped rows from ``part`` (one per part)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    ks = k.cast("string")
    tail = _by_mod(k, [t for t, _ in _ADDRESS_TAILS])
    code = _by_mod(k, [c for _, c in _ADDRESS_TAILS])
    size = F.col("p_size")
    return p.select(
        k.alias("place_id"),
        F.concat(F.lit("g"), ks).alias("gmap_id"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("name"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(ks, tail)).alias("address"),
        F.array(F.col("p_name"), F.lower("p_type")).alias("category"),
        F.concat(F.col("p_name"), F.lit(", "), F.lower("p_type")).alias("categories"),
        (F.lit(25.0) + (k * 37 % 2400).cast("double") / 100).alias("latitude"),
        (F.lit(-120.0) + (k * 91 % 5000).cast("double") / 100).alias("longitude"),
        (F.lit(1.0) + (size % 9).cast("double") / 2).alias("avg_rating"),
        (k * 13 % 500).alias("num_of_reviews"),
        F.concat(F.lit("https://maps.example/place/"), ks).alias("url"),
        code.alias("state"),
        F.struct(
            F.when(size % 2 == 0, F.lit("True")).otherwise(F.lit("False")).alias("WiFi"),
            F.when(size % 3 == 0, F.lit("True")).when(size % 3 == 1, F.lit("False")).alias("HasTV"),
            F.when(size % 5 == 0, F.lit("True")).otherwise(F.lit("u'free'")).alias("DogsAllowed"),
        ).alias("attributes"),
    )


def reviews_raw(spark: SparkSession, sf_dir: str, with_unit: bool = False) -> DataFrame:
    """RV: Google-reviews-shaped rows from ``lineitem`` (one per line item).

    Nulls are derived from the line number: 3 -> text, 4 -> rating,
    7 -> user_id. ``with_unit`` adds the input unit a raw file layout would
    put the row in (``state_`` + return flag).
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    unit = [F.concat(F.lit("state_"), F.col("l_returnflag")).alias("unit")] if with_unit else []
    return li.select(
        F.when(ln == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), F.col("l_orderkey").cast("string"))).alias("user_id"),
        F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("gmap_id"),
        F.when(ln == 4, F.lit(None).cast("double")).otherwise(F.col("l_quantity") / 10).alias("rating"),
        F.when(ln == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("flag "), F.col("l_returnflag"), F.lit(" status "),
                             F.col("l_linestatus"))).alias("text"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("time"),
        *unit,
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX: documents as review texts (review_id, text)."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("review_id"), "text")


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV: events with the time as epoch milliseconds."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", "props",
                    F.unix_millis(F.col("ts").cast("timestamp")).alias("time"))


# ---------------------------------------------------------------------------
# The same inputs as SQL common table expressions (DuckDB dialect).
# ---------------------------------------------------------------------------

def _sql_by_mod(key: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {key} % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


PL_SQL = f"""pl AS (
  SELECT p_partkey AS place_id,
         'g' || CAST(p_partkey AS VARCHAR) AS gmap_id,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_name END AS name,
         CASE WHEN p_partkey % 13 = 0 THEN NULL
              ELSE CAST(p_partkey AS VARCHAR) || {_sql_by_mod('p_partkey', [t for t, _ in _ADDRESS_TAILS])} END AS address,
         [p_name, lower(p_type)] AS category,
         p_name || ', ' || lower(p_type) AS categories,
         25.0::DOUBLE + CAST(p_partkey * 37 % 2400 AS DOUBLE) / 100 AS latitude,
         -120.0::DOUBLE + CAST(p_partkey * 91 % 5000 AS DOUBLE) / 100 AS longitude,
         1.0::DOUBLE + CAST(p_size % 9 AS DOUBLE) / 2 AS avg_rating,
         p_partkey * 13 % 500 AS num_of_reviews,
         'https://maps.example/place/' || CAST(p_partkey AS VARCHAR) AS url,
         {_sql_by_mod('p_partkey', [c for _, c in _ADDRESS_TAILS])} AS state,
         CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS wifi,
         CASE WHEN p_size % 3 = 0 THEN 'True' WHEN p_size % 3 = 1 THEN 'False' END AS hastv,
         CASE WHEN p_size % 5 = 0 THEN 'True' ELSE 'u''free''' END AS dogsallowed
  FROM part)"""

RV_SQL = """rv AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE 'u' || CAST(l_orderkey AS VARCHAR) END AS user_id,
         'g' || CAST(l_partkey AS VARCHAR) AS gmap_id,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity / 10 END AS rating,
         CASE WHEN l_linenumber = 3 THEN NULL
              ELSE 'flag ' || l_returnflag || ' status ' || l_linestatus END AS text,
         epoch_us(l_shipdate) // 1000 AS time
  FROM lineitem)"""

TX_SQL = """tx AS (
  SELECT CAST(doc_id AS VARCHAR) AS review_id, text FROM documents)"""

# the words of a text column ``text``
TOKENS_SQL = r"regexp_extract_all(lower(replace(text, chr(8217), '''')), '\p{L}+(?:''\p{L}+)*')"

EV_SQL = """ev AS (
  SELECT event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 AS time FROM events)"""


def yelp_business_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yelp-business-shaped rows from ``part`` (one per part)."""
    pl = places_raw(spark, sf_dir)
    k = F.col("place_id")
    size_null = F.lit(None).cast("double")
    return pl.select(
        F.col("gmap_id").alias("business_id"),
        "name", "address",
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("state")).alias("state"),
        "latitude", "longitude",
        F.when(k % 19 == 0, size_null).otherwise(F.col("avg_rating")).alias("stars"),
        F.col("num_of_reviews").alias("review_count"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("attributes")).alias("attributes"),
        "categories",
    )


def yelp_reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yelp-reviews-shaped rows from ``lineitem``; line 6 carries a bad date."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias("review_id"),
        F.when(ln == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), F.col("l_orderkey").cast("string"))).alias("user_id"),
        F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("business_id"),
        F.when(ln == 4, F.lit(None).cast("double")).otherwise(F.col("l_quantity") / 10).alias("stars"),
        F.when(ln == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("flag "), F.col("l_returnflag"))).alias("text"),
        F.when(ln == 6, F.lit("not a date"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("date"),
    )


YB_SQL = f"""{PL_SQL},
yb AS (
  SELECT gmap_id AS business_id, name, address,
         CASE WHEN place_id % 17 = 0 THEN NULL ELSE state END AS state,
         latitude, longitude,
         CASE WHEN place_id % 19 = 0 THEN NULL ELSE avg_rating END AS stars,
         num_of_reviews AS review_count,
         place_id % 7 = 0 AS attr_null, wifi, hastv, dogsallowed, categories
  FROM pl)"""

YR_SQL = """yr AS (
  SELECT 'r' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE 'u' || CAST(l_orderkey AS VARCHAR) END AS user_id,
         'g' || CAST(l_partkey AS VARCHAR) AS business_id,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity / 10 END AS stars,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE 'flag ' || l_returnflag END AS text,
         CASE WHEN l_linenumber = 6 THEN 'not a date' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS date
  FROM lineitem)"""
