"""Query catalogue: every operator as a query on the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same tables) are the two halves of the correctness check;
every query has an oracle. Review-shaped inputs are derived from the
driver's tables in ``plans.derived`` (Spark) and as SQL CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.functions.text import extract_state, filter_terms, map_state, truncate
from plazalens.operators.clean import (
    dedup_columns,
    dedup_rows,
    drop_null,
    epoch_ms_to_date,
    fill_number,
    fill_text,
    text_to_date,
    to_int_rating,
)
from plazalens.operators.dictionary import filter_dictionary
from plazalens.operators.gold import review_key
from plazalens.operators.nested import true_flag_names, true_flags
from plazalens.operators.quality import (
    contract_violations,
    distinct_count,
    null_counts,
    pk_duplicates,
    profile,
    stage_counts,
)
from plazalens.operators.neighbours import nearest_of_all
from plazalens.plans import derived as dv
from plazalens.plans import medallion as md
from plazalens.plans.derived import EV_SQL, PL_SQL, RV_SQL, TX_SQL
from plazalens.operators.recommend import (
    candidates,
    cosine_to_anchor,
    recommend_nearby,
    recommend_similar,
    requests_frame,
)
from plazalens.operators.sentiment import (
    extremes,
    label,
    read_lexicon,
    lexicon_frame,
    sentiment_scores,
    sentiment_table,
)
from plazalens.functions.text import tokenize
from plazalens.plans.sql_text import (
    DEMO_TERMS,
    DEMO_TERMS_RE_SQL,
    STATE_RE_SQL,
    STATE_VALUES_SQL,
    silver_places_sql,
    silver_reviews_sql,
    sql_str,
)
from plazalens.plans.derived import TOKENS_SQL, YB_SQL, YR_SQL
from plazalens.plans.incremental import run_incremental, run_stage
from plazalens.plans.profiles import DISTINCT_ERROR, layer_profile, run_profile
from plazalens.plans.versioned import run_versioned, run_versioned_stage
from plazalens.sources.load import LoadError, append_table, load_table
from plazalens.schemas import (
    CONTRACTS,
    GOLD_TEXT_MAX,
    GOOGLE_PLACES_RAW,
    GOOGLE_REVIEWS_GOLD,
    GOOGLE_REVIEWS_RAW,
    YELP_REVIEWS_RAW,
)
from plazalens.session import scratch_path
from plazalens.sources.io import (
    list_units,
    read_json,
    read_layer,
    remove_path,
    read_parquet,
    state_dimension,
    write_parquet,
)
from plazalens.sources.ledger import append_ledger, new_units, read_ledger
from plazalens.streaming.ingest import ingest_available_now
from plazalens.streaming.layers import stream_layers

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared Spark inputs ------------------------------------------------------

def silver_places(spark: SparkSession, sf: str) -> DataFrame:
    return md.silver_google_places(dv.places_raw(spark, sf), terms=DEMO_TERMS)


def gold_places(spark: SparkSession, sf: str) -> DataFrame:
    return md.gold_google_places(silver_places(spark, sf))


def silver_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return md.silver_google_reviews(dv.reviews_raw(spark, sf))


# --- gold -----------------------------------------------------------------------

@query("gold_reviews", f"""WITH {silver_places_sql()},
{silver_reviews_sql()}
SELECT user_id, gmap_id, CAST(trunc(rating) AS INTEGER) AS rating,
       substring(text, 1, 7000) AS text, date, user_id || gmap_id AS review_id
FROM gsr WHERE gmap_id IN (SELECT gmap_id FROM gsp)""")
def q_gold_reviews(spark, sf):
    """Flagship: raw reviews -> silver -> gold restricted to silver places (by their keys only)."""
    keys = md.silver_google_place_keys(dv.places_raw(spark, sf), terms=DEMO_TERMS)
    return md.gold_google_reviews(silver_reviews(spark, sf), keys)


@query("gold_reviews_inner", f"""WITH {silver_places_sql()},
{silver_reviews_sql()}
SELECT r.user_id, r.gmap_id, CAST(trunc(r.rating) AS INTEGER) AS rating,
       substring(r.text, 1, 7000) AS text, r.date, r.user_id || r.gmap_id AS review_id
FROM gsr r JOIN gsp p ON r.gmap_id = p.gmap_id""")
def q_gold_reviews_inner(spark, sf):
    """The reference's inner join (repeats a review per copy of its place key)."""
    return md.gold_google_reviews(silver_reviews(spark, sf), gold_places(spark, sf), how="inner")


@query("gold_places", f"""WITH {silver_places_sql()}
SELECT address, avg_rating, gmap_id, latitude, longitude, name,
       CAST(num_of_reviews AS INTEGER) AS num_of_reviews, url, category, state FROM gsp""")
def q_gold_places(spark, sf):
    return gold_places(spark, sf)


@query("silver_google_places", f"""WITH {silver_places_sql()} SELECT * FROM gsp""")
def q_silver_google_places(spark, sf):
    """Places bronze -> silver as one plan: concat, dedup, fill, drop, filter, state."""
    return silver_places(spark, sf)


@query("silver_google_reviews", f"""WITH {silver_reviews_sql()} SELECT * FROM gsr""")
def q_silver_google_reviews(spark, sf):
    return silver_reviews(spark, sf)


@query("review_key", f"""WITH {RV_SQL}
SELECT user_id, gmap_id, user_id || gmap_id AS review_id FROM rv""")
def q_review_key(spark, sf):
    rv = dv.reviews_raw(spark, sf)
    return rv.select("user_id", "gmap_id", review_key("user_id", "gmap_id").alias("review_id"))


@query("category_filter", f"""WITH {PL_SQL}
SELECT place_id, categories FROM pl WHERE regexp_matches(lower(categories), {DEMO_TERMS_RE_SQL})""")
def q_category_filter(spark, sf):
    pl = dv.places_raw(spark, sf)
    return filter_terms(pl, "categories", DEMO_TERMS).select("place_id", "categories")


@query("array_to_text", f"""WITH {PL_SQL}
SELECT place_id, coalesce(array_to_string([name, category[2]], ', '), '') AS category_text
FROM pl""")
def q_array_to_text(spark, sf):
    pl = dv.places_raw(spark, sf)
    arr = F.array(F.col("name"), F.col("category")[1])
    return pl.select("place_id", F.concat_ws(", ", arr).alias("category_text"))


@query("extract_state", f"""WITH {PL_SQL}
SELECT place_id, address,
       CASE WHEN regexp_matches(address, {STATE_RE_SQL}) THEN regexp_extract(address, {STATE_RE_SQL}, 0)
            ELSE 'Unknown' END AS state_first,
       CASE WHEN regexp_matches(address, {STATE_RE_SQL}) THEN regexp_extract_all(address, {STATE_RE_SQL})[-1]
            ELSE 'Unknown' END AS state_last
FROM pl""")
def q_extract_state(spark, sf):
    pl = dv.places_raw(spark, sf)
    return pl.select("place_id", "address",
                     extract_state("address", anchor="first").alias("state_first"),
                     extract_state("address", anchor="last").alias("state_last"))


@query("map_state", f"""WITH {PL_SQL},
s AS (SELECT place_id, CASE WHEN regexp_matches(address, {STATE_RE_SQL})
                            THEN regexp_extract_all(address, {STATE_RE_SQL})[-1] ELSE 'Unknown' END AS raw FROM pl),
m AS (SELECT s.place_id, s.raw, coalesce(d1.code, s.raw) AS state FROM s LEFT JOIN {STATE_VALUES_SQL.replace('dim_state', 'd1')} ON s.raw = d1.sname)
SELECT m.place_id, m.raw AS state_raw, m.state, d2.state_id, d2.sname AS state_name
FROM m LEFT JOIN {STATE_VALUES_SQL.replace('dim_state', 'd2')} ON m.state = d2.code""")
def q_map_state(spark, sf):
    """Name -> code as a literal map, then the 50-row state
    dimension joined by code (broadcast: its size is fixed)."""
    pl = dv.places_raw(spark, sf)
    s = pl.select("place_id", extract_state("address", anchor="last").alias("state_raw"))
    s = s.withColumn("state", map_state("state_raw"))
    dim = state_dimension(spark).select("state_id", F.col("state").alias("_code"),
                                        F.col("name").alias("state_name"))
    out = s.join(F.broadcast(dim), s["state"] == dim["_code"], "left")
    return out.select("place_id", "state_raw", "state", "state_id", "state_name")


_FLAGS_SQL = """CASE WHEN wifi = 'True' THEN 'WiFi' END, CASE WHEN hastv = 'True' THEN 'HasTV' END,
                CASE WHEN dogsallowed = 'True' THEN 'DogsAllowed' END"""


@query("struct_expand", f"""WITH {PL_SQL}
SELECT place_id, wifi AS "WiFi", hastv AS "HasTV", dogsallowed AS "DogsAllowed" FROM pl""")
def q_struct_expand(spark, sf):
    pl = dv.places_raw(spark, sf)
    return pl.select("place_id", "attributes").select("place_id", "attributes.*")


@query("struct_true_flags", f"""WITH {PL_SQL}
SELECT place_id, wifi = 'True' AS "WiFi", hastv = 'True' AS "HasTV",
       dogsallowed = 'True' AS "DogsAllowed" FROM pl""")
def q_struct_true_flags(spark, sf):
    pl = dv.places_raw(spark, sf)
    return pl.select("place_id", *true_flags(pl, "attributes"))


@query("attributes_list", f"""WITH {PL_SQL}
SELECT place_id, coalesce(nullif(concat_ws(', ', {_FLAGS_SQL}), ''), 'Unknown') AS attributes,
       concat_ws(', ', {_FLAGS_SQL}) AS attributes_strict FROM pl""")
def q_attributes_list(spark, sf):
    pl = dv.places_raw(spark, sf)
    return pl.select(
        "place_id",
        F.coalesce(F.nullif(true_flag_names(pl, "attributes"), F.lit("")), F.lit("Unknown")).alias("attributes"),
        true_flag_names(pl, "attributes").alias("attributes_strict"),
    )


@query("fill_defaults", f"""WITH {RV_SQL}
SELECT user_id, gmap_id, coalesce(rating, 0) AS rating, coalesce(text, 'Unknown') AS text, time FROM rv""")
def q_fill_defaults(spark, sf):
    rv = dv.reviews_raw(spark, sf)
    return fill_number(fill_text(rv, "Unknown", ["text", "rating"]), 0, ["rating", "text"])


@query("drop_null_keys", f"""WITH {RV_SQL}
SELECT * FROM rv WHERE user_id IS NOT NULL AND gmap_id IS NOT NULL AND time IS NOT NULL""")
def q_drop_null_keys(spark, sf):
    return drop_null(dv.reviews_raw(spark, sf), ["user_id", "gmap_id", "time"])


@query("drop_any_null", f"""WITH {RV_SQL}
SELECT * FROM rv WHERE user_id IS NOT NULL AND gmap_id IS NOT NULL AND rating IS NOT NULL
  AND text IS NOT NULL AND time IS NOT NULL""")
def q_drop_any_null(spark, sf):
    return drop_null(dv.reviews_raw(spark, sf))


@query("dedup_rows", """SELECT DISTINCT l_returnflag, l_linestatus, l_partkey FROM lineitem""")
def q_dedup_rows(spark, sf):
    li = dv.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_partkey")
    return dedup_rows(li)


@query("dedup_columns", """SELECT p_partkey, p_name FROM part""")
def q_dedup_columns(spark, sf):
    p = dv.table(spark, sf, "part")
    repeated = p.select("p_partkey", "p_name", F.col("p_type").alias("p_name"))
    return dedup_columns(repeated)


@query("epoch_to_date", f"""WITH {EV_SQL}
SELECT event_id, time, CAST(epoch_ms(time) AS DATE) AS date FROM ev""")
def q_epoch_to_date(spark, sf):
    ev = dv.events_raw(spark, sf)
    return ev.select("event_id", "time", epoch_ms_to_date("time").alias("date"))


@query("parse_date", """WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '5%' THEN 'n/a ' || o_orderstatus
                          ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date_text FROM orders)
SELECT o_orderkey, date_text, CAST(try_strptime(substring(date_text, 1, 10), '%Y-%m-%d') AS DATE) AS date FROM o""")
def q_parse_date(spark, sf):
    o = dv.table(spark, sf, "orders")
    txt = F.when(F.col("o_orderpriority").startswith("5"), F.concat(F.lit("n/a "), F.col("o_orderstatus"))) \
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    o = o.select("o_orderkey", txt.alias("date_text"))
    return o.select("o_orderkey", "date_text", text_to_date("date_text").alias("date"))


@query("truncate_text", """SELECT doc_id, substring(text, 1, 7000) AS text,
       CAST(length(substring(text, 1, 7000)) AS INTEGER) AS n_kept FROM documents""")
def q_truncate_text(spark, sf):
    d = dv.table(spark, sf, "documents")
    cut = truncate("text", GOLD_TEXT_MAX)
    return d.select("doc_id", cut.alias("text"), F.char_length(cut).alias("n_kept"))


@query("cast_rating", f"""WITH {RV_SQL}
SELECT user_id, gmap_id, rating, CAST(trunc(rating) AS INTEGER) AS rating_int FROM rv""")
def q_cast_rating(spark, sf):
    rv = dv.reviews_raw(spark, sf)
    return rv.select("user_id", "gmap_id", "rating", to_int_rating("rating").alias("rating_int"))


@query("null_counts", f"""WITH {RV_SQL}
SELECT CAST(count_if(user_id IS NULL) AS BIGINT) AS user_id, CAST(count_if(gmap_id IS NULL) AS BIGINT) AS gmap_id,
       CAST(count_if(rating IS NULL) AS BIGINT) AS rating, CAST(count_if(text IS NULL) AS BIGINT) AS text,
       CAST(count_if(time IS NULL) AS BIGINT) AS time FROM rv""")
def q_null_counts(spark, sf):
    return null_counts(dv.reviews_raw(spark, sf))


@query("row_counts", f"""WITH {silver_places_sql()},
{silver_reviews_sql()}
SELECT 'raw' AS stage, count(*) AS rows FROM rv
UNION ALL SELECT 'silver', count(*) FROM gsr
UNION ALL SELECT 'gold', count(*) FROM gsr WHERE gmap_id IN (SELECT gmap_id FROM gsp)""")
def q_row_counts(spark, sf):
    raw = dv.reviews_raw(spark, sf)
    silver = md.silver_google_reviews(raw)
    gold = md.gold_google_reviews(silver, gold_places(spark, sf))
    return stage_counts({"raw": raw, "silver": silver, "gold": gold})


@query("distinct_key_count", f"""WITH {RV_SQL}
SELECT count(DISTINCT user_id) AS distinct_keys FROM rv""")
def q_distinct_key_count(spark, sf):
    return distinct_count(dv.reviews_raw(spark, sf), "user_id")


@query("profile_table", f"""WITH {RV_SQL}
SELECT 0 AS ordinal, 'user_id' AS column_name, 'string' AS data_type, count(*) AS rows, count(user_id) AS non_null, count(*) - count(user_id) AS nulls FROM rv
UNION ALL SELECT 1, 'gmap_id', 'string', count(*), count(gmap_id), count(*) - count(gmap_id) FROM rv
UNION ALL SELECT 2, 'rating', 'double', count(*), count(rating), count(*) - count(rating) FROM rv
UNION ALL SELECT 3, 'text', 'string', count(*), count(text), count(*) - count(text) FROM rv
UNION ALL SELECT 4, 'time', 'bigint', count(*), count(time), count(*) - count(time) FROM rv""")
def q_profile_table(spark, sf):
    return profile(dv.reviews_raw(spark, sf))


_CONTRACT_INPUT_SQL = f"""{RV_SQL},
c AS (SELECT user_id, user_id || gmap_id AS review_id, CAST(trunc(rating) AS INTEGER) AS rating,
             gmap_id, CAST(epoch_ms(time) AS DATE) AS date FROM rv)"""


def _contract_input(spark, sf):
    rv = dv.reviews_raw(spark, sf)
    return rv.select("user_id", review_key("user_id", "gmap_id").alias("review_id"),
                     to_int_rating("rating").alias("rating"), "gmap_id",
                     epoch_ms_to_date("time").alias("date"))


@query("contract_violations", f"""WITH {_CONTRACT_INPUT_SQL}
SELECT 'user_id' AS column_name, 'not_null' AS "check", count_if(user_id IS NULL) AS violations FROM c
UNION ALL SELECT 'user_id', 'max_length 1000', count_if(length(user_id) > 1000) FROM c
UNION ALL SELECT 'review_id', 'not_null', count_if(review_id IS NULL) FROM c
UNION ALL SELECT 'review_id', 'max_length 4000', count_if(length(review_id) > 4000) FROM c
UNION ALL SELECT 'rating', 'not_null', count_if(rating IS NULL) FROM c
UNION ALL SELECT 'gmap_id', 'not_null', count_if(gmap_id IS NULL) FROM c
UNION ALL SELECT 'gmap_id', 'max_length 1000', count_if(length(gmap_id) > 1000) FROM c
UNION ALL SELECT 'date', 'not_null', count_if(date IS NULL) FROM c""")
def q_contract_violations(spark, sf):
    """Reviews table contract checked on unfiltered reviews (nulls show up)."""
    return contract_violations(_contract_input(spark, sf), CONTRACTS["reviews_google"])


@query("pk_duplicates", f"""WITH {_CONTRACT_INPUT_SQL}
SELECT review_id, count(*) AS occurrences FROM c GROUP BY review_id HAVING count(*) > 1""")
def q_pk_duplicates(spark, sf):
    """review_id = user_id || gmap_id repeats."""
    return pk_duplicates(_contract_input(spark, sf), ["review_id"])


@query("load_by_ordinal", f"""WITH {silver_places_sql()}
SELECT gmap_id, address, name, latitude, longitude, category,
       CAST(num_of_reviews AS INTEGER) AS review_count, avg_rating, url, state FROM gsp""")
def q_load_by_ordinal(spark, sf):
    """Warehouse load by column ordinal with contract types."""
    return load_table(gold_places(spark, sf), "business_google", scratch_path(spark, "business_google"))


@query("union_all", f"""WITH {PL_SQL}
SELECT place_id, name, categories, NULL::VARCHAR AS url FROM pl WHERE avg_rating < 3
UNION ALL SELECT place_id, name, categories, url FROM pl WHERE avg_rating >= 3""")
def q_union_all(spark, sf):
    """Two inputs with different columns stacked by name."""
    pl = dv.places_raw(spark, sf)
    a = pl.filter(F.col("avg_rating") < 3).select("categories", "name", "place_id")
    b = pl.filter(F.col("avg_rating") >= 3).select("url", "place_id", "name", "categories")
    return a.unionByName(b, allowMissingColumns=True).select("place_id", "name", "categories", "url")


@query("sample_head", """SELECT * FROM part ORDER BY p_partkey LIMIT 10""")
def q_sample_head(spark, sf):
    """First n rows, with an order so the sample is reproducible."""
    return dv.table(spark, sf, "part").orderBy("p_partkey").limit(10)


# --- sentiment ------------------------------------------------------------------
# FIXED VALUES for the sentiment queries: a small lexicon, negators and boosters
# made of words that occur in the English documents (the test corpus is
# invented prose, so a real lexicon would hardly hit).
DEMO_LEXICON = [("the", 0.3), ("worthless", -2.0), ("that", -0.4), ("by", 0.7),
                ("with", -0.9), ("for", 1.2), ("from", -1.1), ("was", 0.5)]
DEMO_NEGATORS = ["not", "never", "it", "this"]
DEMO_BOOSTERS = [("very", 0.293), ("a", 0.293), ("an", -0.293), ("is", 0.293)]


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(sql_str(v) if isinstance(v, str) else repr(v) for v in r) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS {cols}"


_LEX_SQL = f"lex AS (SELECT * FROM {_values(DEMO_LEXICON, 'l(token, valence)')})"

_SCORE_SIMPLE_SQL = f"""{TX_SQL},
{_LEX_SQL},
toks AS (SELECT review_id, unnest({TOKENS_SQL}) AS token FROM tx),
sums AS (SELECT t.review_id, sum(coalesce(l.valence, 0)) AS s FROM toks t LEFT JOIN lex l ON t.token = l.token GROUP BY t.review_id),
score AS (SELECT tx.review_id, CASE WHEN tx.text IS NULL THEN NULL
              ELSE round(coalesce(sums.s, 0) / sqrt(coalesce(sums.s, 0) * coalesce(sums.s, 0) + 15), 6) + 0.0 END AS sentiment_score
          FROM tx LEFT JOIN sums ON tx.review_id = sums.review_id)"""

def _score_rules_sql(contrast: str | None = None, punctuation: bool = False, tokens_sql: str = TOKENS_SQL,
                     lexicon=DEMO_LEXICON, negators=DEMO_NEGATORS, boosters=DEMO_BOOSTERS,
                     special_cases: bool = False) -> str:
    """Oracle CTEs ending in ``score``: tokens with positions, ``lag`` for the
    three preceding tokens, booster/negation steps, optional contrast-word
    factor, '!'/'?' emphasis and the "never so" and "least" cases."""
    never2 = "WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN v * 1.5" if special_cases else ""
    never3 = "WHEN p3 = 'never' AND (p1 IN ('so', 'this') OR p2 IN ('so', 'this')) THEN v * 1.25" if special_cases else ""
    least = ("""CASE WHEN p1 = 'least' AND coalesce(p2, '') NOT IN ('at', 'very')
                      AND 'least' NOT IN (SELECT token FROM lex) THEN v * -0.74 ELSE v END""" if special_cases else "v")
    cpos = (f"coalesce(list_position(l, {sql_str(contrast)}), 0)" if contrast else "0")
    factor = ("CASE WHEN cpos > 0 AND pos < cpos THEN 0.5 WHEN cpos > 0 AND pos > cpos THEN 1.5 ELSE 1.0 END"
              if contrast else "1.0")
    amp = ("""least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
               + CASE WHEN qm <= 1 THEN 0.0::DOUBLE WHEN qm <= 3 THEN qm * 0.18::DOUBLE ELSE 0.96::DOUBLE END"""
           if punctuation else "0.0::DOUBLE")
    return f"""{TX_SQL},
lex AS (SELECT * FROM {_values(lexicon, 'l(token, valence)')}),
neg AS (SELECT * FROM {_values([(w,) for w in negators], 'n(token)')}),
boost AS (SELECT * FROM {_values(boosters, 'b(token, scalar)')}),
arr AS (SELECT review_id, l, {cpos} AS cpos
        FROM (SELECT review_id, {tokens_sql} AS l FROM tx)),
toks AS (SELECT review_id, cpos, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM arr),
w AS (SELECT review_id, pos, cpos, token,
             lag(token, 1) OVER win AS p1, lag(token, 2) OVER win AS p2, lag(token, 3) OVER win AS p3
      FROM toks WINDOW win AS (PARTITION BY review_id ORDER BY pos)),
modb AS (SELECT * FROM boost WHERE token NOT IN (SELECT token FROM lex)),
v0 AS (SELECT w.*, CASE WHEN w.token IN (SELECT token FROM boost) THEN NULL ELSE l.valence END AS v,
              b1.scalar AS b1, b2.scalar * 0.95 AS b2, b3.scalar * 0.9 AS b3
       FROM w LEFT JOIN lex l ON w.token = l.token
              LEFT JOIN modb b1 ON w.p1 = b1.token LEFT JOIN modb b2 ON w.p2 = b2.token
              LEFT JOIN modb b3 ON w.p3 = b3.token),
v1 AS (SELECT review_id, pos, cpos, p1, p2, p3, b2, b3,
              v + coalesce(CASE WHEN v < 0 THEN -(b1 * 1.0) ELSE b1 * 1.0 END, 0) AS v FROM v0),
v1n AS (SELECT review_id, pos, cpos, p1, p2, p3, b2, b3,
               CASE WHEN p1 IN (SELECT token FROM neg) THEN v * -0.74 ELSE v END AS v FROM v1),
v2 AS (SELECT review_id, pos, cpos, p1, p2, p3, b3, v + coalesce(CASE WHEN v < 0 THEN -b2 ELSE b2 END, 0) AS v FROM v1n),
v2n AS (SELECT review_id, pos, cpos, p1, p2, p3, b3, CASE {never2} WHEN p2 IN (SELECT token FROM neg) THEN v * -0.74 ELSE v END AS v FROM v2),
v3 AS (SELECT review_id, pos, cpos, p1, p2, p3, v + coalesce(CASE WHEN v < 0 THEN -b3 ELSE b3 END, 0) AS v FROM v2n),
v3n AS (SELECT review_id, pos, cpos, p1, p2, CASE {never3} WHEN p3 IN (SELECT token FROM neg) THEN v * -0.74 ELSE v END AS v FROM v3),
v4 AS (SELECT review_id, pos, cpos, {least} AS v FROM v3n),
vc AS (SELECT review_id, v * {factor} AS v FROM v4),
sums AS (SELECT review_id, sum(coalesce(v, 0)) AS s FROM vc GROUP BY review_id),
amp AS (SELECT review_id, {amp} AS amp
        FROM (SELECT review_id, text, length(text) - length(replace(text, '?', '')) AS qm FROM tx)),
s2 AS (SELECT tx.review_id, tx.text, coalesce(sums.s, 0) AS s0, coalesce(amp.amp, 0) AS a
       FROM tx LEFT JOIN sums ON tx.review_id = sums.review_id LEFT JOIN amp ON tx.review_id = amp.review_id),
s3 AS (SELECT review_id, text, CASE WHEN s0 > 1e-9 THEN s0 + a WHEN s0 < -1e-9 THEN s0 - a ELSE s0 END AS s FROM s2),
score AS (SELECT review_id, CASE WHEN text IS NULL THEN NULL ELSE round(s / sqrt(s * s + 15), 6) + 0.0 END AS sentiment_score
          FROM s3)"""


_SCORE_RULES_SQL = _score_rules_sql()

_LABEL_SQL = """CASE WHEN sentiment_score >= 0.3 THEN 'positive'
            WHEN sentiment_score > -0.3 AND sentiment_score < 0.3 THEN 'neutral'
            WHEN sentiment_score IS NOT NULL THEN 'negative' END"""


def _scores(spark, sf, rules: bool):
    lex = lexicon_frame(spark, DEMO_LEXICON)
    kw = dict(negators=DEMO_NEGATORS, boosters=DEMO_BOOSTERS) if rules else {}
    return sentiment_scores(dv.texts(spark, sf), lex, round_to=6, **kw)


def _sentiment_table(spark, sf):
    lex = lexicon_frame(spark, DEMO_LEXICON)
    return sentiment_table(dv.texts(spark, sf), lex, round_to=6,
                           negators=DEMO_NEGATORS, boosters=DEMO_BOOSTERS)


@query("tokenize", f"""WITH {TX_SQL},
arr AS (SELECT review_id, {TOKENS_SQL} AS l FROM tx)
SELECT review_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS token FROM arr""")
def q_tokenize(spark, sf):
    return tokenize(dv.texts(spark, sf), "review_id", "text")


@query("sentiment_score", f"WITH {_SCORE_SIMPLE_SQL} SELECT * FROM score")
def q_sentiment_score(spark, sf):
    """R2/L2/L3: lexicon sum per review -> compound score."""
    return _scores(spark, sf, rules=False)


@query("sentiment_score_rules", f"WITH {_SCORE_RULES_SQL} SELECT * FROM score")
def q_sentiment_score_rules(spark, sf):
    """L4: booster and negation rules over the three preceding tokens."""
    return _scores(spark, sf, rules=True)


@query("sentiment_label", f"WITH {_SCORE_SIMPLE_SQL} SELECT review_id, sentiment_score, {_LABEL_SQL} AS sentiment FROM score")
def q_sentiment_label(spark, sf):
    """three bands on the score."""
    s = _scores(spark, sf, rules=False)
    return s.select("review_id", "sentiment_score", label(F.col("sentiment_score")).alias("sentiment"))


@query("sentiment_table", f"WITH {_SCORE_RULES_SQL} SELECT review_id, sentiment_score, {_LABEL_SQL} AS sentiment FROM score")
def q_sentiment_table(spark, sf):
    """(review_id, sentiment_score, sentiment)."""
    return _sentiment_table(spark, sf)


@query("sentiment_bottom_k", f"""WITH {_SCORE_RULES_SQL}
SELECT review_id, sentiment_score, {_LABEL_SQL} AS sentiment FROM score
ORDER BY sentiment_score ASC NULLS LAST, review_id LIMIT 100""")
def q_sentiment_bottom_k(spark, sf):
    """The 100 lowest scores."""
    return extremes(_sentiment_table(spark, sf), 100, highest=False)


@query("sentiment_top_k", f"""WITH {_SCORE_RULES_SQL}
SELECT review_id, sentiment_score, {_LABEL_SQL} AS sentiment FROM score
ORDER BY sentiment_score DESC NULLS LAST, review_id LIMIT 10""")
def q_sentiment_top_k(spark, sf):
    """The 10 highest scores."""
    return extremes(_sentiment_table(spark, sf), 10, highest=True)


# --- recommendation ------------------------------------------------------------------
SINGLE_REQUEST = [(0, "TX", "ring")]
BULK_REQUESTS = [(1, "TX", "ring"), (2, "fl", "bolt|gear"), (3, "o", "gizmo"),
                 (4, "ZZ", "ring"), (5, "w", "plate"), (6, "TX", "ring"), (7, "o", "gizmo")]


def rec_places(spark, sf):
    """Recommendation input: one place per part with the returned columns."""
    pl = dv.places_raw(spark, sf)
    return pl.select(
        "place_id",
        F.coalesce("name", F.lit("Unknown")).alias("name"),
        F.coalesce("address", F.lit("Unknown")).alias("address"),
        "categories",
        F.coalesce(F.nullif(true_flag_names(pl, "attributes"), F.lit("")), F.lit("Unknown")).alias("attributes"),
        "state", "latitude", "longitude", "avg_rating",
        F.col("num_of_reviews").cast("double").alias("review_count"),
    )


_REC_PLACES_SQL = f"""{PL_SQL},
rp AS (SELECT place_id, coalesce(name, 'Unknown') AS name, coalesce(address, 'Unknown') AS address, categories,
              coalesce(nullif(concat_ws(', ', {_FLAGS_SQL}), ''), 'Unknown') AS attributes,
              state, latitude, longitude, avg_rating, CAST(num_of_reviews AS DOUBLE) AS review_count FROM pl)"""


def _cand_sql(requests):
    return f"""{_REC_PLACES_SQL},
req AS (SELECT * FROM {_values(requests, 'r(query_id, sp, cp)')}),
cand AS (SELECT CAST(r.query_id AS BIGINT) AS query_id, p.* FROM rp p
         JOIN req r ON regexp_matches(p.state, '(?i)' || r.sp) AND regexp_matches(p.categories, '(?i)' || r.cp)
         WHERE p.avg_rating >= 4),
anc AS (SELECT query_id, latitude AS a1, longitude AS a2, avg_rating AS a3, review_count AS a4, place_id AS aid
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY place_id) AS rn FROM cand) WHERE rn = 1)"""


def _similar_sql(requests):
    return f"""WITH {_cand_sql(requests)},
m AS (SELECT c.*, c.latitude * a.a1 + c.longitude * a.a2 + c.avg_rating * a.a3 + c.review_count * a.a4 AS dot,
             sqrt(c.latitude * c.latitude + c.longitude * c.longitude + c.avg_rating * c.avg_rating + c.review_count * c.review_count) AS na,
             sqrt(a.a1 * a.a1 + a.a2 * a.a2 + a.a3 * a.a3 + a.a4 * a.a4) AS nb
      FROM cand c JOIN anc a ON c.query_id = a.query_id),
sc AS (SELECT *, CASE WHEN na = 0 OR nb = 0 THEN 0 ELSE dot / (na * nb) END AS sim FROM m),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, place_id) AS rank FROM sc)
SELECT query_id, CAST(rank AS INTEGER) AS rank, place_id, name, address, avg_rating, categories, attributes,
       round(sim, 6) + 0.0 AS similarity
FROM rk WHERE rank <= 5"""


def _nearby_sql(requests):
    return f"""WITH {_cand_sql(requests)},
sc AS (SELECT c.*, sqrt((c.latitude - a.a1) * (c.latitude - a.a1) + (c.longitude - a.a2) * (c.longitude - a.a2)) AS dist
       FROM cand c JOIN anc a ON c.query_id = a.query_id WHERE c.place_id <> a.aid),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, place_id) AS rank FROM sc)
SELECT query_id, CAST(rank AS INTEGER) AS rank, place_id, name, address, avg_rating, categories, attributes,
       round(dist, 6) + 0.0 AS distance
FROM rk WHERE rank <= 5"""


@query("place_search", f"""WITH {_cand_sql([(1, 'o', 'ring|gear')])}
SELECT query_id, place_id, name, state, categories, avg_rating FROM cand""")
def q_place_search(spark, sf):
    """case-insensitive regex on state and category, rating >= 4."""
    req = requests_frame(spark, [(1, "o", "ring|gear")])
    return candidates(rec_places(spark, sf), req).select(
        "query_id", "place_id", "name", "state", "categories", "avg_rating")


@query("recommend_similar", _similar_sql(SINGLE_REQUEST))
def q_recommend_similar(spark, sf):
    """Five most similar places to the request's first place."""
    return recommend_similar(rec_places(spark, sf), requests_frame(spark, SINGLE_REQUEST))


@query("recommend_nearby", _nearby_sql(SINGLE_REQUEST))
def q_recommend_nearby(spark, sf):
    """Five nearest places to the request's first place, itself excluded."""
    return recommend_nearby(rec_places(spark, sf), requests_frame(spark, SINGLE_REQUEST))


@query("recommend_similar_bulk", _similar_sql(BULK_REQUESTS))
def q_recommend_similar_bulk(spark, sf):
    """All requests in one job."""
    return recommend_similar(rec_places(spark, sf), requests_frame(spark, BULK_REQUESTS))


@query("recommend_nearby_bulk", _nearby_sql(BULK_REQUESTS))
def q_recommend_nearby_bulk(spark, sf):
    """All requests in one job."""
    return recommend_nearby(rec_places(spark, sf), requests_frame(spark, BULK_REQUESTS))


@query("nearest_places", f"""WITH {PL_SQL},
d AS (SELECT a.place_id, b.place_id AS neighbour,
             sqrt((a.latitude - b.latitude) * (a.latitude - b.latitude)
                  + (a.longitude - b.longitude) * (a.longitude - b.longitude)) AS dist
      FROM pl a JOIN pl b ON a.place_id <> b.place_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY dist, neighbour) AS rank FROM d)
SELECT place_id, CAST(rank AS INTEGER) AS rank, neighbour, round(dist, 6) + 0.0 AS distance FROM rk WHERE rank <= 5""")
def q_nearest_places(spark, sf):
    """The five nearest other places of every place, by the index of grid-ordered blocks."""
    near = nearest_of_all(dv.places_raw(spark, sf), 5)
    return near.withColumn("distance", F.round("distance", 6) + F.lit(0.0))


@query("cosine_to_anchor", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
a AS (SELECT label, v AS av FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM e) WHERE rn = 1),
m AS (SELECT e.vec_id, e.label,
             list_reduce(list_transform(range(1, len(e.v) + 1), lambda i: e.v[i] * a.av[i]), lambda x, y: x + y) AS dot,
             sqrt(list_reduce(list_transform(e.v, lambda x: x * x), lambda x, y: x + y)) AS na,
             sqrt(list_reduce(list_transform(a.av, lambda x: x * x), lambda x, y: x + y)) AS nb
      FROM e JOIN a ON e.label = a.label)
SELECT vec_id, label, round(CASE WHEN na = 0 OR nb = 0 THEN 0 ELSE dot / (na * nb) END, 6) + 0.0 AS similarity FROM m""")
def q_cosine_to_anchor(spark, sf):
    """R8 re-aimed: cosine of every vector to its group's first vector (the one
    row of the n x n matrix the reference uses), O(n) instead of all pairs."""
    return cosine_to_anchor(dv.table(spark, sf, "embeddings"), "vec_id", "embedding", "label")


# --- Yelp ---------------------------------------------------------------------------

_YB_SILVER_SQL = f"""{YB_SQL},
ybd AS (SELECT DISTINCT business_id, name, address, state, latitude, longitude, stars, review_count,
                        attr_null, wifi, hastv, dogsallowed, categories FROM yb),
ybf AS (SELECT business_id, coalesce(name, 'Unknown') AS name, coalesce(address, 'Unknown') AS address, state,
               coalesce(latitude, 0) AS latitude, coalesce(longitude, 0) AS longitude, coalesce(stars, 0) AS stars,
               coalesce(review_count, 0) AS review_count, attr_null, wifi, hastv, dogsallowed, categories
        FROM ybd
        WHERE business_id IS NOT NULL AND categories IS NOT NULL AND state IS NOT NULL
          AND regexp_matches(lower(categories), {DEMO_TERMS_RE_SQL})),
ysb AS (SELECT business_id, name, address, state, latitude, longitude, stars AS avg_rating, review_count, categories,
               CASE WHEN attr_null THEN 'Unknown' ELSE coalesce(nullif(concat_ws(', ', {_FLAGS_SQL}), ''), 'Unknown') END AS attributes
        FROM ybf)"""

_YR_SILVER_SQL = f"""{YR_SQL},
yrd AS (SELECT DISTINCT * FROM yr),
ysr AS (SELECT review_id, user_id, business_id, stars, text,
               CAST(try_strptime(substring(date, 1, 10), '%Y-%m-%d') AS DATE) AS date
        FROM yrd
        WHERE review_id IS NOT NULL AND user_id IS NOT NULL AND business_id IS NOT NULL
          AND stars IS NOT NULL AND text IS NOT NULL AND date IS NOT NULL)"""


def yelp_business_silver(spark, sf):
    return md.silver_yelp_business(dv.yelp_business_raw(spark, sf), terms=DEMO_TERMS)


@query("silver_yelp_business", f"WITH {_YB_SILVER_SQL} SELECT * FROM ysb")
def q_silver_yelp_business(spark, sf):
    """Yelp business bronze -> silver, attributes struct -> list of true names."""
    return yelp_business_silver(spark, sf)


@query("silver_yelp_reviews", f"WITH {_YR_SILVER_SQL} SELECT * FROM ysr")
def q_silver_yelp_reviews(spark, sf):
    return md.silver_yelp_reviews(dv.yelp_reviews_raw(spark, sf))


@query("gold_yelp_reviews", f"""WITH {_YB_SILVER_SQL}, {_YR_SILVER_SQL}
SELECT review_id, user_id, business_id, CAST(trunc(stars) AS INTEGER) AS rating,
       substring(text, 1, 7000) AS text, date
FROM ysr WHERE business_id IN (SELECT business_id FROM ysb)""")
def q_gold_yelp_reviews(spark, sf):
    keys = md.silver_yelp_business_keys(dv.yelp_business_raw(spark, sf), terms=DEMO_TERMS)
    return md.gold_yelp_reviews(md.silver_yelp_reviews(dv.yelp_reviews_raw(spark, sf)), keys)


@query("load_by_ordinal_yelp", f"""WITH {_YB_SILVER_SQL}
SELECT business_id, name, address, latitude, longitude, state, categories AS category, avg_rating,
       CAST(review_count AS INTEGER) AS review_count, attributes FROM ysb""")
def q_load_by_ordinal_yelp(spark, sf):
    gold = md.gold_yelp_business(yelp_business_silver(spark, sf))
    return load_table(gold, "business_yelp", scratch_path(spark, "business_yelp"))


# --- sources, sinks, layers, ledger, streaming ------------------------------------
# These write the derived inputs to a fresh folder below the shared scratch
# root (spark.checkpoint.dir), then read them back through the library.

def _reviews_with_unit(spark, sf):
    return dv.reviews_raw(spark, sf, with_unit=True)


def _places_with_unit(spark, sf):
    pl = dv.places_raw(spark, sf)
    return pl.select(*GOOGLE_PLACES_RAW.fieldNames(),
                     F.concat(F.lit("type_"), F.col("category")[1]).alias("unit"))


def _write_units(df, path):
    df.write.partitionBy("unit").json(path)


def _google_lake(spark, sf):
    """Raw JSON units for places and reviews, then two incremental runs."""
    base = scratch_path(spark, "lake")
    raw_places, raw_reviews, lake = f"{base}/raw/places", f"{base}/raw/reviews", f"{base}/lake"
    _write_units(_places_with_unit(spark, sf), raw_places)
    _write_units(_reviews_with_unit(spark, sf), raw_reviews)

    def places_reader(s, paths, root):
        return read_json(s, paths, GOOGLE_PLACES_RAW, with_source=True, unit_root=root, with_rejects=True)

    def reviews_reader(s, paths, root):
        return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root, with_rejects=True)

    for _ in range(2):  # the second run finds nothing new
        run_incremental(spark, "google_places", raw_places, lake, "google", "places",
                        places_reader, lambda b: md.silver_google_places(b, terms=DEMO_TERMS))
        run_incremental(spark, "google_reviews", raw_reviews, lake, "google", "reviews",
                        reviews_reader, md.silver_google_reviews)
    return base, lake


@query("scan_json_roundtrip", f"WITH {RV_SQL} SELECT * FROM rv")
def q_scan_json_roundtrip(spark, sf):
    """JSON lines written, read back with the declared schema."""
    path = scratch_path(spark, "json")
    dv.reviews_raw(spark, sf).write.json(path)
    return read_json(spark, path, GOOGLE_REVIEWS_RAW, columns=GOOGLE_REVIEWS_RAW.fieldNames())


@query("scan_glob_schema", ORACLE["gold_reviews"])
def q_scan_glob_schema(spark, sf):
    """Gold reviews in several folders read through a glob with a schema."""
    path = scratch_path(spark, "glob")
    gold = md.gold_google_reviews(silver_reviews(spark, sf), gold_places(spark, sf))
    gold.withColumn("unit", F.year("date")).write.partitionBy("unit").parquet(path)
    return read_parquet(spark, f"{path}/*", schema=GOOGLE_REVIEWS_GOLD)


@query("scan_source_file", """SELECT 'unit=state_' || l_returnflag AS source_file, count(*) AS rows
FROM lineitem GROUP BY 1""")
def q_scan_source_file(spark, sf):
    """Folder-of-files units; the unit of each row from the file metadata."""
    path = scratch_path(spark, "units")
    _write_units(_reviews_with_unit(spark, sf), path)
    df = read_json(spark, path, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=path)
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


@query("sink_parquet_roundtrip", ORACLE["gold_places"])
def q_sink_parquet_roundtrip(spark, sf):
    """Parquet sink (fails if the target exists), read back."""
    path = scratch_path(spark, "sink")
    write_parquet(gold_places(spark, sf), path)
    return spark.read.parquet(path)


@query("medallion_google_places", ORACLE["silver_google_places"])
def q_medallion_google_places(spark, sf):
    """Raw JSON units -> bronze -> silver through the ledger, read back."""
    _, lake = _google_lake(spark, sf)
    return read_layer(spark, lake, "silver", "google", "places").drop("source_file")


@query("layer_readback", f"""WITH {RV_SQL.replace('FROM lineitem)', ', ' + sql_str('unit=state_') + ' || l_returnflag AS source_file FROM lineitem)')},
d AS (SELECT DISTINCT user_id, gmap_id, rating, text, time, source_file FROM rv)
SELECT user_id, gmap_id, coalesce(rating, 0) AS rating, coalesce(text, 'Unknown') AS text,
       CAST(epoch_ms(time) AS DATE) AS date, source_file
FROM d WHERE user_id IS NOT NULL AND gmap_id IS NOT NULL AND time IS NOT NULL""")
def q_layer_readback(spark, sf):
    """A layer read back with its input unit column."""
    _, lake = _google_lake(spark, sf)
    return read_layer(spark, lake, "silver", "google", "reviews")


@query("medallion_gold_reviews", ORACLE["gold_reviews"])
def q_medallion_gold_reviews(spark, sf):
    """End to end: incremental silver layers -> incremental gold, written by unit and read back."""
    lake = _google_gold(spark, sf)
    return read_layer(spark, lake, "gold", "google", "reviews").drop("source_file")


def _google_gold(spark, sf):
    """The lake with gold reviews: two runs of the gold stage over the units that silver recorded."""
    _, lake = _google_lake(spark, sf)
    places = md.gold_google_places(read_layer(spark, lake, "silver", "google", "places"))
    for _ in range(2):
        run_stage(spark, "google_reviews", "google_reviews:gold", lake, "google", ("silver", "reviews"),
                  ("gold", "reviews"), lambda r: md.gold_google_reviews(r, places))
    return lake


def _versioned_lake(spark, sf, name):
    base = scratch_path(spark, name)
    raw_places, raw_reviews, lake = f"{base}/raw/places", f"{base}/raw/reviews", f"{base}/lake"

    def reader(schema):
        return lambda s, paths, root: read_json(s, paths, schema, with_source=True, unit_root=root, with_rejects=True)

    def run():
        """Places, reviews and gold as the raw folders are now."""
        run_versioned(spark, "google_places", raw_places, lake, "google", "places", reader(GOOGLE_PLACES_RAW),
                      lambda b: md.silver_google_places(b, terms=DEMO_TERMS))
        run_versioned(spark, "google_reviews", raw_reviews, lake, "google", "reviews", reader(GOOGLE_REVIEWS_RAW),
                      md.silver_google_reviews)
        places = read_layer(spark, lake, "silver", "google", "places")
        return run_versioned_stage(
            spark, "google_reviews", "google_reviews:gold", lake, "google", ("silver", "reviews"), ("gold", "reviews"),
            lambda r: md.gold_google_reviews(r, places), keys=places, on="gmap_id")

    return raw_places, raw_reviews, lake, run


@query("medallion_gold_late_places", ORACLE["gold_reviews"])
def q_medallion_gold_late_places(spark, sf):
    """All reviews first, then the places in two parts; a place's earlier reviews reach gold with it."""
    raw_places, raw_reviews, lake, run = _versioned_lake(spark, sf, "late")
    _write_units(_reviews_with_unit(spark, sf), raw_reviews)
    places = _places_with_unit(spark, sf)
    late = F.pmod(F.xxhash64("gmap_id"), F.lit(2)) == 0
    for part in (~late, late):
        places.filter(part).write.mode("append").partitionBy("unit").json(raw_places)
        run()
    return read_layer(spark, lake, "gold", "google", "reviews").drop("source_file")


@query("medallion_changed_units", ORACLE["gold_reviews"])
def q_medallion_changed_units(spark, sf):
    """A unit that grows and one that is withdrawn; the layers are those of one run over the last state."""
    raw_places, raw_reviews, lake, run = _versioned_lake(spark, sf, "changed")
    _write_units(_places_with_unit(spark, sf), raw_places)
    reviews = _reviews_with_unit(spark, sf)
    first = F.pmod(F.xxhash64("time"), F.lit(3)) > 0
    _write_units(reviews.filter(first).unionByName(reviews.withColumn("unit", F.lit("state_gone"))), raw_reviews)
    run()
    reviews.filter(~first).write.mode("append").partitionBy("unit").json(raw_reviews)
    remove_path(spark, f"{raw_reviews}/unit=state_gone")
    run()
    return read_layer(spark, lake, "gold", "google", "reviews").drop("source_file")


_PROFILE_COLUMNS = [("user_id", "string"), ("gmap_id", "string"), ("rating", "double"), ("text", "string"), ("time", "bigint")]


@query("layer_attribute_growth", f"""WITH {PL_SQL}
SELECT gmap_id, CASE WHEN state IN ('WV', 'OR') THEN NULL ELSE wifi END AS wifi, hastv,
       CASE WHEN state IN ('WV', 'OR') THEN dogsallowed END AS dogsallowed
FROM pl""")
def q_layer_attribute_growth(spark, sf):
    """Units of a later run bring an attribute and lack another; the layer reads back with all of them."""
    base = scratch_path(spark, "attributes")
    raw, lake = f"{base}/raw", f"{base}/lake"
    places = dv.places_raw(spark, sf).select("gmap_id", "state", "attributes")
    later = F.col("state").isin("WV", "OR")
    for rows, names in ((places.filter(~later), ["WiFi", "HasTV"]), (places.filter(later), ["HasTV", "DogsAllowed"])):
        attributes = F.struct(*[F.col(f"attributes.{n}").alias(n) for n in names])
        units = rows.select("gmap_id", attributes.alias("attributes"), F.col("state").alias("unit"))
        units.write.mode("append").partitionBy("unit").json(raw)
        schema = units.drop("unit").schema
        run_versioned(spark, "places", raw, lake, "google", "places",
                      lambda s, paths, root, schema=schema: read_json(s, paths, schema, with_source=True, unit_root=root),
                      lambda b: b)
    a = read_layer(spark, lake, "silver", "google", "places")
    return a.select("gmap_id", *[F.col(f"attributes.{n}").alias(n.lower()) for n in ("WiFi", "HasTV", "DogsAllowed")])


@query("stream_silver_reviews", ORACLE["silver_google_reviews"])
def q_stream_silver_reviews(spark, sf):
    """Streaming bronze and silver; a second run brings the rest and copies of rows that the state already knows."""
    base = scratch_path(spark, "stream-layers")
    raw, lake = f"{base}/raw", f"{base}/lake"
    reviews = _reviews_with_unit(spark, sf)
    first = F.pmod(F.xxhash64("user_id", "time"), F.lit(3)) > 0
    for rows in (reviews.filter(first), reviews.filter(~first).unionByName(reviews.filter("rating > 2"))):
        # compressed files are read whole: bounded in rows, so that no task and no batch gets much more than another
        rows.write.mode("append").option("maxRecordsPerFile", 500_000).partitionBy("unit").json(raw, compression="gzip")
        stream_layers(spark, "google_reviews", raw, GOOGLE_REVIEWS_RAW, lake, "google", "reviews",
                      f"{base}/_checkpoint", md.silver_google_reviews, dedup_columns=GOOGLE_REVIEWS_RAW.fieldNames())
    return read_layer(spark, lake, "silver", "google", "reviews").drop("source_file")


@query("dictionary_filter", f"""WITH {PL_SQL},
t AS (SELECT DISTINCT lower(p_name || ', ' || p_type) AS term FROM part WHERE p_size < 4),
x AS (SELECT DISTINCT lower(categories) AS text FROM pl),
h AS (SELECT DISTINCT text FROM x JOIN t ON contains(text, term)
      WHERE regexp_matches(text, '\\b' || regexp_escape(term) || '\\b'))
SELECT place_id, categories FROM pl WHERE lower(categories) IN (SELECT text FROM h)""")
def q_dictionary_filter(spark, sf):
    """places whose categories hold an entry of a list that grows with the data: names and types of the smallest parts."""
    part = dv.table(spark, sf, "part").filter("p_size < 4")
    terms = part.select(F.concat("p_name", F.lit(", "), "p_type").alias("term"))
    return filter_dictionary(dv.places_raw(spark, sf), "categories", terms).select("place_id", "categories")


@query("layer_profile", f"""WITH {RV_SQL}
{" UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, "
                    f"count({c}) AS non_null, count(*) - count({c}) AS nulls, TRUE AS distinct_in_bounds FROM rv"
                    for i, (c, t) in enumerate(_PROFILE_COLUMNS))}""")
def q_layer_profile(spark, sf):
    """Bronze reviews profiled unit by unit over two runs (a new, a grown and a withdrawn unit), then merged.

    ``distinct_in_bounds``: the merged estimate lies between 1 and the non-null rows, five standard errors allowed.
    """
    _, raw_reviews, lake, _ = _versioned_lake(spark, sf, "profile")
    reviews = _reviews_with_unit(spark, sf)
    first = F.pmod(F.xxhash64("time"), F.lit(3)) > 0

    def run():
        run_versioned(spark, "google_reviews", raw_reviews, lake, "google", "reviews",
                      lambda s, paths, root: read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root),
                      md.silver_google_reviews)
        run_profile(spark, "google_reviews", lake, "google", ("bronze", "reviews"))

    _write_units(reviews.filter(first).unionByName(reviews.withColumn("unit", F.lit("state_gone"))), raw_reviews)
    run()
    reviews.filter(~first).write.mode("append").partitionBy("unit").json(raw_reviews)
    remove_path(spark, f"{raw_reviews}/unit=state_gone")
    run()
    prof = layer_profile(spark, lake, "google", ("bronze", "reviews"))
    bound = F.col("non_null") * (1 + 5 * DISTINCT_ERROR)
    return prof.select("ordinal", "column_name", "data_type", "rows", "non_null", "nulls",
                       F.col("distinct_values").between(F.lit(1), bound).alias("distinct_in_bounds"))


@query("silver_reviews_global_dedup", ORACLE["silver_google_reviews"])
def q_silver_reviews_global_dedup(spark, sf):
    """Copies of rows in units of different runs; each row stays once, by an index of row hashes."""
    base = scratch_path(spark, "dedup")
    raw, lake = f"{base}/raw", f"{base}/lake"
    li = dv.reviews_raw(spark, sf)
    units = li.withColumn("unit", F.concat(F.lit("part_"), F.pmod(F.xxhash64("user_id", "time"), F.lit(3))))

    def reader(s, paths, root):
        return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root, with_rejects=True)

    for rows in (units.filter("unit <> 'part_2'"), units.filter("unit = 'part_2'").unionByName(
            units.filter("rating > 2").withColumn("unit", F.lit("part_copies")))):
        rows.write.mode("append").partitionBy("unit").json(raw)
        run_versioned(spark, "google_reviews", raw, lake, "google", "reviews", reader, md.silver_google_reviews,
                      dedup_columns=GOOGLE_REVIEWS_RAW.fieldNames())
    return read_layer(spark, lake, "silver", "google", "reviews").drop("source_file")


@query("load_append", ORACLE["load_by_ordinal"])
def q_load_append(spark, sf):
    """Two loads into one table; a repeated one, and one that holds a loaded key, are refused."""
    path, places = scratch_path(spark, "append"), gold_places(spark, sf)
    half = F.pmod(F.xxhash64("gmap_id"), F.lit(2)) == 0
    append_table(places.filter(half), "business_google", path)
    for again in (places.filter(half), places):
        try:
            append_table(again, "business_google", path)
        except LoadError:
            continue
        if not again.isEmpty():
            raise AssertionError("a loaded key was loaded again")
    return append_table(places.filter(~half), "business_google", path)


@query("medallion_sentiment_reviews", None)
def q_medallion_sentiment_reviews(spark, sf):
    """End to end: gold reviews -> sentiment stage by unit, written and read back."""
    lake = _google_gold(spark, sf)
    lex = lexicon_frame(spark, REVIEW_LEXICON)
    for _ in range(2):
        run_stage(spark, "google_reviews:gold", "google_reviews:sentiment", lake, "google", ("gold", "reviews"),
                  ("gold", "sentiment"), lambda r: sentiment_table(r, lex, round_to=6, negators=None, keep=["source_file"]))
    return read_layer(spark, lake, "gold", "google", "sentiment").drop("source_file")


@query("ledger_append", f"""SELECT DISTINCT 'google_places' AS dataset, 'unit=type_' || lower(p_type) AS file_name FROM part
UNION ALL SELECT DISTINCT 'google_reviews', 'unit=state_' || l_returnflag FROM lineitem""")
def q_ledger_append(spark, sf):
    """Ledger after two runs - every unit exactly once."""
    _, lake = _google_lake(spark, sf)
    return read_ledger(spark, f"{lake}/_ledger")


@query("ledger_new_files", """SELECT DISTINCT 'unit=state_' || l_returnflag AS file_name FROM lineitem
WHERE l_returnflag <> 'A'""")
def q_ledger_new_files(spark, sf):
    """Listed units minus the ledger (one unit recorded)."""
    base = scratch_path(spark, "ledger")
    raw = f"{base}/raw"
    _write_units(_reviews_with_unit(spark, sf), raw)
    append_ledger(spark, f"{base}/_ledger", "google_reviews", ["unit=state_A"])
    return new_units(list_units(spark, raw), read_ledger(spark, f"{base}/_ledger", "google_reviews"))


_EV_SCHEMA = "event_id long, user_id long, event_type string, value double, props string, time long"


@query("ingest_available_now", f"""WITH {EV_SQL}
SELECT event_id, user_id, event_type, value, time, CAST(epoch_ms(time) AS DATE) AS date FROM ev""")
def q_ingest_available_now(spark, sf):
    """Structured Streaming availableNow ingest; a rerun adds nothing."""
    from pyspark.sql.types import StructType

    base = scratch_path(spark, "stream")
    src, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/_checkpoint"
    dv.events_raw(spark, sf).write.json(src)
    schema = StructType.fromDDL(_EV_SCHEMA)

    def transform(s):
        return s.select("event_id", "user_id", "event_type", "value", "time",
                        epoch_ms_to_date("time").alias("date"))

    for _ in range(2):
        ingest_available_now(spark, src, schema, out, ckpt, transform)
    return spark.read.parquet(out)


@query("sentiment_lexicon_file", f"WITH {_SCORE_SIMPLE_SQL} SELECT * FROM score")
def q_sentiment_lexicon_file(spark, sf):
    """L2: the lexicon read from a tab-separated file, then R2/L3."""
    path = scratch_path(spark, "lexicon")
    lexicon_frame(spark, DEMO_LEXICON).coalesce(1).write.option("sep", "\t").csv(path)
    lex = read_lexicon(spark, path)
    return sentiment_scores(dv.texts(spark, sf), lex, round_to=6)


# Words of the derived review texts ("flag X status Y"), so that scores differ.
REVIEW_LEXICON = [("flag", 0.4), ("status", -0.2), ("r", 1.6), ("a", -1.9), ("n", 0.8), ("o", 2.1), ("f", -1.3),
                  ("unknown", -0.1)]

# the gold rows are numbered before they are scored: their key repeats
_SENTIMENT_GOLD_SQL = f"""WITH {silver_places_sql()},
{silver_reviews_sql()},
lex AS (SELECT * FROM {_values(REVIEW_LEXICON, 'l(token, valence)')}),
tx AS (SELECT row_number() OVER () AS rid, user_id || gmap_id AS review_id, substring(text, 1, 7000) AS text
       FROM gsr WHERE gmap_id IN (SELECT gmap_id FROM gsp)),
toks AS (SELECT rid, unnest({TOKENS_SQL}) AS token FROM tx),
sums AS (SELECT rid, sum(coalesce(valence, 0)) AS s FROM toks LEFT JOIN lex ON toks.token = lex.token GROUP BY rid),
score AS (SELECT review_id, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 6) + 0.0 AS sentiment_score
          FROM tx LEFT JOIN sums ON tx.rid = sums.rid)
SELECT review_id, sentiment_score, {_LABEL_SQL} AS sentiment FROM score"""


ORACLE["medallion_sentiment_reviews"] = _SENTIMENT_GOLD_SQL


@query("sentiment_gold_reviews", _SENTIMENT_GOLD_SQL)
def q_sentiment_gold_reviews(spark, sf):
    """R3 on the gold reviews: one sentiment row per review, though keys repeat."""
    keys = md.silver_google_place_keys(dv.places_raw(spark, sf), terms=DEMO_TERMS)
    gold = md.gold_google_reviews(silver_reviews(spark, sf), keys)
    return sentiment_table(gold, lexicon_frame(spark, REVIEW_LEXICON), round_to=6, negators=None)


@query("dim_state", f"""WITH {silver_places_sql()},
c AS (SELECT state, count(*) AS places FROM gsp GROUP BY state)
SELECT dim_state.state_id, dim_state.code AS state, dim_state.sname AS name, coalesce(c.places, 0) AS places
FROM {STATE_VALUES_SQL} LEFT JOIN c ON dim_state.code = c.state""")
def q_dim_state(spark, sf):
    """The 50-row state dimension (identity key 1..50) with the
    number of silver places per state; the dimension is the preserved side
    and is small by construction, the place counts come from a partial
    aggregate."""
    counts = silver_places(spark, sf).groupBy("state").agg(F.count(F.lit(1)).alias("places"))
    dim = state_dimension(spark)
    return (dim.join(counts, "state", "left")
               .select("state_id", "state", "name", F.coalesce("places", F.lit(0)).alias("places")))


def _yelp_lake(spark, sf, with_reviews: bool):
    """Yelp business units as Parquet (and reviews units as JSON), then two
    incremental runs of each through the ledger."""
    base = scratch_path(spark, "yelp")
    raw_b, raw_r, lake = f"{base}/raw/business", f"{base}/raw/reviews", f"{base}/lake"
    yb = dv.yelp_business_raw(spark, sf)
    yb.withColumn("unit", F.concat(F.lit("part_"), F.col("categories").substr(1, 1))) \
      .write.partitionBy("unit").parquet(raw_b)

    def business_reader(s, paths, root):
        return read_parquet(s, paths, columns=yb.columns, with_source=True, unit_root=root)

    def reviews_reader(s, paths, root):
        return read_json(s, paths, YELP_REVIEWS_RAW, with_source=True, unit_root=root, with_rejects=True)

    if with_reviews:
        yr = dv.yelp_reviews_raw(spark, sf)
        yr.withColumn("unit", F.concat(F.lit("year_"), F.col("date").substr(1, 4))) \
          .write.partitionBy("unit").json(raw_r)
    for _ in range(2):
        run_incremental(spark, "yelp_business", raw_b, lake, "yelp", "business", business_reader,
                        lambda b: md.silver_yelp_business(b, terms=DEMO_TERMS))
        if with_reviews:
            run_incremental(spark, "yelp_reviews", raw_r, lake, "yelp", "reviews", reviews_reader,
                            md.silver_yelp_reviews)
    return lake


@query("medallion_yelp_business", f"WITH {_YB_SILVER_SQL} SELECT * FROM ysb")
def q_medallion_yelp_business(spark, sf):
    """S2/S8/I2 with a Parquet raw source: Yelp business units -> bronze ->
    silver through the ledger (two runs), read back."""
    lake = _yelp_lake(spark, sf, with_reviews=False)
    return read_layer(spark, lake, "silver", "yelp", "business").drop("source_file")


@query("medallion_gold_yelp_reviews", ORACLE["gold_yelp_reviews"])
def q_medallion_gold_yelp_reviews(spark, sf):
    """End to end for Yelp: incremental silver business (Parquet units) and
    reviews (JSON units, unit = year of the date text) -> gold reviews."""
    lake = _yelp_lake(spark, sf, with_reviews=True)
    business = md.gold_yelp_business(read_layer(spark, lake, "silver", "yelp", "business"))
    for _ in range(2):
        run_stage(spark, "yelp_reviews", "yelp_reviews:gold", lake, "yelp", ("silver", "reviews"),
                  ("gold", "reviews"), lambda r: md.gold_yelp_reviews(r, business))
    return read_layer(spark, lake, "gold", "yelp", "reviews").drop("source_file")


@query("load_totals_sql", f"""WITH {silver_places_sql()},
{silver_reviews_sql()}
SELECT 'business_google' AS table_name, count(*) AS total FROM gsp
UNION ALL SELECT 'reviews_google', count(*) FROM gsr WHERE gmap_id IN (SELECT gmap_id FROM gsp)""")
def q_load_totals_sql(spark, sf):
    """A3/S15 through the SQL API: the loaded tables as temporary views and
    ``SELECT COUNT(*) AS total`` on each (loaded count = source count)."""
    import uuid

    tag = uuid.uuid4().hex[:8]
    places = gold_places(spark, sf)
    reviews = md.gold_google_reviews(silver_reviews(spark, sf), places)
    base = scratch_path(spark, "warehouse")
    load_table(places, "business_google", f"{base}/business").createOrReplaceTempView(f"business_google_{tag}")
    load_table(reviews, "reviews_google", f"{base}/reviews").createOrReplaceTempView(f"reviews_google_{tag}")
    return spark.sql(f"""
        SELECT 'business_google' AS table_name, COUNT(*) AS total FROM business_google_{tag}
        UNION ALL
        SELECT 'reviews_google' AS table_name, COUNT(*) AS total FROM reviews_google_{tag}""")


@query("silver_reviews_hash_dedup", f"""WITH {silver_reviews_sql()} SELECT * FROM gsr""")
def q_silver_reviews_hash_dedup(spark, sf):
    """F8 at scale: the review dedup with the row-hash prefilter - only rows
    whose hash repeats are shuffled; same rows as the plain dedup."""
    return md.silver_google_reviews(dv.reviews_raw(spark, sf), hash_prefilter=True)


# The contrast rule needs a contrast word that occurs in the test corpus (the
# invented English prose has no "but"); "and" stands in for it here.
DEMO_CONTRAST = "and"

_SCORE_FULL_SQL = _score_rules_sql(contrast=DEMO_CONTRAST, punctuation=True)


@query("sentiment_score_compound", f"WITH {_SCORE_FULL_SQL} SELECT * FROM score")
def q_sentiment_score_compound(spark, sf):
    """R2 closer to the published compound score: L4 rules plus the
    contrast-word rule and '!'/'?' emphasis."""
    lex = lexicon_frame(spark, DEMO_LEXICON)
    return sentiment_scores(dv.texts(spark, sf), lex, round_to=6, negators=DEMO_NEGATORS,
                            boosters=DEMO_BOOSTERS, contrast=DEMO_CONTRAST, punctuation=True)


# Phrases, a booster and a negator of several words, and chunks of signs that
# occur in the documents; some overlap, so that the longest must win.
DEMO_IDIOMS = [("the and", 1.7), ("and the", -0.6), ("and the of", 2.2), ("of the", 0.8), ("for the the", -1.9)]
DEMO_SIGNS = [("+1", 1.3), ("2.0.", -0.7)]
DEMO_PHRASE_BOOSTERS = DEMO_BOOSTERS + [("to a", -0.293)]
DEMO_PHRASE_NEGATORS = DEMO_NEGATORS + ["on the"]

# Oracle: chunks of signs by white space, then one alternation of all phrases, the longest first.
_SIGN_SQL = (r"((regexp_full_match(c, '[^\pL\p{Cc}\x20]{2,}') AND regexp_matches(c, '[^\pL\pN]'))"
             r" OR regexp_full_match(c, '[:;=%|][-^''*]?\pL'))")
_CHUNK_TOKENS_SQL = (r"flatten([CASE WHEN " + _SIGN_SQL + r" THEN [c] ELSE regexp_extract_all(c, '\pL+(?:''\pL+)*') END"
                     r" FOR c IN regexp_split_to_array(lower(replace(text, chr(8217), '''')), '[\x09-\x0D\x20]+')])")


def _phrase_tokens_sql() -> str:
    several = sorted({w for w, _ in DEMO_IDIOMS + DEMO_PHRASE_BOOSTERS} | set(DEMO_PHRASE_NEGATORS),
                     key=lambda w: (-len(w.split()), w))
    either = "|".join(" " + w.replace(" ", "  ") + " " for w in several if " " in w)
    marked = (f"regexp_replace(' ' || array_to_string({_CHUNK_TOKENS_SQL}, '  ') || ' ', '({either})', "
              r"chr(1) || '\1' || chr(2), 'g')")
    parts = f"regexp_extract_all({marked}, " + r"'\x01[^\x02]*\x02| [^ \x01\x02]+ ')"
    return f"[replace(trim(p, chr(1) || chr(2) || ' '), '  ', ' ') FOR p IN {parts}]"


@query("sentiment_score_phrases", "WITH " + _score_rules_sql(
    contrast=DEMO_CONTRAST, punctuation=True, tokens_sql=_phrase_tokens_sql(),
    lexicon=DEMO_LEXICON + DEMO_SIGNS + DEMO_IDIOMS, negators=DEMO_PHRASE_NEGATORS, boosters=DEMO_PHRASE_BOOSTERS,
    special_cases=True) + " SELECT * FROM score")
def q_sentiment_score_phrases(spark, sf):
    """R2/L4 with entries of several words as single tokens, chunks of signs
    as emoticons, and the "never so" and "least" cases."""
    lex = lexicon_frame(spark, DEMO_LEXICON + DEMO_SIGNS)
    return sentiment_scores(dv.texts(spark, sf), lex, round_to=6, negators=DEMO_PHRASE_NEGATORS,
                            boosters=DEMO_PHRASE_BOOSTERS, contrast=DEMO_CONTRAST, punctuation=True,
                            idioms=DEMO_IDIOMS, emoticons=True, special_cases=True)
