"""SQL fragments shared by the oracle queries (DuckDB dialect).

Built from the same fixed value lists as the Spark side; the logic in each
oracle query is written out in SQL.
"""

from __future__ import annotations

from plazalens.functions.text import state_pattern, term_pattern
from plazalens.plans.derived import PL_SQL, RV_SQL
from plazalens.schemas import US_STATES

# Category terms used on the derived places (part names are not food words).
DEMO_TERMS = ["ring", "bolt", "gear"]


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STATE_RE_SQL = sql_str(state_pattern())
DEMO_TERMS_RE_SQL = sql_str(term_pattern(DEMO_TERMS))
STATE_VALUES_SQL = "(VALUES " + ", ".join(
    f"({i}, {sql_str(code)}, {sql_str(name)})" for i, (name, code) in enumerate(US_STATES, start=1)
) + ") AS dim_state(state_id, code, sname)"


def silver_places_sql(terms_re: str = DEMO_TERMS_RE_SQL) -> str:
    """CTEs pl, gp_b, gp_f, gp_s, gsp (silver places) over the derived places."""
    return f"""{PL_SQL},
gp_b AS (
  SELECT DISTINCT address, avg_rating, gmap_id, latitude, longitude, name, num_of_reviews, url,
         coalesce(array_to_string(category, ', '), '') AS category
  FROM pl),
gp_f AS (
  SELECT coalesce(address, 'Unknown') AS address, avg_rating, gmap_id, latitude, longitude,
         coalesce(name, 'Unknown') AS name, num_of_reviews, url, category
  FROM gp_b
  WHERE avg_rating IS NOT NULL AND gmap_id IS NOT NULL AND latitude IS NOT NULL
    AND longitude IS NOT NULL AND num_of_reviews IS NOT NULL AND category IS NOT NULL
    AND category <> '' AND regexp_matches(lower(category), {terms_re})),
gp_s AS (
  SELECT gp_f.*,
         CASE WHEN regexp_matches(address, {STATE_RE_SQL})
              THEN regexp_extract(address, {STATE_RE_SQL}, 0) ELSE 'Unknown' END AS state_raw
  FROM gp_f),
gsp AS (
  SELECT address, avg_rating, gmap_id, latitude, longitude, name, num_of_reviews, url, category,
         coalesce(dim_state.code, gp_s.state_raw) AS state
  FROM gp_s LEFT JOIN {STATE_VALUES_SQL} ON gp_s.state_raw = dim_state.sname)"""


def silver_reviews_sql() -> str:
    """CTEs rv, gr_d, gsr (silver reviews) over the derived reviews."""
    return f"""{RV_SQL},
gr_d AS (SELECT DISTINCT user_id, gmap_id, rating, text, time FROM rv),
gsr AS (
  SELECT user_id, gmap_id, coalesce(rating, 0) AS rating, coalesce(text, 'Unknown') AS text,
         CAST(epoch_ms(time) AS DATE) AS date
  FROM gr_d
  WHERE user_id IS NOT NULL AND gmap_id IS NOT NULL AND time IS NOT NULL)"""
