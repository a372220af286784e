"""Bronze -> silver -> gold transforms of the four inputs, as one plan each.

Each function is DataFrame -> DataFrame. Order of steps follows the
reference where the order changes the result: duplicates are removed before
the null fills (a fill can make two rows equal), and the category filter
runs after the fills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.functions.text import extract_state, map_state, matches_terms
from plazalens.operators.clean import (
    dedup_rows,
    drop_blank,
    drop_null,
    epoch_ms_to_date,
    fill_number,
    fill_text,
    text_to_date,
)
from plazalens.operators.gold import gold_google_reviews, gold_places, gold_yelp_reviews
from plazalens.operators.nested import attributes_list
from plazalens.schemas import (
    GOOGLE_CATEGORY_TERMS,
    GOOGLE_PLACES_SILVER_COLUMNS,
    YELP_CATEGORY_TERMS,
)


def _unit(df: DataFrame, unit_col: str | None) -> list[str]:
    return [unit_col] if unit_col and unit_col in df.columns else []


def silver_google_places(raw: DataFrame, terms: Sequence[str] = GOOGLE_CATEGORY_TERMS,
                         state_anchor: str = "first", unit_col: str | None = "source_file"
                         ) -> DataFrame:
    """Google places raw/bronze -> silver.

    category array -> one text; exact duplicates out (per input unit when a
    ``source_file`` column is present, D21); name/address filled; rows without
    key, coordinates, rating, review count or category dropped (empty category
    too, D3); category filter; state from the address, names mapped to codes.
    """
    extra = _unit(raw, unit_col)
    df = raw.select(
        "address", "avg_rating", "gmap_id", "latitude", "longitude", "name",
        "num_of_reviews", "url",
        F.concat_ws(", ", F.col("category")).alias("category"),
        *extra,
    )
    df = dedup_rows(df)
    df = fill_text(df, "Unknown", ["address", "name"])
    df = drop_null(df, ["avg_rating", "gmap_id", "latitude", "longitude", "num_of_reviews", "category"])
    df = drop_blank(df, "category")
    df = df.filter(matches_terms("category", terms))
    df = df.withColumn("state", map_state(extract_state("address", anchor=state_anchor)))
    return df.select(*GOOGLE_PLACES_SILVER_COLUMNS, *extra)


def silver_google_place_keys(raw: DataFrame, terms: Sequence[str] = GOOGLE_CATEGORY_TERMS) -> DataFrame:
    """(gmap_id) of the rows that :func:`silver_google_places` keeps, for semi joins: repeats stay, so no shuffle."""
    df = raw.select("avg_rating", "gmap_id", "latitude", "longitude", "num_of_reviews",
                    F.concat_ws(", ", F.col("category")).alias("category"))
    df = drop_null(df, ["avg_rating", "gmap_id", "latitude", "longitude", "num_of_reviews", "category"])
    return drop_blank(df, "category").filter(matches_terms("category", terms)).select("gmap_id")


def silver_yelp_business_keys(raw: DataFrame, terms: Sequence[str] = YELP_CATEGORY_TERMS) -> DataFrame:
    """(business_id) of the rows that :func:`silver_yelp_business` keeps, for semi joins."""
    df = drop_null(raw.select("business_id", "categories", "state"), ["business_id", "categories", "state"])
    return df.filter(matches_terms("categories", terms)).select("business_id")


def gold_google_places(silver: DataFrame) -> DataFrame:
    return gold_places(silver, "num_of_reviews")


def silver_google_reviews(raw: DataFrame, unit_col: str | None = "source_file",
                          hash_prefilter: bool = False) -> DataFrame:
    """Google reviews raw/bronze -> silver: dedup, fills, key drops, epoch -> date.

    ``hash_prefilter`` routes only rows with a repeated row hash through the
    dedup shuffle (see :func:`dedup_rows`): worth it for long texts at scale.
    """
    extra = _unit(raw, unit_col)
    df = dedup_rows(raw.select("user_id", "gmap_id", "rating", "text", "time", *extra),
                    hash_prefilter=hash_prefilter)
    df = fill_text(df, "Unknown", ["text"])
    df = fill_number(df, 0, ["rating"])
    df = drop_null(df, ["user_id", "gmap_id", "time"])
    return df.select("user_id", "gmap_id", "rating", "text",
                     epoch_ms_to_date("time").alias("date"), *extra)


def silver_yelp_business(raw: DataFrame, terms: Sequence[str] = YELP_CATEGORY_TERMS,
                         strict_parity: bool = False, unit_col: str | None = "source_file"
                         ) -> DataFrame:
    """Yelp business raw/bronze -> silver.

    The attributes struct becomes the list of its 'True' field names as a row
    expression (P7): no generated ids, no positional self-join (D6).
    """
    extra = _unit(raw, unit_col)
    df = raw.select("business_id", "name", "address", "state", "latitude", "longitude",
                    "stars", "review_count", "attributes", "categories", *extra)
    df = dedup_rows(df)
    df = drop_null(df, ["business_id", "categories", "state"])
    df = fill_text(df, "Unknown", ["name", "address"])
    df = fill_number(df, 0, ["latitude", "longitude", "stars", "review_count"])
    df = df.filter(matches_terms("categories", terms))
    df = attributes_list(df, "attributes", strict_parity=strict_parity)
    return df.select("business_id", "name", "address", "state", "latitude", "longitude",
                     F.col("stars").alias("avg_rating"), "review_count", "categories",
                     "attributes", *extra)


def gold_yelp_business(silver: DataFrame) -> DataFrame:
    return gold_places(silver, "review_count")


def silver_yelp_reviews(raw: DataFrame, unit_col: str | None = "source_file",
                        hash_prefilter: bool = False) -> DataFrame:
    """Yelp reviews raw/bronze -> silver: dedup, drop any null, text -> date.

    The date is parsed with ``try_to_date``: text that is not a date becomes
    null instead of failing the job (ANSI mode); the strict load
    (``sources.load.load_table``) refuses such a row.
    """
    extra = _unit(raw, unit_col)
    df = dedup_rows(raw.select("review_id", "user_id", "business_id", "stars", "text", "date", *extra),
                    hash_prefilter=hash_prefilter)
    df = drop_null(df, ["review_id", "user_id", "business_id", "stars", "text", "date"])
    return df.withColumn("date", text_to_date("date"))


__all__ = [
    "silver_google_place_keys", "silver_yelp_business_keys", "silver_google_places", "gold_google_places", "silver_google_reviews",
    "silver_yelp_business", "gold_yelp_business", "silver_yelp_reviews",
    "gold_google_reviews", "gold_yelp_reviews",
]
