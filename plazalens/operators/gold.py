"""Gold layer: reviews restricted to known places, typed, cut, keyed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.operators.clean import to_int_rating
from plazalens.operators.join import restrict_to_keys
from plazalens.schemas import GOLD_TEXT_MAX


def review_key(*cols: str, sep: str | None = None) -> Column:
    """Composite key (P9, X3): ``concat`` of the parts; null if any part is null.

    ``sep=None`` matches the reference (no separator, so keys can collide:
    D11); pass a separator for unambiguous keys.
    """
    parts = [F.col(c) for c in cols]
    if sep is not None:
        parts = [x for p in parts for x in (p, F.lit(sep))][:-1]
    return F.concat(*parts)


def _with_unit(df: DataFrame) -> list[str]:
    return ["source_file"] if "source_file" in df.columns else []


def gold_google_reviews(reviews: DataFrame, places: DataFrame, how: str = "left_semi",
                        max_text: int = GOLD_TEXT_MAX) -> DataFrame:
    """Google reviews gold table.

    ``how="left_semi"`` (default) keeps each review once, whatever the places
    table holds; ``how="inner"`` is the reference's inner join, which repeats
    a review for every copy of its place key (D10).
    """
    if how == "left_semi":
        kept = restrict_to_keys(reviews, places, "gmap_id")
    elif how == "inner":
        kept = reviews.join(places.select("gmap_id"), "gmap_id", "inner")
    else:
        raise ValueError("how must be 'left_semi' or 'inner'")
    return kept.select(
        "user_id",
        "gmap_id",
        to_int_rating("rating").alias("rating"),
        F.substring("text", 1, max_text).alias("text"),
        "date",
        review_key("user_id", "gmap_id").alias("review_id"),
        *_with_unit(kept),
    )


def gold_yelp_reviews(reviews: DataFrame, business: DataFrame, how: str = "left_semi",
                      max_text: int = GOLD_TEXT_MAX) -> DataFrame:
    """Yelp reviews gold table: same steps keyed by ``business_id``."""
    if how == "left_semi":
        kept = restrict_to_keys(reviews, business, "business_id")
    elif how == "inner":
        kept = reviews.join(business.select("business_id"), "business_id", "inner")
    else:
        raise ValueError("how must be 'left_semi' or 'inner'")
    return kept.select(
        "review_id",
        "user_id",
        "business_id",
        to_int_rating("stars").alias("rating"),
        F.substring("text", 1, max_text).alias("text"),
        "date",
        *_with_unit(kept),
    )


def gold_places(places: DataFrame, count_col: str) -> DataFrame:
    """Gold places: the review count as int, everything else unchanged."""
    return places.withColumn(count_col, F.col(count_col).cast("int"))
