"""Place recommendation: most similar and nearest places.

The reference answers one request at a time: it filters places by state and
category (case-insensitive regex) and a rating floor, builds the full n x n
cosine matrix (or a k-NN index) and uses only row 0. Here the work is O(n)
per request and all requests run as one job:

1. equal requests are one pattern pair (state, category); distinct states are
   matched with the distinct state patterns, and places join the matches on
   state equality; category regex and rating floor are row filters;
2. one candidate per place id and pattern, with its features only (a partial
   aggregate): every later step is narrow, and a place without a feature is
   no candidate;
3. anchor = first candidate by id, with the features of that very row;
4. score against the anchor by column arithmetic, anchors broadcast (one
   row per pattern, the request table being size-checked);
5. top k on the full score with ``row_number() <= k``, which Spark plans with
   a per-partition group limit before the shuffle; then the returned columns
   are joined to those rows, and the answers to the requests' ids.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plazalens.operators.join import is_small

REQUESTS_MAX_ROWS = 100_000
STATES_MAX_ROWS = 100_000
GROUPS_MAX_ROWS = 10_000  # anchors are broadcast with their vectors
FEATURES_SIMILAR = ("latitude", "longitude", "avg_rating", "review_count")
FEATURES_NEARBY = ("latitude", "longitude")
RETURN_COLUMNS = ("place_id", "name", "address", "avg_rating", "categories", "attributes")


def requests_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """(query_id, state, category, error) request table from literal rows.

    ``error`` says why a pattern is no regular expression (null for a good
    request); such a request selects nothing and the others are answered.
    """
    pattern = spark._jvm.java.util.regex.Pattern

    def error(*texts: str | None) -> str | None:
        for t in texts:
            try:
                pattern.compile(t or "")
            except IllegalArgumentException as e:
                return str(e).splitlines()[0]
        return None

    return spark.createDataFrame([(int(q), s, c, error(s, c)) for q, s, c in rows],
                                 "query_id long, state string, category string, error string")


def _patterns(requests: DataFrame) -> DataFrame:
    """Distinct (state, category) patterns of the valid requests."""
    if "error" in requests.columns:
        requests = requests.filter("error IS NULL")
    return requests.select(F.col("state").alias("_rs"), F.col("category").alias("_rc")).na.drop().distinct()


def _select(places: DataFrame, requests: DataFrame, min_rating: float, state_col: str, category_col: str,
            rating_col: str, bounded: bool) -> DataFrame:
    """(_rs, _rc, place columns) for every place that a pattern pair selects.

    The regular expressions of states meet the distinct state names only; the
    matches are then an equality join. One side of that small nested loop is
    always broadcast: the patterns when the request table passed its size
    check, otherwise the distinct states.
    """
    kept = places.filter(F.col(rating_col) >= F.lit(min_rating))
    patterns = _patterns(requests)
    names = kept.select(F.col(state_col).alias("_state")).na.drop().distinct()
    wanted = patterns.select("_rs").distinct()
    if bounded:
        parts = [F.broadcast(wanted)]
    elif is_small(names, STATES_MAX_ROWS):
        names = F.broadcast(names)
        parts = [wanted]
    else:  # the patterns in parts of a bounded size, each broadcast to the names
        n = max(1, -(-wanted.count() // max(1, REQUESTS_MAX_ROWS)))
        parts = [F.broadcast(wanted.filter(F.pmod(F.xxhash64("_rs"), F.lit(n)) == i)) for i in range(n)]
    met = [names.join(p, F.expr("_state RLIKE ('(?i)' || _rs)")) for p in parts]
    pairs = functools.reduce(DataFrame.unionByName, met).join(patterns, "_rs")
    joined = kept.join(pairs, kept[state_col] == pairs["_state"])
    return joined.filter(F.expr(f"`{category_col}` RLIKE ('(?i)' || _rc)")).drop("_state")


def candidates(places: DataFrame, requests: DataFrame, min_rating: float = 4.0,
               state_col: str = "state", category_col: str = "categories",
               rating_col: str = "avg_rating", bounded: bool | None = None) -> DataFrame:
    """(query_id, place columns) for every place a request selects.

    Both patterns are case-insensitive regex searches, as in the reference;
    a null state or category never matches.
    """
    if bounded is None:
        bounded = requests_bounded(requests)
    found = _select(places, requests, min_rating, state_col, category_col, rating_col, bounded)
    return _to_requests(found, requests, bounded, places.columns)


def _to_requests(found: DataFrame, requests: DataFrame, bounded: bool, columns: Sequence[str]) -> DataFrame:
    """The rows of a pattern pair for each request that asks it."""
    asked = requests.select("query_id", F.col("state").alias("_rs"), F.col("category").alias("_rc"))
    if bounded:
        asked = F.broadcast(asked)
    return found.join(asked, ["_rs", "_rc"]).select("query_id", *columns)


def requests_bounded(requests: DataFrame) -> bool:
    """True when the request table passes the broadcast size check; then
    every per-request table (anchors, statistics) is bounded by it too."""
    return is_small(requests, REQUESTS_MAX_ROWS)


def _norm(cols: Sequence[Column]) -> Column:
    acc = None
    for c in cols:
        acc = c * c if acc is None else acc + c * c
    return F.sqrt(acc)


def _dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    acc = None
    for x, y in zip(a, b):
        acc = x * y if acc is None else acc + x * y
    return acc


def cosine(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Cosine similarity of two feature lists; a zero vector gives 0."""
    na, nb = _norm(a), _norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(_dot(a, b) / (na * nb))


def euclidean(a: Sequence[Column], b: Sequence[Column]) -> Column:
    acc = None
    for x, y in zip(a, b):
        d = (x - y) * (x - y)
        acc = d if acc is None else acc + d
    return F.sqrt(acc)


PATTERN = ["_rs", "_rc"]


def _narrow(found: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
    """One row (pattern, id, features as doubles) per place id: of repeated ids the smallest features."""
    values = F.struct(*[F.col(f).cast("double").alias(f) for f in features])
    one = (found.select(*PATTERN, id_col, values.alias("_f")).filter(
        " AND ".join(f"_f.`{f}` IS NOT NULL" for f in features)).groupBy(*PATTERN, id_col).agg(F.min("_f").alias("_f")))
    return one.select(*PATTERN, id_col, *[F.col(f"_f.{f}").alias(f) for f in features])


def _with_anchor(cand: DataFrame, features: Sequence[str], id_col: str, bounded: bool) -> DataFrame:
    # ids are unique per pattern here, so every min_by takes the same row; one
    # per scalar feature keeps the aggregate hash-based
    anchors = cand.groupBy(*PATTERN).agg(
        *[F.min_by(F.col(f), F.col(id_col)).alias(f) for f in features], F.min(F.col(id_col)).alias("_aid"))
    anchors = anchors.select(*PATTERN, F.struct(*features, "_aid").alias("_a"))
    # one row per pattern: bounded by the request table, whose size was
    # checked by the caller; a larger request table is left to AQE
    return cand.join(F.broadcast(anchors) if bounded else anchors, PATTERN)


def _answers(scored: DataFrame, places: DataFrame, requests: DataFrame, k: int, score: str, ascending: bool,
             id_col: str, out_cols: Sequence[str], round_to: int | None, bounded: bool,
             min_rating: float, rating_col: str = "avg_rating") -> DataFrame:
    """Top k of each pattern by the full score, its returned columns, and a copy for each request."""
    order = F.col(score).asc() if ascending else F.col(score).desc()
    w = Window.partitionBy(*PATTERN).orderBy(order, F.col(id_col).asc())
    top = scored.select(*PATTERN, id_col, score).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    if bounded:
        top = F.broadcast(top)  # k rows per pattern
    rest = [c for c in out_cols if c != id_col]
    rows = places.filter(F.col(rating_col) >= F.lit(min_rating)).select(id_col, *rest).join(top, id_col)
    rows = rows.groupBy(*PATTERN, "rank", id_col, score).agg(F.min(F.struct(*rest)).alias("_r"))
    value = F.col(score) if round_to is None else F.round(score, round_to) + F.lit(0.0)  # + 0.0: no -0.0
    rows = rows.select(*PATTERN, "rank", id_col, *[F.col(f"_r.{c}").alias(c) for c in rest], value.alias(score))
    return _to_requests(rows, requests, bounded, ["rank", *out_cols, score])


def recommend_similar(places: DataFrame, requests: DataFrame, k: int = 5, min_rating: float = 4.0,
                      features: Sequence[str] = FEATURES_SIMILAR, id_col: str = "place_id",
                      out_cols: Sequence[str] = RETURN_COLUMNS, round_to: int | None = 6,
                      scale: str | None = None) -> DataFrame:
    """Top ``k`` places by cosine similarity to each request's anchor.

    The anchor (smallest id) is included, as in the reference. Features are
    used unscaled by default (D17); ``scale="standard"`` standardises each
    feature over the request's candidates first. Ranks follow the full
    similarity; ``round_to`` rounds the reported one.
    """
    bounded = requests_bounded(requests)
    found = _select(places, requests, min_rating, "state", "categories", "avg_rating", bounded)
    cand = _narrow(found, features, id_col)
    if scale == "standard":
        stats = cand.groupBy(*PATTERN).agg(
            *[F.avg(f).alias(f"_m_{f}") for f in features],
            *[F.stddev_pop(f).alias(f"_s_{f}") for f in features])
        cand = cand.join(F.broadcast(stats) if bounded else stats, PATTERN)
        cand = cand.select(*PATTERN, id_col, *[
            F.when(F.col(f"_s_{f}") > 0, (F.col(f) - F.col(f"_m_{f}")) / F.col(f"_s_{f}")).otherwise(F.lit(0.0)).alias(f)
            for f in features])
    cand = _with_anchor(cand, features, id_col, bounded)
    sim = cosine([F.col(f) for f in features], [F.col(f"_a.{f}") for f in features])
    return _answers(cand.withColumn("similarity", sim), places, requests, k, "similarity", False, id_col, out_cols,
                    round_to, bounded, min_rating)


def recommend_nearby(places: DataFrame, requests: DataFrame, k: int = 5, min_rating: float = 4.0,
                     features: Sequence[str] = FEATURES_NEARBY, id_col: str = "place_id",
                     out_cols: Sequence[str] = RETURN_COLUMNS, round_to: int | None = 6
                     ) -> DataFrame:
    """The ``k`` places nearest to each request's anchor, anchor excluded.

    The anchor is excluded by id, so a place at the same coordinates is kept
    (D19); fewer than ``k`` candidates return what exists (D18); a place
    without coordinates is no candidate.
    """
    bounded = requests_bounded(requests)
    found = _select(places, requests, min_rating, "state", "categories", "avg_rating", bounded)
    cand = _with_anchor(_narrow(found, features, id_col), features, id_col, bounded)
    dist = euclidean([F.col(f) for f in features], [F.col(f"_a.{f}") for f in features])
    scored = cand.filter(F.col(id_col) != F.col("_a._aid")).withColumn("distance", dist)
    return _answers(scored, places, requests, k, "distance", True, id_col, out_cols, round_to, bounded, min_rating)


def _array_sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def cosine_to_anchor(df: DataFrame, id_col: str, vec_col: str, group_col: str,
                     round_to: int | None = 6) -> DataFrame:
    """Cosine similarity of every vector to the first vector (smallest id) of
    its group (R8 re-aimed).

    The anchor ids are a partial aggregate (a hot group costs one row per
    partition); the anchors join back on the group key - broadcast when the
    groups are proven few, otherwise a shuffle join that AQE splits if a group
    is skewed. Of rows that share the smallest id the smallest vector is the
    anchor. Vector arithmetic uses higher-order array functions, never Python.
    """
    v = df.select(id_col, group_col,
                  F.transform(vec_col, lambda x: x.cast("double")).alias("_v"))
    # anchor ids by a hash aggregate, then the anchor vectors by a join on
    # (group, id): no sort of the vectors, one small row per group
    first = v.groupBy(group_col).agg(F.min(id_col).alias(id_col))
    few = is_small(first, GROUPS_MAX_ROWS)  # then neither join shuffles the vectors
    first = F.broadcast(first) if few else first
    anchors = v.join(first, [group_col, id_col], "left_semi").groupBy(group_col).agg(F.min("_v").alias("_a"))
    j = v.join(F.broadcast(anchors) if few else anchors, group_col)
    dot = _array_sum(F.zip_with("_v", "_a", lambda x, y: x * y))
    na = F.sqrt(_array_sum(F.transform("_v", lambda x: x * x)))
    nb = F.sqrt(_array_sum(F.transform("_a", lambda x: x * x)))
    sim = F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot / (na * nb))
    if round_to is not None:
        sim = F.round(sim, round_to) + F.lit(0.0)  # + 0.0: no -0.0 after rounding
    return j.select(id_col, group_col, sim.alias("similarity"))
