"""Hot keys: one place holding a third of all reviews, a heap of identical rows."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from plazalens.operators.clean import dedup_rows
from plazalens.operators.gold import gold_google_reviews
from plazalens.operators.quality import pk_duplicates
from tools.oracle_check import rows_of

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "8",
}


def _reviews(spark, n=3000):
    df = spark.range(n).select(
        F.concat(F.lit("u"), (F.col("id") % 97).cast("string")).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("gmap_id"),
        (F.col("id") % 5).cast("double").alias("rating"),
        F.when(F.col("id") % 7 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
        F.lit(dt.date(2021, 1, 1)).alias("date"),
    )
    return df


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_place_key_semi_join(spark):
    reviews = _reviews(spark)
    places = spark.createDataFrame([("hot",)] + [(f"g{i}",) for i in range(0, 50, 2)], "gmap_id string")

    def run():
        df = gold_google_reviews(reviews, places)
        return rows_of([tuple(r) for r in df.collect()], df.columns)

    expected = run()
    skewed = _with_conf(spark, SKEW_CONF, run)
    assert skewed == expected
    assert len(expected) == 1000 + sum(1 for i in range(3000) if i % 3 and (i % 50) % 2 == 0)


def test_heap_of_identical_rows(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    assert dedup_rows(rows).count() == 2001
    dup = pk_duplicates(rows, ["k"]).collect()
    assert [(r.k, r.occurrences) for r in dup] == [(0, 1000)]


def test_hot_request_matches_brute_force(spark):
    """One request selects a third of all places; top 5 equals a Python loop."""
    import math

    from plazalens.operators.recommend import recommend_nearby, recommend_similar, requests_frame

    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((i, f"n{i}", "a", "Pizza, Bar" if hot else "Garage", "TX" if hot else "FL",
                     25.0 + (i * 37 % 2400) / 100.0, -120.0 + (i * 91 % 5000) / 100.0,
                     4.0 + (i % 3) / 2.0, float(i * 13 % 500), "WiFi"))
    places = spark.createDataFrame(rows, "place_id long, name string, address string, categories string, "
                                         "state string, latitude double, longitude double, avg_rating double, "
                                         "review_count double, attributes string")
    req = requests_frame(spark, [(1, "tx", "pizza")])

    def run(conf):
        return _with_conf(spark, conf, lambda: (
            [(r.place_id, r.similarity) for r in recommend_similar(places, req).orderBy("rank").collect()],
            [(r.place_id, r.distance) for r in recommend_nearby(places, req).orderBy("rank").collect()]))

    cand = [r for r in rows if r[4] == "TX" and "pizza" in r[3].lower() and r[7] >= 4]
    anchor = min(cand, key=lambda r: r[0])
    a = (anchor[5], anchor[6], anchor[7], anchor[8])

    def cos(r):
        b = (r[5], r[6], r[7], r[8])
        dot = b[0] * a[0] + b[1] * a[1] + b[2] * a[2] + b[3] * a[3]
        return round(dot / (math.sqrt(sum(x * x for x in b)) * math.sqrt(sum(x * x for x in a))), 6)

    want_sim = sorted(((r[0], cos(r)) for r in cand), key=lambda t: (-t[1], t[0]))[:5]
    want_near = sorted(((r[0], round(math.sqrt((r[5] - a[0]) ** 2 + (r[6] - a[1]) ** 2), 6))
                        for r in cand if r[0] != anchor[0]), key=lambda t: (t[1], t[0]))[:5]
    assert run({}) == (want_sim, want_near)
    assert run(SKEW_CONF) == (want_sim, want_near)


def test_hot_label_cosine_to_anchor(spark):
    import math

    from plazalens.operators.recommend import cosine_to_anchor

    rows = [(i, [float((i * 7 + j) % 11) - 3.0 for j in range(8)], 0 if i % 3 == 0 else i % 17)
            for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.similarity for r in _with_conf(
        spark, SKEW_CONF, lambda: cosine_to_anchor(df, "vec_id", "embedding", "label").collect())}
    anchors = {}
    for i, v, lab in rows:
        if lab not in anchors or i < anchors[lab][0]:
            anchors[lab] = (i, v)
    for i, v, lab in rows:
        a = anchors[lab][1]
        na, nb = math.sqrt(sum(x * x for x in v)), math.sqrt(sum(x * x for x in a))
        want = 0.0 if na == 0 or nb == 0 else sum(x * y for x, y in zip(v, a)) / (na * nb)
        assert got[i] == pytest.approx(round(want, 6), abs=1e-6)
