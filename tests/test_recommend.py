"""Recommendations: full-score ranks, null features, bad patterns, repeated place ids, plans."""

from pyspark.sql import functions as F

from plazalens.operators import recommend as R

SCHEMA = ("place_id long, name string, address string, categories string, attributes string, state string, "
          "latitude double, longitude double, avg_rating double, review_count double")


def places(spark, rows):
    return spark.createDataFrame([(i, f"n{i}", "a", "bar", "Unknown", "TX", la, lo, 4.5, n) for i, la, lo, n in rows], SCHEMA)


def test_rank_follows_the_full_similarity(spark):
    # place 9 equals the anchor; the others round to the same six digits
    rows = [(1, 30.0, -90.0, 1000.0)] + [(i, 30.0, -90.0, 1000.0 + i / 10) for i in range(2, 8)] + [(9, 30.0, -90.0, 1000.0)]
    out = R.recommend_similar(places(spark, rows), R.requests_frame(spark, [(1, "TX", "bar")]))
    got = [(r["rank"], r.place_id, r.similarity) for r in out.orderBy("rank").collect()]
    assert [p for _, p, _ in got[:2]] == [1, 9] and {s for _, _, s in got} == {1.0}


def test_a_place_without_coordinates_is_no_candidate(spark):
    rows = [(1, 30.0, -90.0, 1.0), (2, None, -90.0, 1.0), (3, 31.0, -90.0, 1.0), (4, 30.5, None, 1.0)]
    out = R.recommend_nearby(places(spark, rows), R.requests_frame(spark, [(1, "TX", "bar")])).collect()
    assert [(r.place_id, r.distance) for r in out] == [(3, 1.0)]


def test_a_bad_pattern_fails_its_own_request_only(spark):
    req = R.requests_frame(spark, [(1, "TX", "bar (grill"), (2, "TX", "bar"), (3, None, "bar")])
    assert [(r.query_id, r.error is None) for r in req.orderBy("query_id").collect()] == [(1, False), (2, True), (3, True)]
    df = places(spark, [(1, 30.0, -90.0, 1.0), (2, 31.0, -90.0, 1.0)])
    assert {r.query_id for r in R.recommend_nearby(df, req).collect()} == {2}
    assert {r.query_id for r in R.candidates(df, req).collect()} == {2}


def test_a_repeated_place_id_fills_one_rank(spark):
    rows = [(1, 31.0, -90.0, 1.0), (1, 30.0, -95.0, 1.0), (2, 30.5, -95.0, 1.0), (2, 30.5, -95.0, 1.0), (3, 33.0, -95.0, 1.0)]
    out = R.recommend_nearby(places(spark, rows), R.requests_frame(spark, [(1, "TX", "bar")])).orderBy("rank").collect()
    assert [(r["rank"], r.place_id, r.distance) for r in out] == [(1, 2, 0.5), (2, 3, 3.0)]


def test_equal_requests_are_answered_alike(spark):
    df = places(spark, [(i, 30.0 + i, -90.0, 1.0) for i in range(1, 9)])
    req = R.requests_frame(spark, [(1, "TX", "bar"), (2, "TX", "bar"), (3, "ZZ", "bar")])
    out = R.recommend_nearby(df, req).collect()
    by = {q: sorted((r["rank"], r.place_id) for r in out if r.query_id == q) for q in (1, 2, 3)}
    assert by[1] == by[2] and len(by[1]) == 5 and by[3] == []


def test_no_cartesian_product_beyond_the_request_bound(spark, monkeypatch):
    monkeypatch.setattr(R, "REQUESTS_MAX_ROWS", 0)
    df = places(spark, [(1, 30.0, -90.0, 1.0), (2, 31.0, -90.0, 1.0)])
    req = R.requests_frame(spark, [(1, "TX", "bar")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = R.recommend_nearby(df, req)
        assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 1
        monkeypatch.setattr(R, "STATES_MAX_ROWS", 0)  # many states too: the patterns are met in parts
        monkeypatch.setattr(R, "REQUESTS_MAX_ROWS", 1)
        req = R.requests_frame(spark, [(1, "TX", "bar"), (2, "t", "bar"), (3, "CA|x", "bar"), (4, "zz", "bar")])
        out = R.recommend_nearby(df, req)
        assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.query_id for r in out.collect()) == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cosine_does_not_shuffle_the_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(40)], "vec_id long, embedding array<double>, label int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = R.cosine_to_anchor(df, "vec_id", "embedding", "label")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert out.filter(F.col("vec_id") < 2).agg(F.min("similarity")).first()[0] == 1.0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
