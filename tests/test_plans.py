"""Physical-plan checks: no Python per row, pruned scans, top-k operators."""

from conftest import SF001

from plazalens.plans import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._explain_string("formatted") if hasattr(df, "_explain_string") else plan(df)


def test_no_python_udfs(spark):
    for name in ("gold_reviews", "silver_google_places", "sentiment_score_rules", "recommend_similar_bulk",
                 "silver_yelp_business"):
        p = plan(catalog.QUERIES[name](spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_gold_reviews_semi_join_and_pruning(spark):
    df = catalog.QUERIES["gold_reviews"](spark, SF001)
    p = plan(df)
    assert "LeftSemi" in p
    # the part scan reads only the columns the places need
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string,p_size:int>" in p


def test_top_k_operators(spark):
    p = plan(catalog.QUERIES["sentiment_top_k"](spark, SF001))
    assert "TakeOrderedAndProject" in p
    p = plan(catalog.QUERIES["recommend_similar_bulk"](spark, SF001))
    assert "WindowGroupLimit" in p


def test_sentiment_single_exchange_of_texts(spark):
    p = plan(catalog.QUERIES["sentiment_score_rules"](spark, SF001))
    assert "BroadcastHashJoin" in p
    assert "Window" not in p  # preceding tokens come from the array, not a window


def test_hash_prefilter_plan(spark):
    p = plan(catalog.QUERIES["silver_reviews_hash_dedup"](spark, SF001))
    assert "LeftAnti" in p and "LeftSemi" in p and "BroadcastHashJoin" in p


def test_compound_sentiment_plan(spark):
    p = plan(catalog.QUERIES["sentiment_score_compound"](spark, SF001))
    assert "Window" not in p and "SortMergeJoin" not in p and "__plazalens_row" not in p
    assert p.count("Exchange hashpartitioning(_id") == 1  # one exchange: partial sums per review


def test_recommend_plan_has_no_cartesian(spark):
    for name in ("recommend_similar_bulk", "recommend_nearby_bulk", "place_search"):
        p = plan(catalog.QUERIES[name](spark, SF001))
        assert "CartesianProduct" not in p, name
