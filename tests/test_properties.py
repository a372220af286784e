"""Property tests (hypothesis) on small generated frames."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plazalens.operators.clean import dedup_rows
from plazalens.operators.nested import attributes_list
from plazalens.operators.sentiment import compound, label, lexicon_frame, sentiment_scores

SET = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
words = st.sampled_from(["good", "bad", "not", "very", "table", "nice"])


@SET
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=20))
def test_dedup_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    once = dedup_rows(df)
    assert sorted(once.collect(), key=repr) == sorted(dedup_rows(once).collect(), key=repr)
    assert once.count() == len(set(rows))


@SET
@given(st.lists(st.lists(words, max_size=12).map(" ".join), min_size=1, max_size=10))
def test_compound_bounds_and_oddness(spark, texts):
    lex = lexicon_frame(spark, [("good", 1.9), ("bad", -2.5), ("nice", 1.8)])
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "review_id string, text string")
    out = sentiment_scores(df, lex, negators=["not"], boosters=[("very", 0.293)]).collect()
    assert len(out) == len(texts)
    for r in out:
        assert -1.0 <= r.sentiment_score <= 1.0
    one = spark.createDataFrame([(1.7,), (-1.7,)], "s double").select(compound(F.col("s"))).collect()
    assert math.isclose(one[0][0], -one[1][0])


@SET
@given(st.lists(st.floats(-1, 1, allow_nan=False), min_size=2, max_size=10))
def test_label_monotone(spark, scores):
    order = {"negative": 0, "neutral": 1, "positive": 2}
    df = spark.createDataFrame([(s,) for s in sorted(scores)], "s double")
    labs = [order[r[0]] for r in df.select(label(F.col("s"))).collect()]
    assert labs == sorted(labs)


flag = st.sampled_from(["True", "False", "u'free'", None])


@SET
@given(st.lists(st.tuples(flag, flag, flag), min_size=1, max_size=10))
def test_attributes_list_matches_loop(spark, rows):
    names = ["WiFi", "HasTV", "DogsAllowed"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)],
                               "id int, attributes struct<WiFi:string,HasTV:string,DogsAllowed:string>")
    got = {r.id: r.attributes for r in attributes_list(df, strict_parity=True).collect()}
    for i, r in enumerate(rows):
        assert got[i] == ", ".join(n for n, v in zip(names, r) if v == "True")


alphabet = st.sampled_from(list("abcXYZ éß,.'\u2019- \n0"))


@SET
@given(st.lists(st.one_of(st.none(), st.text(alphabet, max_size=30)), min_size=1, max_size=12))
def test_tokens_match_python_split(spark, texts):
    import re

    from plazalens.functions.text import tokens
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.tok for r in df.select("i", tokens("t").alias("tok")).collect()}
    for i, t in enumerate(texts):
        plain = None if t is None else t.replace("\u2019", "'").lower()
        want = None if t is None else re.findall("[a-zéß]+(?:'[a-zéß]+)*", plain)
        assert got[i] == want, (t, got[i], want)


state_words = st.sampled_from(["Kansas", "City", "MO", "West", "Virginia", "New", "York", "NY", "IN", "in",
                               "Indiana", "ORegon", "OR", "Main", "St", "AL", "Alabama", "KS", ","])


@SET
@given(st.lists(st.lists(state_words, max_size=8).map(" ".join), min_size=1, max_size=10))
def test_grouped_state_pattern_equals_flat(spark, addrs):
    from plazalens.functions.text import fast_state_pattern, state_pattern
    df = spark.createDataFrame([(a,) for a in addrs], "a string")
    rows = df.select(F.regexp_extract("a", state_pattern(), 0).alias("x"),
                     F.regexp_extract("a", fast_state_pattern(), 0).alias("y"),
                     F.regexp_extract_all("a", F.lit(state_pattern()), F.lit(0)).alias("xs"),
                     F.regexp_extract_all("a", F.lit(fast_state_pattern()), F.lit(0)).alias("ys")).collect()
    for r in rows:
        assert r.x == r.y and r.xs == r.ys


row = st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, 0.0, -0.0, 1.5]),
                st.sampled_from([None, 1, 2]))


@SET
@given(st.lists(row, max_size=25))
def test_hash_prefilter_dedup_equals_plain(spark, rows):
    df = spark.createDataFrame(rows, "s string, d double, i int")
    plain = sorted(map(repr, dedup_rows(df).collect()))
    fast = sorted(map(repr, dedup_rows(df, hash_prefilter=True).collect()))
    assert len(plain) == len(fast)
    norm = lambda xs: sorted(x.replace("-0.0", "0.0") for x in xs)
    assert norm(plain) == norm(fast)
    sub = dedup_rows(df, subset=["s", "i"], hash_prefilter=True)
    assert sub.count() == dedup_rows(df, subset=["s", "i"]).count()
