"""Phrases, emoticons and special cases of the sentiment rules."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plazalens.functions.text import tokens
from plazalens.operators.phrases import merge_phrases
from plazalens.operators.sentiment import PUBLISHED_RULES, lexicon_frame, sentiment_scores, sentiment_table
from plazalens.schemas import BOOSTER_INCREMENT, NEGATION_SCALAR

LEX = [("good", 2.0), ("bad", -2.5), ("death", -3.0), ("kiss", 1.8), (":)", 2.0), (":d", 2.3), ("+1", 1.1)]


def norm(s):
    return s / math.sqrt(s * s + 15)


def scores(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "review_id int, text string")
    out = sentiment_scores(df, lexicon_frame(spark, LEX), **{**PUBLISHED_RULES, **kw}).collect()
    return [r.sentiment_score for r in sorted(out, key=lambda r: r.review_id)]


def test_published_cases(spark):
    cases = [
        ("a kiss of death", -1.5),                                   # one phrase, not its words
        ("a Kiss Of death, good", -1.5 + 2.0),
        ("not the kiss of death", -1.5 * NEGATION_SCALAR),            # a rule sees the phrase whole
        ("kiss of kiss of death", 1.8 - 1.5),
        ("kind of good", 2.0 - BOOSTER_INCREMENT),                    # a booster of two words
        ("never so good", (2.0 + BOOSTER_INCREMENT) * 1.5),
        ("never good", 2.0 * NEGATION_SCALAR),
        ("never this was good", 2.0 * 1.25),
        ("least good", 2.0 * NEGATION_SCALAR),
        ("the least good", 2.0 * NEGATION_SCALAR),
        ("at least good", 2.0),
        ("fine :)", 2.0),
        ("fine :) .", 2.0),
        ("fine :D", 2.3 ),
        ("+1 good", 1.1 + 2.0),
        ("see:) x", 0.0),                                            # no chunk of its own
        ("", 0.0),
    ]
    got = scores(spark, [t for t, _ in cases], capitals=False)
    for (text, want), score in zip(cases, got):
        assert score == pytest.approx(norm(want), abs=1e-9), text


def test_null_repeats_and_long_texts(spark):
    long = "word " * 200_000 + "kiss of death"
    got = scores(spark, [None, long, "kiss of death", "kiss of death"])
    assert got[0] is None
    assert got[1:] == pytest.approx([norm(-1.5)] * 3)
    empty = spark.createDataFrame([], "review_id int, text string")
    assert sentiment_table(empty, lexicon_frame(spark, LEX)).count() == 0


def test_off_by_default(spark):
    df = spark.createDataFrame([(1, "kiss of death :)")], "review_id int, text string")
    assert sentiment_scores(df, lexicon_frame(spark, LEX)).first().sentiment_score == pytest.approx(norm(1.8 - 3.0))


def test_contrast_word_inside_a_phrase(spark):
    got = scores(spark, ["good anything but bad", "good but bad"], idioms=[("anything but", -1.0)], capitals=False)
    assert got == pytest.approx([norm(2.0 - 1.0 - 2.5), norm(2.0 * 0.5 - 2.5 * 1.5)])


def brute_merge(toks, phrases):
    out, i = [], 0
    by_length = sorted((p.split() for p in phrases), key=len, reverse=True)
    while i < len(toks):
        n = next((len(p) for p in by_length if len(p) > 1 and toks[i:i + len(p)] == p), 1)
        out.append(" ".join(toks[i:i + n]))
        i += n
    return out


words = st.lists(st.sampled_from(["a", "b", "c", "it's"]), max_size=14).map(" ".join)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(words, min_size=20, max_size=40), phrases=st.lists(words, max_size=12))
def test_merge_equals_leftmost_longest(spark, texts, phrases):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("t", tokens("text"))
    entries = spark.createDataFrame([(p,) for p in phrases], "token string")
    got = merge_phrases(df, "t", entries, ["id"]).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.t == brute_merge(re.findall(r"[a-z']+", r.text), phrases), (r.text, phrases)


def test_plan_keeps_texts_in_place_until_phrases_are_known(spark):
    df = spark.range(100).select("id", F.array(F.lit("kiss"), F.lit("of"), F.lit("death")).alias("t"))
    entries = spark.createDataFrame([("kiss of death",)], "token string")
    plan = merge_phrases(df, "t", entries, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_few_phrases_are_found_in_place(spark, monkeypatch):
    from plazalens.operators import phrases as P
    phrases = ["kiss of death", "of death", "the kiss", "a.b c", "+1 :)", "ſo good"]
    texts = ["The KISS of Death, of death", "kiss  of", "", None, "of of death of death of", "+1 :) the the kiss of death",
             "so good ſo good SO good", "xkiss of deathx of death"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select(
        "id", F.xxhash64("text").alias("h"), tokens("text", lower=False, signs=True).alias("t"))
    entries = lexicon_frame(spark, [(p, 1.0) for p in phrases]).select("token")
    short = merge_phrases(df, "t", entries, ["h"], signs=True)
    assert "Join" not in short._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: r.t for r in short.collect()}
    monkeypatch.setattr(P, "IN_PLACE_PHRASES", 0)
    assert got == {r.id: r.t for r in merge_phrases(df, "t", entries, ["h"], signs=True).collect()}
    assert got[4] == ["of", "of death", "of death", "of"] and got[3] is None
