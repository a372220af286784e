"""Dictionary joins: the rows of the term pattern, whatever the terms and texts; flat in the number of terms."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plazalens.functions.text import filter_terms
from plazalens.operators import dictionary as D

WORDS = ["bar", "barber", "b&b", "bed & breakfast", "tea", "steak", "ice cream", "café", "é", "24/7", "c++", "a.b", "_x", "&", "no-go"]


def frame(spark, values, name):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, {name} string")


def kept(df):
    return sorted(r.id for r in df.collect())


def same(spark, texts, terms):
    df = frame(spark, texts, "cat")
    got = kept(D.filter_dictionary(df, "cat", frame(spark, terms, "term")))
    good = [t for t in terms if t]
    want = kept(filter_terms(df, "cat", good)) if good else []
    assert got == want
    return got


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from([*WORDS, "é", "s", "x"]), max_size=6).flatmap(
           lambda w: st.sampled_from([" ", ", ", "", "&", "é", "-", "\n"]).map(lambda sep: sep.join(w))), min_size=1, max_size=40),
       st.lists(st.one_of(st.sampled_from(WORDS), st.lists(st.sampled_from(WORDS), min_size=2, max_size=3).map(" ".join)),
                min_size=1, max_size=8))
def test_same_rows_as_the_pattern(spark, texts, terms):
    same(spark, texts, terms)


def test_odd_rows(spark):
    texts = [None, "", "BAR", "Bar, Barber", "barber", "xbar", "b&b inn", "bed & breakfast", "bed &  breakfast", "bar"] + ["w " * 20000 + "tea"]
    assert same(spark, texts, ["Bar", "bar", None, "", "bed & breakfast", "tea", "b&b"]) == [2, 3, 6, 7, 9, 10]
    assert same(spark, texts, [None, ""]) == []
    assert same(spark, [], ["bar"]) == []
    df = frame(spark, texts, "text").withColumn("key", F.lit(1)).withColumn("term", F.lit("t"))
    out = D.filter_dictionary(df, "text", frame(spark, ["bar"], "term"))
    assert out.columns == df.columns and kept(out) == [2, 3, 9]


def test_every_term_of_a_text(spark):
    hits = D.dictionary_hits(frame(spark, ["Ice cream bar", "ice cream bar", "tea"], "cat"), "cat",
                             frame(spark, ["ice", "ice cream", "cream bar", "ice bar", "tea", "TEA"], "term"))
    assert {r.text: r.terms for r in hits.collect()} == {"ice cream bar": ["cream bar", "ice", "ice cream"], "tea": ["tea"]}


def test_long_list(spark):
    """60,000 terms: the rows whose words are listed, through one broadcast join and no pattern of them all."""
    terms = spark.range(60000).select(F.concat_ws(" ", F.concat(F.lit("w"), F.col("id")), F.lit("shop")).alias("term"))
    df = spark.range(3000).select("id", F.concat(F.lit("Near w"), F.col("id") * 40, F.lit(" shop, open")).alias("cat"))
    out = D.filter_dictionary(df, "cat", terms)
    assert kept(out) == list(range(1500))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
