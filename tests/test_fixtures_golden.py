"""Golden rows from FIXTURES.md: one literal frame per operator and quirk."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from plazalens.functions.text import extract_state, map_state, matches_terms, term_pattern
from plazalens.operators.gold import gold_google_reviews, review_key
from plazalens.operators.nested import attributes_list
from plazalens.operators.recommend import recommend_nearby, recommend_similar, requests_frame
from plazalens.operators.sentiment import label, lexicon_frame, sentiment_scores
from plazalens.plans import medallion as md
from plazalens.schemas import GOOGLE_CATEGORY_TERMS, GOOGLE_PLACES_RAW, GOOGLE_REVIEWS_RAW, YELP_REVIEWS_RAW
from plazalens.sources.io import state_dimension


def _place(gid, name, addr, cat, rating=4.0, lat=30.0, n=10):
    return (addr, rating, cat, gid, lat, -90.0, name, n, "u")


@pytest.fixture(scope="module")
def places_raw(spark):
    rows = [
        _place("g1", "Taco Bar", "1 Main St, Austin, TX 78701", ["Bar", "Restaurant"], 4.5, n=120),
        _place("g1", "Taco Bar", "1 Main St, Austin, TX 78701", ["Bar", "Restaurant"], 4.5, n=120),
        _place("g2", None, None, ["Pizza"], 4.0),
        _place("g3", "Tires", "2 Elm St, Miami, FL", ["Tire shop"], 4.9),
        _place("g4", "Diner", "3 Oak, Kansas City, MO", ["Diner"], 3.9),
        _place("g5", "Barn", "4 Rd, Salem, Oregon", ["Barn hire"], 4.1),
        _place("g6", "Cafe", "5 Rd, Reno, Nevada", None, 4.1),
        _place("g7", "Smoke", "6 Rd, Charleston, West Virginia", ["BBQ"], 4.4),
        _place(None, "X", "7 Rd, Ohio", ["Cafe"], 4.0),
        _place("g8", "Lat", "8 Rd, Ohio", ["Cafe"], 4.0, lat=None),
    ]
    return spark.createDataFrame(rows, GOOGLE_PLACES_RAW)


def test_silver_places_golden(places_raw):
    out = {r.gmap_id: r for r in md.silver_google_places(places_raw, unit_col=None).collect()}
    assert set(out) == {"g1", "g2", "g4", "g7"}  # g3 category, g5 barn, g6 null cat, null key, null lat
    assert out["g1"].state == "TX" and out["g1"].category == "Bar, Restaurant"
    assert out["g2"].name == "Unknown" and out["g2"].address == "Unknown" and out["g2"].state == "Unknown"
    assert out["g4"].state == "KS"  # leftmost hit (D12)
    assert out["g7"].state == "WV"  # lower-cased BBQ term matches (D2)


def test_state_anchor_last(spark):
    df = spark.createDataFrame([("3 Oak, Kansas City, MO",), ("1 Rd, Salem, Oregon",), ("nowhere",), (None,)], "a string")
    got = [r[0] for r in df.select(map_state(extract_state("a", anchor="last"))).collect()]
    assert got == ["MO", "OR", "Unknown", "Unknown"]


def test_term_pattern_corrected_list():
    pat = term_pattern(GOOGLE_CATEGORY_TERMS)
    for t in ("hot dog", "tea", "bakery", "beer", "bistro", "bbq"):
        assert f"|{t}|" in pat or pat.startswith(r"\b(" + t + "|")
    assert "BBQ" not in pat


def test_whole_word(spark):
    df = spark.createDataFrame([("barn hire",), ("bar",), ("sports bar, grill",), (None,)], "c string")
    got = [r[0] for r in df.select(matches_terms("c", ["bar"])).collect()]
    assert got == [False, True, True, None]


@pytest.fixture(scope="module")
def reviews_raw(spark):
    t = 1609909927056
    rows = [("u1", "g1", 5.0, "great", t), ("u1", "g1", 5.0, "great", t), ("u2", "g1", None, None, t),
            ("u3", "g9", 4.0, "ok", t), (None, "g1", 4.0, "ok", t), ("u4", "g1", 4.0, "a" * 7001, t)]
    return spark.createDataFrame(rows, GOOGLE_REVIEWS_RAW)


def test_silver_and_gold_reviews(spark, reviews_raw, places_raw):
    silver = md.silver_google_reviews(reviews_raw, unit_col=None)
    rows = silver.collect()
    assert len(rows) == 4
    assert all(r.date == dt.date(2021, 1, 6) for r in rows)
    u2 = [r for r in rows if r.user_id == "u2"][0]
    assert u2.rating == 0 and u2.text == "Unknown"
    places = md.silver_google_places(places_raw, unit_col=None)
    gold = {r.user_id: r for r in gold_google_reviews(silver, places).collect()}
    assert set(gold) == {"u1", "u2", "u4"}
    assert gold["u1"].review_id == "u1g1" and gold["u1"].rating == 5
    assert len(gold["u4"].text) == 7000


def test_semi_vs_inner_on_repeated_key(spark):
    reviews = spark.createDataFrame([("u1", "g1", 4.0, "t", dt.date(2021, 1, 1))],
                                    "user_id string, gmap_id string, rating double, text string, date date")
    places = spark.createDataFrame([("g1",), ("g1",)], "gmap_id string")
    assert gold_google_reviews(reviews, places).count() == 1
    assert gold_google_reviews(reviews, places, how="inner").count() == 2  # D10


def test_review_key_nulls(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string")
    assert [r[0] for r in df.select(review_key("x", "y")).collect()] == ["ab", None]
    assert df.select(review_key("x", "y", sep="|")).first()[0] == "a|b"


def test_attributes_list(spark):
    df = spark.createDataFrame(
        [("b1", ("True", "False", None)), ("b2", ("True", "True", "True")),
         ("b3", ("u'free'", "False", None)), ("b4", None)],
        "id string, attributes struct<WiFi:string,HasTV:string,DogsAllowed:string>")
    got = {r.id: r.attributes for r in attributes_list(df).collect()}
    assert got == {"b1": "WiFi", "b2": "WiFi, HasTV, DogsAllowed", "b3": "Unknown", "b4": "Unknown"}
    strict = {r.id: r.attributes for r in attributes_list(df, strict_parity=True).collect()}
    assert strict["b3"] == "" and strict["b4"] == ""


def test_yelp_reviews_dates(spark):
    rows = [("r1", "u", "b", 4.0, "t", "2018-07-07 22:09:11"), ("r2", "u", "b", 4.7, "t", "2018-07-08 00:00:00"),
            ("r3", "u", "b", None, "t", "2018-07-08 00:00:00"), ("r4", "u", "b", 3.0, "t", "not a date")]
    silver = {r.review_id: r for r in md.silver_yelp_reviews(
        spark.createDataFrame(rows, YELP_REVIEWS_RAW), unit_col=None).collect()}
    assert set(silver) == {"r1", "r2", "r4"}
    assert silver["r1"].date == dt.date(2018, 7, 7) and silver["r4"].date is None
    biz = spark.createDataFrame([("b",)], "business_id string")
    gold = {r.review_id: r.rating for r in md.gold_yelp_reviews(md.silver_yelp_reviews(
        spark.createDataFrame(rows, YELP_REVIEWS_RAW), unit_col=None), biz).collect()}
    assert gold["r2"] == 4  # truncation


def test_state_dimension(spark):
    dim = state_dimension(spark)
    rows = dim.orderBy("state_id").collect()
    assert len(rows) == 50 and rows[0] == Row(state_id=1, state="AL", name="Alabama")
    assert rows[-1].state == "WY"


LEX = [("good", 1.9), ("bad", -2.5)]


@pytest.mark.parametrize("text,score,lab", [
    ("good", 0.4404, "positive"), ("bad", -0.5423, "negative"), ("table", 0.0, "neutral"),
    ("very good", 0.4927, "positive"), ("not good", -0.3412, "negative"),
    ("good bad", -0.1531, "neutral"), (None, None, None),
])
def test_sentiment_fixture(spark, text, score, lab):
    df = spark.createDataFrame([("1", text)], "review_id string, text string")
    out = sentiment_scores(df, lexicon_frame(spark, LEX), negators=["not"], boosters=[("very", 0.293)])
    r = out.select("sentiment_score", label(F.col("sentiment_score")).alias("l")).first()
    if score is None:
        assert r.sentiment_score is None and r.l is None
    else:
        assert round(r.sentiment_score, 4) == score and r.l == lab


def test_contracted_negation_and_accents(spark):
    df = spark.createDataFrame([("1", "This isn't good"), ("2", "This isn\u2019t good"), ("3", "not good"), ("4", "caf\u00e9good")],
                               "review_id string, text string")
    got = {r.review_id: round(r.sentiment_score, 4) for r in sentiment_scores(
        df, lexicon_frame(spark, LEX), negators=["not", "isn't"]).collect()}
    assert got == {"1": -0.3412, "2": -0.3412, "3": -0.3412, "4": 0.0}


def test_published_rules_by_default(spark):
    from plazalens.operators.sentiment import sentiment_table
    df = spark.createDataFrame([("1", "This isn't good"), ("2", "GOOD day"), ("3", "good day"), ("4", "GOOD DAY"),
                                ("5", "very good"), ("6", "bad but good"), ("7", "good!")], "review_id string, text string")
    got = {r.review_id: r.sentiment_score for r in sentiment_table(df, lexicon_frame(spark, LEX), round_to=6).collect()}
    sums = {"1": 1.9 * -0.74, "2": 1.9 + 0.733, "3": 1.9, "4": 1.9, "5": 1.9 + 0.293, "6": -2.5 * 0.5 + 1.9 * 1.5,
            "7": 1.9 + 0.292}
    assert got == {k: round(s / (s * s + 15) ** 0.5, 6) for k, s in sums.items()}


def test_place_keys_equal_silver_keys(spark):
    from plazalens.plans import catalog, medallion
    sf = "/root/testdata/sf0.001"
    for raw, silver, keys, key in (
            (catalog.dv.places_raw, medallion.silver_google_places, medallion.silver_google_place_keys, "gmap_id"),
            (catalog.dv.yelp_business_raw, medallion.silver_yelp_business, medallion.silver_yelp_business_keys, "business_id")):
        places = raw(spark, sf)
        want = {r[0] for r in silver(places, terms=catalog.DEMO_TERMS).select(key).collect()}
        assert {r[0] for r in keys(places, terms=catalog.DEMO_TERMS).collect()} == want and want


def test_repeated_ids_keep_their_own_rows(spark):
    df = spark.createDataFrame([("k", "good"), ("k", "bad bad"), ("k", "good"), ("k", None), ("k", None), ("k", "")],
                               "review_id string, text string")
    got = sentiment_scores(df, lexicon_frame(spark, LEX)).collect()
    assert sorted(str(r.sentiment_score and round(r.sentiment_score, 4)) for r in got) == sorted(
        ["0.4404", "0.4404", "-0.7906", "None", "None", "0.0"])


def test_label_boundaries(spark):
    df = spark.createDataFrame([(0.3,), (0.2999,), (-0.3,), (-0.2999,), (None,)], "s double")
    assert [r[0] for r in df.select(label(F.col("s"))).collect()] == \
        ["positive", "neutral", "negative", "neutral", None]
    assert df.select(label(F.col("s"), parity=True)).collect()[-1][0] == "negative"


def test_booster_sign_follows_valence(spark):
    df = spark.createDataFrame([("1", "very bad"), ("2", "very very good")], "review_id string, text string")
    out = {r.review_id: r.sentiment_score for r in sentiment_scores(
        df, lexicon_frame(spark, LEX), boosters=[("very", 0.293)], round_to=6).collect()}
    s1 = -2.5 - 0.293
    assert out["1"] == round(s1 / (s1 * s1 + 15) ** 0.5, 6)
    s2 = 1.9 + 0.293 + 0.293 * 0.95
    assert out["2"] == round(s2 / (s2 * s2 + 15) ** 0.5, 6)


@pytest.fixture(scope="module")
def rec_places(spark):
    rows = [("p1", 25.0, -80.0, 4.5, 100.0), ("p2", 26.0, -81.0, 4.0, 10.0), ("p3", 40.0, -74.0, 5.0, 500.0),
            ("p4", 25.0, -80.0, 3.5, 100.0), ("p5", 25.0, -80.0, 4.5, 100.0)]
    df = spark.createDataFrame(rows, "place_id string, latitude double, longitude double, avg_rating double, review_count double")
    return df.select("*", F.lit("n").alias("name"), F.lit("a").alias("address"),
                     F.lit("Pizza, Bar").alias("categories"), F.lit("WiFi").alias("attributes"),
                     F.lit("FL").alias("state"))


def test_recommend_similar_fixture(spark, rec_places):
    req = requests_frame(spark, [(1, "fl", "pizza"), (2, "TX", "pizza")])
    out = recommend_similar(rec_places, req).orderBy("rank").collect()
    assert [r.place_id for r in out] == ["p1", "p5", "p3", "p2"]
    sims = {r.place_id: round(r.similarity, 4) for r in out}
    assert sims == {"p1": 1.0, "p5": 1.0, "p3": 0.8602, "p2": 0.7278}


def test_recommend_nearby_fixture(spark, rec_places):
    req = requests_frame(spark, [(1, "fl", "pizza")])
    out = recommend_nearby(rec_places, req).orderBy("rank").collect()
    assert [r.place_id for r in out] == ["p5", "p2", "p3"]  # p1 excluded by id (D19), p4 below 4
    assert [round(r.distance, 4) for r in out] == [0.0, 1.4142, 16.1555]


def test_recommend_single_candidate(spark, rec_places):
    one = rec_places.filter(F.col("place_id") == "p2")
    req = requests_frame(spark, [(1, "fl", "pizza")])
    assert [r.place_id for r in recommend_similar(one, req).collect()] == ["p2"]
    assert recommend_nearby(one, req).count() == 0  # D18: no error


def test_grouped_patterns_match_flat(spark):
    from plazalens.functions.text import fast_state_pattern, fast_term_pattern, state_pattern
    addrs = ["3 Oak, Kansas City, MO", "West Virginia", "New York, NY", "Virginia Beach, VA", "Indiana IN",
             "ORegon OR", "AL", "ALabama Alabama", "Missouri MO Mississippi", "nothing", None]
    df = spark.createDataFrame([(a,) for a in addrs], "a string")
    flat, fast = state_pattern(), fast_state_pattern()
    rows = df.select(F.regexp_extract("a", flat, 0).alias("x"), F.regexp_extract("a", fast, 0).alias("y"),
                     F.regexp_extract_all("a", F.lit(flat), F.lit(0)).alias("xs"),
                     F.regexp_extract_all("a", F.lit(fast), F.lit(0)).alias("ys")).collect()
    assert all(r.x == r.y and r.xs == r.ys for r in rows)
    cats = ["bar & grill", "barn", "sports bar", "hot dog stand", "tea room", "icecream", "bbq", "wine bar"]
    df = spark.createDataFrame([(c,) for c in cats], "c string")
    rows = df.select(F.col("c").rlike(term_pattern(GOOGLE_CATEGORY_TERMS)).alias("x"),
                     F.col("c").rlike(fast_term_pattern(GOOGLE_CATEGORY_TERMS)).alias("y")).collect()
    assert all(r.x == r.y for r in rows)


def test_unbounded_requests_path(spark, rec_places, monkeypatch):
    """Requests over the broadcast bound take the other plan, same answer."""
    import plazalens.operators.recommend as R
    req = requests_frame(spark, [(1, "fl", "pizza"), (2, "TX", "pizza")])
    small = recommend_similar(rec_places, req).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(R, "REQUESTS_MAX_ROWS", 1)
    big = recommend_similar(rec_places, req).orderBy("query_id", "rank").collect()
    assert small == big
    near_small = recommend_nearby(rec_places, req).collect()
    assert len(near_small) == 3


@pytest.mark.parametrize("text,score", [
    ("good but bad", -2.8), ("good!!!", 1.9 + 3 * 0.292), ("good!!!!!!", 1.9 + 4 * 0.292),
    ("bad??", -2.5 - 2 * 0.18), ("bad????", -2.5 - 0.96), ("table!!!", 0.0), ("but good", 1.9 * 1.5),
])
def test_contrast_and_punctuation(spark, text, score):
    df = spark.createDataFrame([("1", text)], "review_id string, text string")
    got = sentiment_scores(df, lexicon_frame(spark, LEX), contrast="but", punctuation=True).first()
    assert got.sentiment_score == pytest.approx(score / (score * score + 15) ** 0.5, abs=1e-12)


def test_silver_yelp_business_fixture(spark):
    """FIXTURES A3: attributes list, category filter, null state, zero fills."""
    schema = ("business_id string, name string, address string, state string, latitude double, "
              "longitude double, stars double, review_count bigint, "
              "attributes struct<WiFi:string,HasTV:string,DogsAllowed:string>, categories string")
    rows = [
        ("b1", "A", "1 St", "TX", 30.0, -90.0, 4.5, 10, ("True", "False", None), "Bars, Food"),
        ("b2", None, None, "FL", None, None, None, None, ("True", "True", "True"), "Hotels"),
        ("b3", "C", "3 St", "NV", 1.0, 1.0, 3.0, 1, ("u'free'", "False", None), "Pizza"),
        ("b4", "D", "4 St", "NV", 1.0, 1.0, 3.0, 1, None, "Coffee & Tea"),
        ("b5", "E", "5 St", "NV", 1.0, 1.0, 3.0, 1, ("True", None, None), "Plumbing"),
        ("b6", "F", "6 St", None, 1.0, 1.0, 3.0, 1, ("True", None, None), "Food"),
        ("b1", "A", "1 St", "TX", 30.0, -90.0, 4.5, 10, ("True", "False", None), "Bars, Food"),
    ]
    out = {r.business_id: r for r in md.silver_yelp_business(spark.createDataFrame(rows, schema),
                                                               unit_col=None).collect()}
    assert set(out) == {"b1", "b2", "b3", "b4"}
    assert out["b1"].attributes == "WiFi" and out["b2"].attributes == "WiFi, HasTV, DogsAllowed"
    assert out["b3"].attributes == "Unknown" and out["b4"].attributes == "Unknown"
    assert (out["b2"].name, out["b2"].address, out["b2"].avg_rating, out["b2"].review_count,
            out["b2"].latitude) == ("Unknown", "Unknown", 0.0, 0, 0.0)
    strict = {r.business_id: r.attributes for r in md.silver_yelp_business(
        spark.createDataFrame(rows, schema), unit_col=None, strict_parity=True).collect()}
    assert strict["b3"] == "" and strict["b4"] == ""


def test_punctuation_ignores_summation_noise(spark):
    """0.1 + 0.2 - 0.3 is 5.55e-17 in floating point: no '!' emphasis, score 0."""
    lex = lexicon_frame(spark, [("x", 0.1), ("y", 0.2), ("z", -0.3)])
    df = spark.createDataFrame([("1", "x y z!!!!"), ("2", "z y x!!!!")], "review_id string, text string")
    got = [r.sentiment_score for r in sentiment_scores(df, lex, punctuation=True, round_to=6).collect()]
    assert got == [0.0, 0.0] and all(str(g) == "0.0" for g in got)


def test_sentiment_table_parity_flag(spark):
    """A null text gives a null score; its label is null, or 'negative' with parity."""
    from plazalens.operators.sentiment import sentiment_table
    df = spark.createDataFrame([("1", None), ("2", "good")], "review_id string, text string")
    lex = lexicon_frame(spark, LEX)
    plain = {r.review_id: (r.sentiment_score, r.sentiment) for r in sentiment_table(df, lex).collect()}
    parity = {r.review_id: r.sentiment for r in sentiment_table(df, lex, parity=True).collect()}
    assert plain["1"] == (None, None) and plain["2"][1] == "positive"
    assert parity == {"1": "negative", "2": "positive"}
