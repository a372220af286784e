"""Ledger, incremental runs, sinks and readers (FIXTURES A6, D14, D15)."""

import pytest
from pyspark.errors import AnalysisException

from plazalens.plans import medallion as md
from plazalens.plans.incremental import run_incremental
from plazalens.schemas import GOOGLE_REVIEWS_RAW
from plazalens.session import scratch_path
from plazalens.sources.io import list_units, read_json, read_layer, select_by_ordinal, write_parquet
from plazalens.sources.ledger import append_ledger, new_units, read_ledger


def _names(df):
    return sorted(r.file_name for r in df.collect())


def test_ledger_new_units(spark):
    base = scratch_path(spark, "t-ledger")
    listed = spark.createDataFrame([("1.json",), ("2.json",), ("3.json",)], "file_name string")
    led = f"{base}/_ledger"
    assert read_ledger(spark, led).count() == 0  # absent ledger reads empty (D15)
    append_ledger(spark, led, "d", ["1.json"])
    assert _names(new_units(listed, read_ledger(spark, led, "d"))) == ["2.json", "3.json"]
    append_ledger(spark, led, "d", ["2.json", "3.json"])
    assert _names(new_units(listed, read_ledger(spark, led, "d"))) == []
    append_ledger(spark, led, "d", [])  # empty batch does not fail
    assert read_ledger(spark, led, "other").count() == 0


def _write_units(spark, root, units):
    for unit, rows in units.items():
        spark.createDataFrame(rows, GOOGLE_REVIEWS_RAW).coalesce(1).write.json(f"{root}/{unit}")


def test_incremental_run_twice(spark):
    base = scratch_path(spark, "t-inc")
    raw, lake = f"{base}/raw", f"{base}/lake"
    t = 1609909927056
    _write_units(spark, raw, {"TX": [("u1", "g1", 5.0, "a", t), ("u1", "g1", 5.0, "a", t)],
                              "FL": [("u2", "g2", 4.0, None, t)]})

    def reader(s, paths, root):
        return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root)

    first = run_incremental(spark, "reviews", raw, lake, "google", "reviews", reader, md.silver_google_reviews)
    assert first.units == ["FL", "TX"]
    assert (first.bronze_rows, first.silver_rows) == (3, 2)  # counted while writing (observe)
    assert run_incremental(spark, "reviews", raw, lake, "google", "reviews", reader, md.silver_google_reviews).units == []
    silver = read_layer(spark, lake, "silver", "google", "reviews")
    assert silver.count() == 2
    assert {r.source_file for r in silver.collect()} == {"TX", "FL"}
    # a new unit arrives: only it is processed, earlier units are untouched
    _write_units(spark, raw, {"NY": [("u3", "g3", 3.0, "b", t)]})
    assert run_incremental(spark, "reviews", raw, lake, "google", "reviews", reader, md.silver_google_reviews).units == ["NY"]
    assert read_layer(spark, lake, "silver", "google", "reviews").count() == 3
    assert read_layer(spark, lake, "silver", "google", "reviews", unit="NY").count() == 1
    assert _names(list_units(spark, raw)) == ["FL", "NY", "TX"]


def test_sink_fails_if_exists(spark):
    path = scratch_path(spark, "t-sink")
    df = spark.range(3)
    write_parquet(df, path)
    with pytest.raises(AnalysisException):
        write_parquet(df, path)
    assert spark.read.parquet(path).count() == 3


def test_select_by_ordinal(spark):
    df = spark.createDataFrame([("r1", 0.5, "pos")], "a string, b double, c string")
    out = select_by_ordinal(df, "sentiment")
    assert out.columns == ["review_id", "sentiment_score", "sentiment"]
    with pytest.raises(ValueError):
        select_by_ordinal(df, "sentiment", [("review_id", 9)])


def test_dedup_is_per_unit(spark):
    """An exact copy in another input unit is kept; global dedup by unit_col=None."""
    t = 1609909927056
    rows = [("u1", "g1", 5.0, "a", t, "TX"), ("u1", "g1", 5.0, "a", t, "TX"), ("u1", "g1", 5.0, "a", t, "FL")]
    df = spark.createDataFrame(rows, "user_id string, gmap_id string, rating double, text string, time long, source_file string")
    assert md.silver_google_reviews(df).count() == 2
    assert md.silver_google_reviews(df.drop("source_file"), unit_col=None).count() == 1


def test_ordinal_load_drops_text(spark):
    """The reviews load maps five ordinals; text is not loaded."""
    import datetime as dt
    gold = spark.createDataFrame([("u1", "g1", 5, "great", dt.date(2021, 1, 6), "u1g1")],
                                 "user_id string, gmap_id string, rating int, text string, date date, review_id string")
    out = select_by_ordinal(gold, "reviews_google")
    assert out.columns == ["user_id", "review_id", "rating", "gmap_id", "date"]
    assert out.first().review_id == "u1g1"


def test_quality_odd_column_names(spark):
    from plazalens.operators.quality import contract_violations, profile
    df = spark.createDataFrame([("a", None), (None, 1)], "`it's` string, `x y` int")
    rows = {r.column_name: (r.data_type, r.non_null, r.nulls) for r in profile(df).collect()}
    assert rows == {"it's": ("string", 1, 1), "x y": ("int", 1, 1)}
    v = {(r.column_name, r.check): r.violations for r in
         contract_violations(df, [("it's", "string", True, 0), ("x y", "bigint", True, None)]).collect()}
    assert v[("it's", "not_null")] == 1 and v[("it's", "max_length 0")] == 1
    assert v[("x y", "type int <> bigint")] == -1


def test_read_lexicon_file(spark):
    from plazalens.operators.sentiment import read_lexicon
    path = scratch_path(spark, "t-lex")
    spark.createDataFrame([("Good\t1.9\t0.5\t[1,2]",), ("bad\t-2.5\t0.1\t[]",), ("broken line",), ("nan\tx",)],
                          "v string").coalesce(1).write.text(path)
    got = {r.token: r.valence for r in read_lexicon(spark, path).collect()}
    assert got == {"good": 1.9, "bad": -2.5}


def test_lexicon_rejects_and_repeats(spark):
    from plazalens.operators.sentiment import lexicon_frame, lexicon_rejects, read_lexicon, sentiment_scores
    path = scratch_path(spark, "t-lex2")
    spark.createDataFrame([("Good\t1.9",), ("good\t-0.5",), ("broken line",), ("nan\tx",), ("",), ("\t2.0",)],
                          "v string").coalesce(1).write.text(path)
    assert {r.token: r.valence for r in read_lexicon(spark, path).collect()} == {"good": 1.9}
    assert sorted(r.line for r in lexicon_rejects(spark, path).collect()) == ["\t2.0", "broken line", "nan\tx"]
    one = spark.createDataFrame([("1", "good")], "review_id string, text string")
    twice = lexicon_frame(spark, [("Good", 1.9), ("good", 1.9)])
    assert round(sentiment_scores(one, twice).first().sentiment_score, 4) == 0.4404


def test_units_with_special_names(spark):
    """Unit names are decoded from file URIs: spaces, '+' and accents survive."""
    base = scratch_path(spark, "t-names")
    raw, lake = f"{base}/raw", f"{base}/lake"
    t = 1609909927056
    units = {"New York": [("u1", "g1", 5.0, "a", t)], "a+b": [("u2", "g2", 4.0, "b", t)],
             "Bogotá": [("u3", "g3", 3.0, "c", t)]}
    _write_units(spark, raw, units)
    assert _names(list_units(spark, raw)) == sorted(units)

    def reader(s, paths, root):
        return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root)

    run = run_incremental(spark, "r", raw, lake, "google", "reviews", reader, md.silver_google_reviews)
    assert sorted(run.units) == sorted(units) and run.silver_rows == 3
    got = {r.source_file: r.user_id for r in read_layer(spark, lake, "silver", "google", "reviews").collect()}
    assert got == {"New York": "u1", "a+b": "u2", "Bogotá": "u3"}
    assert run_incremental(spark, "r", raw, lake, "google", "reviews", reader, md.silver_google_reviews).units == []


def test_unit_root_with_space(spark):
    """A root the URI spells differently (encoded space) takes the fallback path."""
    base = scratch_path(spark, "t root with space")
    raw = f"{base}/raw"
    t = 1609909927056
    _write_units(spark, raw, {"TX": [("u1", "g1", 5.0, "a", t)], "New York": [("u2", "g2", 4.0, "b", t)]})
    assert _names(list_units(spark, raw)) == ["New York", "TX"]
    df = read_json(spark, raw, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=raw)
    assert {r.source_file: r.user_id for r in df.collect()} == {"TX": "u1", "New York": "u2"}


def test_missing_or_empty_raw_root(spark):
    import os
    base = scratch_path(spark, "t-none")
    os.makedirs(f"{base}/empty", exist_ok=True)

    def reader(s, paths, root):
        return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root)

    for raw in (f"{base}/missing", f"{base}/empty"):
        assert list_units(spark, raw).count() == 0
        run = run_incremental(spark, "r", raw, f"{base}/lake", "google", "reviews", reader, md.silver_google_reviews)
        assert run.units == []


def test_scale_conf():
    from plazalens.session import scale_conf
    conf = scale_conf(5 * 2**40)
    assert conf["spark.sql.shuffle.partitions"] == "20480"
    assert scale_conf(10, cores=8)["spark.sql.shuffle.partitions"] == "8"
