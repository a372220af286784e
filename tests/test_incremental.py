"""Incremental stages: units once, unit names as text, blank and rejected input."""

from pyspark.sql import functions as F

from plazalens.operators.sentiment import lexicon_frame, sentiment_table
from plazalens.plans import medallion as md
from plazalens.plans.incremental import run_incremental, run_stage
from plazalens.schemas import GOOGLE_REVIEWS_RAW
from plazalens.session import scratch_path
from plazalens.sources.io import read_json, read_layer
from plazalens.sources.ledger import read_ledger


def write_unit(spark, raw, unit, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{raw}/{unit}")


def review(user, text="good", rating="5.0"):
    return f'{{"user_id": "{user}", "gmap_id": "g1", "rating": {rating}, "text": "{text}", "time": 1600000000000}}'


def reader(s, paths, root):
    return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root, with_rejects=True)


def ingest(spark, raw, lake):
    return run_incremental(spark, "r", raw, lake, "google", "reviews", reader, md.silver_google_reviews)


def gold(spark, lake):
    places = spark.createDataFrame([("g1",)], "gmap_id string")
    return run_stage(spark, "r", "r:gold", lake, "google", ("silver", "reviews"), ("gold", "reviews"),
                     lambda r: md.gold_google_reviews(r, places))


def test_each_stage_processes_a_unit_once(spark):
    base = scratch_path(spark, "t-inc")
    raw, lake = f"{base}/raw", f"{base}/lake"
    write_unit(spark, raw, "01", [review("a"), review("b", "bad")])
    assert ingest(spark, raw, lake).units == ["01"] and gold(spark, lake).units == ["01"]
    assert ingest(spark, raw, lake).units == [] and gold(spark, lake).units == []
    write_unit(spark, raw, "1", [review("c")])
    run = ingest(spark, raw, lake)
    assert (run.units, run.bronze_rows, run.silver_rows) == (["1"], 1, 1)
    assert gold(spark, lake) == (["1"], 0, 1, 0)
    rows = read_layer(spark, lake, "gold", "google", "reviews")
    assert sorted((r.source_file, r.user_id) for r in rows.collect()) == [("01", "a"), ("01", "b"), ("1", "c")]
    assert read_layer(spark, lake, "gold", "google", "reviews", unit="01").count() == 2
    lex = lexicon_frame(spark, [("good", 1.9), ("bad", -2.5)])
    run = run_stage(spark, "r:gold", "r:sentiment", lake, "google", ("gold", "reviews"), ("gold", "sentiment"),
                    lambda r: sentiment_table(r, lex, keep=["source_file"]))
    assert run.silver_rows == 3
    scores = read_layer(spark, lake, "gold", "google", "sentiment")
    assert sorted((r.source_file, r.review_id, r.sentiment) for r in scores.collect()) == [
        ("01", "ag1", "positive"), ("01", "bg1", "negative"), ("1", "cg1", "positive")]
    assert read_ledger(spark, f"{lake}/_ledger").count() == 6


def test_blank_first_unit_and_no_silver_row(spark):
    base = scratch_path(spark, "t-blank")
    raw, lake = f"{base}/raw", f"{base}/lake"
    write_unit(spark, raw, "blank", ["", " "])
    assert ingest(spark, raw, lake).silver_rows == 0
    assert read_layer(spark, lake, "silver", "google", "reviews").count() == 0
    write_unit(spark, raw, "nokey", ['{"gmap_id": "g1", "text": "no user"}'])
    assert ingest(spark, raw, lake)[:3] == (["nokey"], 1, 0)
    empty = read_layer(spark, lake, "silver", "google", "reviews")
    assert empty.count() == 0 and "source_file" in empty.columns
    assert gold(spark, lake).silver_rows == 0
    assert read_layer(spark, lake, "gold", "google", "reviews").count() == 0


def test_bad_records_are_kept_and_counted(spark):
    base = scratch_path(spark, "t-bad")
    raw, lake = f"{base}/raw", f"{base}/lake"
    write_unit(spark, raw, "u", [review("a"), review("b", rating='"five"'), '{"user_id": "broken'])
    run = ingest(spark, raw, lake)
    assert (run.bronze_rows, run.silver_rows, run.rejected_rows) == (3, 1, 2)
    rejects = read_layer(spark, lake, "rejects", "google", "reviews")
    assert rejects.filter(F.col("_corrupt_record").contains("five") | F.col("_corrupt_record").contains("broken")).count() == 2
    assert [r.user_id for r in read_layer(spark, lake, "silver", "google", "reviews").collect()] == ["a"]


def test_plain_read_fails_on_a_bad_record(spark):
    import pytest
    base = scratch_path(spark, "t-fail")
    write_unit(spark, base, "u", [review("a"), review("b", rating='"five"')])
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        read_json(spark, f"{base}/u", GOOGLE_REVIEWS_RAW).collect()


def test_a_units_rows_are_spread_over_tasks(spark):
    from plazalens.plans.incremental import of_units
    from plazalens.sources.io import layer_path, read_declared
    base = scratch_path(spark, "t-spread")
    raw, lake = f"{base}/raw", f"{base}/lake"
    for unit in ("01", "1"):
        write_unit(spark, raw, unit, [review(f"u{unit}-{i}") for i in range(400)])
    ingest(spark, raw, lake)
    bronze = of_units(read_declared(spark, layer_path(lake, "bronze", "google", "reviews")), ["01"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = md.silver_google_reviews(bronze.drop("_corrupt_record")).select("user_id", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r.user_id for r in rows) == sorted(f"u01-{i}" for i in range(400))
    assert len({r.p for r in rows}) > 1  # a join by unit left them all in one task
