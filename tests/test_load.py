"""Strict loads: a violation loads nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plazalens.session import scratch_path
from plazalens.sources.load import LoadError, load_table

SCHEMA = "user_id string, gmap_id string, rating string, text string, date date, review_id string"
DAY = dt.date(2020, 1, 2)


def exists(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def test_a_clean_load_is_written_in_contract_types(spark):
    path = scratch_path(spark, "t-load")
    df = spark.createDataFrame([("u", "g", "4", "x" * 9000, DAY, "ug")], SCHEMA)
    out = load_table(df, "reviews_google", path)
    assert [tuple(r) for r in out.collect()] == [("u", "ug", 4, "g", DAY)]
    assert dict(out.dtypes)["rating"] == "int"
    with pytest.raises(LoadError, match="exists"):
        load_table(df, "reviews_google", path)


@pytest.mark.parametrize("row,why", [
    (("u", "g", "4", "t", None, "ug"), "date is null: 1 rows"),
    (("u", "g", "four", "t", DAY, "ug"), "rating does not cast to int: 1 rows"),
    (("u" * 1001, "g", "4", "t", DAY, "ug"), "user_id is longer than 1000: 1 rows"),
    ((None, "g", "4", "t", DAY, "ug"), "user_id is null: 1 rows"),
])
def test_a_bad_row_fails_the_whole_load(spark, row, why):
    path = scratch_path(spark, "t-load-bad")
    df = spark.createDataFrame([("u", "g", "4", "t", DAY, "ug"), row], SCHEMA)
    with pytest.raises(LoadError, match=why):
        load_table(df, "reviews_google", path)
    assert not exists(spark, path)


def test_an_empty_table_loads(spark):
    path = scratch_path(spark, "t-load-empty")
    assert load_table(spark.createDataFrame([], SCHEMA), "reviews_google", path).count() == 0


def test_appends_are_whole_or_refused(spark):
    from plazalens.sources.load import append_table, drop_unpublished, read_table

    path = scratch_path(spark, "t-append")

    def rows(*ids, rating="4"):
        return spark.createDataFrame([("u", "g", rating, "t", DAY, i) for i in ids], SCHEMA)

    def ids():
        return sorted(r.review_id for r in read_table(spark, path, "reviews_google").collect())

    with pytest.raises(LoadError, match="holds no load"):
        read_table(spark, path, "reviews_google")
    append_table(rows("a", "b"), "reviews_google", path)
    assert sorted(r.review_id for r in append_table(rows("c"), "reviews_google", path).collect()) == ["a", "b", "c"]
    for bad, why in ((rows("c", "d"), "is loaded already: 1"), (rows("e", "e"), "comes twice: 1"),
                     (rows("f", rating="four"), "does not cast"), (rows("a", "b"), "is loaded already: 2")):
        with pytest.raises(LoadError, match=why):
            append_table(bad, "reviews_google", path)
        assert ids() == ["a", "b", "c"] and drop_unpublished(spark, path) == []
    append_table(rows(), "reviews_google", path)
    assert ids() == ["a", "b", "c"]


def test_a_load_that_died_or_lost_the_race_is_not_seen(spark, monkeypatch):
    from plazalens.sources import load as L

    path = scratch_path(spark, "t-race")
    df = spark.createDataFrame([("u", "g", "4", "t", DAY, "a")], SCHEMA)
    L.append_table(df, "reviews_google", path)
    with pytest.raises(L.LoadError, match="at the same time"):
        L._publish(spark, path, 1, [])
    with monkeypatch.context() as m:  # dies without a chance to clean up
        m.setattr(L, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        m.setattr(L, "_drop", lambda *a: None)
        with pytest.raises(RuntimeError):
            L.append_table(df.withColumn("review_id", F.lit("b")), "reviews_google", path)
    assert L.read_table(spark, path, "reviews_google").count() == 1
    assert len(L.drop_unpublished(spark, path)) == 1
    L.append_table(df.withColumn("review_id", F.lit("b")), "reviews_google", path)
    assert L.read_table(spark, path, "reviews_google").count() == 2
