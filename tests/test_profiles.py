"""Profiles per unit: merged equals one profile of everything, only changed units are read, odd columns."""

import pytest
from pyspark.sql import functions as F
from test_versioned import Lake, put

from plazalens.operators.quality import profile
from plazalens.plans import profiles as P

SOURCE = ("silver", "reviews")


def counts(df):
    return sorted((r.ordinal, r.column_name, r.data_type, r.rows, r.non_null, r.nulls) for r in df.collect())


def units(spark, n=9000):
    """A hot unit, a small one and values that units share; columns of many types."""
    i = F.col("id")
    return spark.range(n).select(
        (i % 4000).alias("k"), F.when(i % 3 > 0, (i % 7).cast("string")).alias("few"),
        F.when(i % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("zero"), F.lit(None).cast("date").alias("none"),
        F.array(i % 5, i % 3).alias("list"), F.create_map(F.lit("a"), i % 11).alias("map"),
        F.struct(F.create_map(F.lit("a"), i % 11).alias("m")).alias("deep"), F.lit("x").alias("odd `name"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), i % 40)).alias("source_file"))


def test_merged_units_equal_one_profile(spark):
    df = units(spark).withColumnRenamed("odd `name", "odd name")
    merged = P.merge_profiles(P.unit_profiles(df))
    assert counts(merged) == counts(profile(df.drop("source_file")))
    got = {r.column_name: r.distinct_values for r in merged.collect()}
    want = {"k": 4000, "few": 7, "zero": 1, "none": 0, "list": 15, "map": 11, "deep": 11, "odd name": 1}
    assert set(got) == set(want)
    for c, n in want.items():
        assert abs(got[c] - n) <= 4 * P.DISTINCT_ERROR * n, c
    one = P.merge_profiles(P.unit_profiles(df.withColumn("source_file", F.lit("all"))))
    # sketches of the units, united, say what one sketch of all rows says
    assert {r.column_name: r.distinct_values for r in one.collect()}["k"] == pytest.approx(got["k"], rel=P.DISTINCT_ERROR)


def test_only_changed_units_are_profiled(spark):
    k = Lake(spark)
    put(spark, k.raw, "a", [(f"u{i}", "g1", "x") for i in range(30)])
    put(spark, k.raw, "b", [(f"u{i}", "g2", "y") for i in range(20, 60)])
    k.silver()

    def run():
        return P.run_profile(spark, "r", k.lake, "google", SOURCE)

    def users(unit=None):
        rows = {r.column_name: r for r in P.layer_profile(spark, k.lake, "google", SOURCE, unit).collect()}
        return rows["user_id"].rows, rows["user_id"].distinct_values

    assert run().made == ["a", "b"] and run() == ([], [], 0, 0)
    assert users() == (70, 60) and users("a") == (30, 30)
    put(spark, k.raw, "a", [(f"u{i}", "g1", "x") for i in range(50)])  # grown
    put(spark, k.raw, "c", [("u999", "g1", "x")])
    k.silver()
    assert run().made == ["a", "c"]
    assert users() == (91, 61)
    from plazalens.sources.io import remove_path
    remove_path(spark, f"{k.raw}/b")
    k.silver()
    assert run().withdrawn == ["b"]
    assert users() == (51, 51)


def test_added_column_empty_and_no_column(spark):
    old = P.unit_profiles(spark.createDataFrame([(1, "a"), (2, "a")], "x long, source_file string"))
    new = P.unit_profiles(spark.createDataFrame([(3, "v", "b")], "x long, y string, source_file string"))
    assert counts(P.merge_profiles(old.unionByName(new))) == [(0, "x", "bigint", 3, 3, 0), (1, "y", "string", 3, 1, 2)]
    assert P.merge_profiles(old.limit(0)).collect() == []
    with pytest.raises(ValueError):
        P.unit_profiles(spark.createDataFrame([("a",)], "source_file string"))
