"""Versioned runs: late and withdrawn keys, grown and withdrawn units, global dedup, added columns."""

import random

import pytest
from pyspark.sql import functions as F

from plazalens.plans import medallion as md
from plazalens.plans.versioned import run_versioned, run_versioned_stage
from plazalens.schemas import GOOGLE_REVIEWS_RAW
from plazalens.session import scratch_path
from plazalens.sources.io import declare_layer, layer_path, read_declared, read_json, read_layer, remove_path, write_parquet

COLUMNS = ["user_id", "gmap_id", "rating", "text", "time"]


def put(spark, raw, unit, rows):
    """Replaces a raw unit (a folder of JSON lines)."""
    lines = [f'{{"user_id": "{u}", "gmap_id": "{g}", "rating": 4.0, "text": "{t}", "time": 1600000000000}}' for u, g, t in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{raw}/{unit}")


def reader(s, paths, root):
    return read_json(s, paths, GOOGLE_REVIEWS_RAW, with_source=True, unit_root=root, with_rejects=True)


class Lake:
    def __init__(self, spark, dedup=None):
        base = scratch_path(spark, "t-versioned")
        self.spark, self.raw, self.lake, self.dedup = spark, f"{base}/raw", f"{base}/lake", dedup

    def silver(self):
        return run_versioned(self.spark, "r", self.raw, self.lake, "google", "reviews", reader, md.silver_google_reviews,
                             dedup_columns=self.dedup)

    def gold(self, places):
        keys = self.spark.createDataFrame([(g,) for g in places], "gmap_id string")
        return run_versioned_stage(self.spark, "r", "r:gold", self.lake, "google", ("silver", "reviews"), ("gold", "reviews"),
                                   lambda r: md.gold_google_reviews(r, keys), keys=keys, on="gmap_id")

    def scores(self):
        return run_versioned_stage(self.spark, "r:gold", "r:len", self.lake, "google", ("gold", "reviews"), ("gold", "lengths"),
                                   lambda r: r.select("review_id", F.length("text").alias("n"), "source_file"))

    def rows(self, layer="gold", entity="reviews", columns=("source_file", "user_id", "gmap_id")):
        return sorted(tuple(r) for r in read_layer(self.spark, self.lake, layer, "google", entity).select(*columns).collect())


@pytest.mark.parametrize("order", [["g1", "g2"], ["g2", "g1"]])
def test_late_places_bring_their_reviews(spark, order):
    k = Lake(spark)
    put(spark, k.raw, "a", [("u1", "g1", "x"), ("u2", "g2", "x")])
    put(spark, k.raw, "b", [("u3", "g3", "x")])
    put(spark, k.raw, "c", [("u4", order[1], "x")])
    k.silver()
    assert k.gold(order[:1]).made == ["a", "b", "c"]
    assert k.gold(order).made == ["a", "c"]  # unit b holds no review of the late place
    assert k.rows() == sorted([("a", "u1", "g1"), ("a", "u2", "g2"), ("c", "u4", order[1])])
    assert k.gold(order) == ([], [], 0, 0)
    assert k.gold(["g3", order[0]]).made == ["a", "b", "c"]  # one place came, one went
    assert {g for _, _, g in k.rows()} == {"g3", order[0]}


def test_grown_changed_and_withdrawn_units(spark):
    k = Lake(spark)
    put(spark, k.raw, "01", [("u1", "g1", "x")])
    put(spark, k.raw, "1", [("u2", "g1", "x")])
    put(spark, k.raw, "gone", [("u3", "g1", "x")])
    assert k.silver().made == ["01", "1", "gone"] and k.gold(["g1"]).rows == 3 and k.scores().rows == 3
    assert k.silver() == ([], [], 0, 0) and k.scores() == ([], [], 0, 0)
    put(spark, k.raw, "01", [("u1", "g1", "longer"), ("u5", "g1", "x")])
    remove_path(spark, f"{k.raw}/gone")
    assert k.silver()[:2] == (["01"], ["gone"])
    assert k.gold(["g1"])[:2] == (["01"], ["gone"]) and k.scores()[:2] == (["01"], ["gone"])
    assert k.rows() == [("01", "u1", "g1"), ("01", "u5", "g1"), ("1", "u2", "g1")]
    assert k.rows(entity="lengths", columns=("source_file", "review_id", "n")) == [("01", "u1g1", 6), ("01", "u5g1", 1), ("1", "u2g1", 1)]
    put(spark, k.raw, "1", [])  # a unit that is empty now
    k.silver(), k.gold(["g1"])
    assert {u for u, _, _ in k.rows()} == {"01"}


def test_a_stage_that_died_is_repeated(spark, monkeypatch):
    from plazalens.plans import versioned as V
    k = Lake(spark)
    put(spark, k.raw, "a", [("u1", "g1", "x")])
    k.silver(), k.gold([])
    with monkeypatch.context() as m:
        m.setattr(V, "_record", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            k.gold(["g1"])
    assert k.gold(["g1"]).made == ["a"] and k.rows() == [("a", "u1", "g1")]


def test_global_dedup_equals_one_dedup_over_all_units(spark):
    k = Lake(spark, COLUMNS)
    rng = random.Random(1)
    now = {}

    def rows(n):
        return [(f"u{rng.randrange(6)}", f"g{rng.randrange(2)}", "x") for _ in range(n)]

    def step(**units):
        for name, some in units.items():
            now[name] = some
            put(spark, k.raw, name, some)
        run = k.silver()
        assert sorted(r[1:] for r in k.rows("silver")) == sorted({(u, g) for some in now.values() for u, g, _ in some})
        return run

    step(b=rows(6), c=rows(3))
    step(a=rows(8))
    step(b=rows(4), d=rows(5))  # a changed unit may give up rows that others hold
    del now["a"]
    remove_path(spark, f"{k.raw}/a")
    step()
    step(e=[("u1", "g1", "x")] * 3)


def test_added_and_missing_columns_read_back_whole(spark):
    path = layer_path(scratch_path(spark, "t-schema"), "silver", "x", "y")

    def write(unit, rows, schema):
        df = spark.createDataFrame([(*r, unit) for r in rows], f"{schema}, source_file string")
        write_parquet(df, path, mode="overwrite", partition_by=["source_file"])
        declare_layer(spark, path, df.schema)

    write("a", [("1", "old")], "id string, was string")
    write("b", [("2", 7)], "id string, new int")
    write("b", [("2", 8)], "id string, new int")
    assert sorted(tuple(r) for r in read_declared(spark, path).collect()) == [("1", "old", None, "a"), ("2", None, 8, "b")]
    with pytest.raises(ValueError, match="new is int"):
        declare_layer(spark, path, spark.createDataFrame([], "new string").schema)
