"""Streaming layers: a batch that died and ran again, copies over batches, rejects, later stages by the ledger, disk."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plazalens.plans import catalog
from plazalens.plans import medallion as md
from plazalens.plans.incremental import run_stage
from plazalens.schemas import GOOGLE_REVIEWS_RAW
from plazalens.session import scratch_path
from plazalens.sources.io import read_layer
from plazalens.sources.ledger import read_ledger
from plazalens.streaming import layers as L

COLUMNS = GOOGLE_REVIEWS_RAW.fieldNames()


def line(user, place="g1", text="x"):
    return f'{{"user_id": "{user}", "gmap_id": "{place}", "rating": 4.0, "text": "{text}", "time": 1600000000000}}'


class Stream:
    def __init__(self, spark):
        base = scratch_path(spark, "t-layers")
        self.spark, self.raw, self.lake, self.ckpt = spark, f"{base}/raw", f"{base}/lake", f"{base}/_ckpt"

    def put(self, name, lines):
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{self.raw}/{name}")

    def run(self, transform=md.silver_google_reviews, **kw):
        L.stream_layers(self.spark, "r", self.raw, GOOGLE_REVIEWS_RAW, self.lake, "google", "reviews", self.ckpt,
                        transform, **{"dedup_columns": COLUMNS, **kw})

    def users(self, layer="silver"):
        return sorted(r.user_id for r in read_layer(self.spark, self.lake, layer, "google", "reviews").collect())


def test_copies_over_batches_and_runs(spark):
    s = Stream(spark)
    s.put("a", [line("u1"), line("u2"), line("u1")])
    s.put("b", [line("u2"), line("u3"), line("u3", text="other")])
    s.run(max_files_per_trigger=1)
    assert s.users() == ["u1", "u2", "u3", "u3"]
    s.run()  # nothing new
    s.put("c", [line("u1"), line("u4")])
    s.run()
    assert s.users() == s.users("bronze") == ["u1", "u2", "u3", "u3", "u4"]
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 3


@pytest.mark.parametrize("step", ["silver", "ledger"])
def test_a_batch_that_died_leaves_no_second_copy(spark, monkeypatch, step):
    s = Stream(spark)
    s.put("a", [line("u1"), line("u2")])
    s.run()
    s.put("b", [line("u2"), line("u3")])

    put, append = L._put, L.append_ledger

    def died(*args):
        if step == "silver":
            put(*args)
            if "/silver/" not in args[1]:
                return
        raise RuntimeError("killed")

    monkeypatch.setattr(L, "_put" if step == "silver" else "append_ledger", died)
    with pytest.raises(PySparkException):
        s.run()
    monkeypatch.setattr(L, "_put", put)
    monkeypatch.setattr(L, "append_ledger", append)
    assert s.users() == ["u1", "u2", "u3"]  # written, not recorded
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 1
    s.run()
    assert s.users() == s.users("bronze") == ["u1", "u2", "u3"]
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 2


def test_rejects_stay_and_later_stages_follow(spark):
    s = Stream(spark)
    s.put("a", [line("u1"), "{broken", "{broken", line("u5", "g2")])
    s.run()
    s.put("b", ["{broken", line("u2")])
    s.run()
    assert s.users() == ["u1", "u2", "u5"]
    bad = read_layer(spark, s.lake, "rejects", "google", "reviews")
    assert [r._corrupt_record for r in bad.collect()] == ["{broken"] * 3 and bad.select("source_file").distinct().count() == 2
    places = spark.createDataFrame([("g1",)], "gmap_id string")

    def gold():
        return run_stage(spark, "r", "r:gold", s.lake, "google", ("silver", "reviews"), ("gold", "reviews"),
                         lambda r: md.gold_google_reviews(r, places))

    assert len(gold().units) == 2 and gold().units == []
    assert s.users("gold") == ["u1", "u2"]


def test_no_files_and_another_checkpoint(spark):
    s = Stream(spark)
    s.put("a", [])
    s.run()
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 0
    s.put("b", [line("u1")])
    s.run()
    s.ckpt += "2"  # a second stream into the same layers never writes the first one's units
    s.put("c", [line("u2")])
    s.run()
    assert s.users() == ["u1", "u1", "u2"]
    assert read_layer(spark, s.lake, "silver", "google", "reviews").select(F.count_distinct("source_file")).first()[0] == 2


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


@pytest.mark.parametrize("hash_prefilter", [False, True])
def test_a_run_leaves_no_shuffle_files(spark, hash_prefilter):
    s = Stream(spark)
    s.put("a", [line(f"u{i % 300}") for i in range(400)])
    s.put("b", [line(f"u{i}") for i in range(200, 500)])
    before = shuffle_files(spark)
    s.run(lambda b: md.silver_google_reviews(b, hash_prefilter=hash_prefilter), max_files_per_trigger=1)
    assert not shuffle_files(spark) - before
    assert s.users() == s.users("bronze") == sorted(f"u{i}" for i in range(500))


def test_batches_by_bytes(spark, monkeypatch):
    s = Stream(spark)
    for name, users in (("a", ("u1", "u2")), ("b", ("u2", "u3")), ("c", ("u3", "u1", "u4"))):
        s.put(name, [line(u) for u in users])
    monkeypatch.setattr(L, "BATCH_BYTES", 1)
    s.run()
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 3  # a file at least
    assert s.users() == s.users("bronze") == ["u1", "u2", "u3", "u4"]
    s.put("d", [line("u4"), line("u5")])
    s.put("e", [line("u5"), line("u6")])
    s.run(max_bytes_per_trigger=1 << 20)
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 4
    assert s.users() == ["u1", "u2", "u3", "u4", "u5", "u6"]


def test_without_state_a_run_is_one_batch(spark, monkeypatch):
    monkeypatch.setattr(L, "BATCH_BYTES", 1)
    s = Stream(spark)
    s.put("a", [line("u1"), line("u2")])
    s.put("b", [line("u2"), line("u3")])
    s.run(dedup_columns=None)
    assert read_ledger(spark, f"{s.lake}/_ledger", "r").count() == 1 and s.users() == ["u1", "u2", "u3"]


def test_state_store_on_disk_and_an_older_checkpoint(spark):
    key, old = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    was = {k: spark.conf.get(k, None) for k in L.STREAM_CONF}
    for first in (None, old):
        s = Stream(spark)
        s.put("a", [line("u1"), line("u2")])
        if first:
            spark.conf.set(key, first)
        try:
            s.run()
        finally:
            if first:
                spark.conf.unset(key)
        s.put("b", [line("u2"), line("u3")])
        s.run()
        assert s.users() == ["u1", "u2", "u3"]
        kinds = {p.suffix for p in Path(f"{s.ckpt}/state").rglob("*.*") if not p.name.startswith(".")}
        assert (".delta" in kinds) == bool(first) and (".zip" in kinds) != bool(first)
    assert {k: spark.conf.get(k, None) for k in L.STREAM_CONF} == was


def test_query_keeps_its_raw_files_compressed(spark, monkeypatch):
    base = scratch_path(spark, "t-layers-query")
    rows = [(i, i % 7 + 1, i % 7 + 1, float(i % 50 + 1), "NRA"[i % 3], "OF"[i % 2], datetime(1995, 1 + i % 12, 3)) for i in range(200)]
    names = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
    rows = spark.createDataFrame(rows + rows[:40], names)
    rows.withColumn("l_linenumber", F.col("l_linenumber").cast("int")).write.parquet(f"{base}/in/lineitem.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{base}/{name}")
    got = catalog.QUERIES["stream_silver_reviews"](spark, f"{base}/in")
    want = catalog.QUERIES["silver_google_reviews"](spark, f"{base}/in")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    raw = [p.name for p in Path(f"{base}/stream-layers/raw").rglob("part-*")]
    assert raw and all(x.endswith(".json.gz") for x in raw)
