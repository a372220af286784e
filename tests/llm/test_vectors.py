import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plazalens.llm.ann import Coder, nearest
from plazalens.llm.queries import op5_nearest, op9_top_products
from plazalens.llm.topk import _pruned, top_products

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, id string, score int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def pad(v, n):
    return list(v) + [0] * (n - len(v))


def brute_products(rows, wanted, k=10):
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    asks = {}
    for i, v in rows:
        if wanted(i):
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, a in asks.items():
        got = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in rows if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got)]
    return sorted(out)


def brute_nearest(rows, wanted, k=10):
    rows = [(i, list(map(float, v))) for i, v in rows if i is not None and usable(v) and any(v)]
    asks = {}
    for i, v in rows:
        if wanted(i):
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, a in asks.items():
        n = max([len(a)] + [len(v) for _, v in rows])
        got = sorted((math.dist(pad(a, n), pad(v, n)), i) for i, v in rows if i != q)[:k]
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(got)]
    return sorted(out)


def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, np.float32(rng.standard_normal(12) * (1 + i % 7)).tolist()) for i in range(700)]
    rows += [(800, None), (None, [1.0] * 12), (900, [float("nan")] * 12), (901, [float("inf")] + [0.0] * 11),
             (902, [None] + [1.0] * 11), (1000, [0.0] * 12), (1001, []), (1002, [2.0, 3.0]), (1100, [0.5] * 12),
             (1100, [0.5] * 12), (1100, [0.25] * 12), (1101, [0.5] * 12), (1200, [1e6] * 12)]
    return rows


def answer(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("bucket,chunk", [(8192, 4096), (60, 4)])
def test_products_match_brute_force(spark, bucket, chunk):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    out = top_products(df, F.col("id") % 50 == 0, bucket_rows=bucket, chunk_queries=chunk)
    assert answer(out) == brute_products(rows, lambda i: i % 50 == 0)


def test_products_beyond_64_bits_do_not_crash(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30]), (3, [1.0])], "vec_id long, embedding array<double>")
    assert [(i, s) for _, _, i, s in answer(top_products(df, F.col("id") == 0))] == [
        (1, (1 << 63) - 1), (3, (1 << 63) - 1), (2, -(1 << 63))]


def test_pruning_keeps_every_row_that_reaches_the_bound():
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((3000, 5)) * rng.uniform(0.1, 9, (3000, 1))
    norms = np.sqrt((rows * rows).sum(axis=1))
    order = np.argsort(-norms)
    rows, norms = rows[order], norms[order]
    for _ in range(60):
        q = rng.standard_normal(5)
        p = rows @ q
        for bound in np.quantile(p, [0.5, 0.9, 0.99, 0.999, 1]):
            kept = _pruned(rows, norms, q, float(np.sqrt(q @ q)), float(bound))
            assert set(np.flatnonzero(p >= bound)) <= set(kept)


@pytest.mark.parametrize("block,chunk", [(8192, 4096), (60, 4)])
def test_nearest_on_odd_rows(spark, block, chunk):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = answer(nearest(df, F.col("id") % 50 == 0, block_rows=block, chunk_queries=chunk))
    want = brute_nearest(rows, lambda i: i % 50 == 0)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    exact = {(w[0], w[2]): w[3] for w in want}
    hits = [g for g in got if (g[0], g[2]) in exact]
    assert len(hits) >= 0.9 * len(want)
    assert all(abs(g[3] - exact[g[0], g[2]]) <= 1e-12 * max(1, g[3]) for g in hits)


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = {(q, i) for q, _, i, _ in brute_nearest(rows, lambda i: i % 100 == 0)}
    got = {(q, i) for q, _, i, _ in answer(op5_nearest(spark, SF))}
    assert len(got) == len(want) and len(got & want) >= 0.97 * len(want)


def test_product_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert answer(op9_top_products(spark, SF)) == brute_products(rows, lambda i: i % 100 == 0)


def test_bounds_hold_for_nearly_all_rows():
    rng = np.random.default_rng(0)
    rows, q = rng.standard_normal((4000, 64)), rng.standard_normal((1, 64))
    coder = Coder(rows.mean(axis=0))
    codes, length, own = coder.encode(rows)
    unit, q_length = coder.rotate(q)
    low, high = coder.bounds(codes, length, own, unit[0], q_length[0], 3.0)
    d = ((rows - q) ** 2).sum(axis=1)
    assert ((low <= d + 1e-9) & (d <= high + 1e-9)).mean() > 0.99 and (high - low).mean() < 2 * d.mean()


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nearest(df, F.col("id") == 0).collect() == []
    assert top_products(df, F.col("id") == 0).collect() == []


def test_one_long_vector_widens_no_other(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(300, [0.1] * 50_000), (301, [0.1] * 8 + [9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = (F.col("id") % 100 == 0) | (F.col("id") == 301)
    got, want = answer(nearest(df, wanted)), brute_nearest(rows, lambda i: i % 100 == 0 or i == 301)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 * max(1, w[3]) for g, w in zip(got, want))
    assert answer(top_products(df, wanted)) == brute_products(rows, lambda i: i % 100 == 0 or i == 301)


def test_rows_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], "x", 1) for i in range(200)], SCHEMA)
    for out in (nearest(df, F.col("id") % 10 == 0, chunk_queries=4), top_products(df, F.col("id") % 10 == 0, chunk_queries=4)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan and "Repartition" not in plan
