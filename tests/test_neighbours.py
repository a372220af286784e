"""The k nearest places of every place against brute force: clusters, hot spots, ties, odd rows, plans."""

import math
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from plazalens.operators import neighbours as N

SCHEMA = "place_id long, latitude double, longitude double"


def brute(rows, k):
    at = {}
    for i, x, y in rows:
        if i is not None and x is not None and y is not None and math.isfinite(x) and math.isfinite(y):
            at[i] = min(at.get(i, (math.inf, math.inf)), (x, y))
    out = {}
    for i, (x, y) in at.items():
        near = sorted((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), j) for j, (a, b) in at.items() if j != i)
        out.update({(i, r): (j, d) for r, (d, j) in enumerate(near[:k], 1)})
    return out


def got(spark, rows, k, **kw):
    df = N.nearest_of_all(spark.createDataFrame(rows, SCHEMA), k, **kw)
    assert df.columns == ["place_id", "rank", "neighbour", "distance"]
    rows = df.collect()
    out = {(r.place_id, r["rank"]): (r.neighbour, r.distance) for r in rows}
    assert len(out) == len(rows)
    return out


def clustered(n, seed):
    """A third on one spot, a third in a dense town, the rest spread wide or on a coarse lattice (ties)."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.randrange(6)
        if kind < 2:
            rows.append((i, 30.25, -97.75))
        elif kind < 4:
            rows.append((i, 40.0 + rng.random() / 1000, -74.0 + rng.random() / 1000))
        elif kind == 4:
            rows.append((i, rng.uniform(-80, 80), rng.uniform(-180, 180)))
        else:
            rows.append((i, float(rng.randrange(30, 36)), float(rng.randrange(-100, -94))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, block", [(1, 1), (5, 16), (5, 1024), (12, 40)])
def test_equals_brute_force(spark, k, block):
    rows = clustered(700, k)
    assert got(spark, rows, k, block_points=block) == brute(rows, k)


def test_many_tasks_and_slices_of_bounds(spark, monkeypatch):
    monkeypatch.setattr(N, "POINTS_PER_TASK", 40)
    monkeypatch.setattr(N, "BLOCKS_PER_SLICE", 9)
    monkeypatch.setattr(N, "_TILE", 64)
    rows = clustered(500, 3)
    assert got(spark, rows, 4, block_points=8) == brute(rows, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0.0, 0.0), (2, -0.0, 0.0), (3, 0.0, 5e-324), (4, None, 1.0), (5, nan, 1.0), (6, 1.0, inf), (None, 0.0, 0.0),
            (7, 1e6, 1e6), (8, 1.0, 1.0), (8, 0.5, 9.0), (8, 0.5, 9.0), (9, 3.0, 4.0)]
    assert got(spark, rows, 3) == brute(rows, 3)
    assert got(spark, rows, 50) == brute(rows, 50)  # fewer places than k
    assert got(spark, [(1, 2.0, 3.0)], 3) == {} and got(spark, [], 3) == {}
    same = [(i, 2.0, 3.0) for i in range(60)]  # one spot only
    assert got(spark, same, 4) == brute(same, 4)
    with pytest.raises(ValueError):
        N.nearest_of_all(spark.createDataFrame(rows, SCHEMA), 0)


def test_extra_columns_and_text_ids(spark):
    df = spark.createDataFrame([("b", 1, 2, "x"), ("a", 1, 3, "y"), ("c", 9, 9, None)],
                               "gmap_id string, latitude int, longitude int, block string")
    rows = N.nearest_of_all(df, 1, id_col="gmap_id").collect()
    assert {(r.gmap_id, r.neighbour, r.distance) for r in rows} == {("a", "b", 1.0), ("b", "a", 1.0), ("c", "a", 10.0)}


def test_work_per_point_does_not_grow(spark):
    """Four times the points at the same block size: as many blocks asked per point, and no plan lists pairs."""
    rng = np.random.default_rng(1)

    def asked(side, cell=64):
        x, y, block = (np.repeat(np.arange(side * side) // side, cell) + rng.random(side * side * cell),
                       np.repeat(np.arange(side * side) % side, cell) + rng.random(side * side * cell),
                       np.repeat(np.arange(side * side), cell))
        n = np.ones(cell, np.int64)
        cut = [slice(i, i + cell) for i in range(0, len(x), cell)]
        radius = np.concatenate([N._local_radius(x[c], y[c], n, 6) for c in cut])
        box = (np.arange(len(cut)), *[f(v.reshape(-1, cell), axis=1) for v in (x, y) for f in (np.min, np.max)],
               np.full(len(cut), cell))
        batch = pa.RecordBatch.from_arrays([pa.array(v) for v in (x, y, radius, block)], list("xyrb"))
        return sum(b.num_rows for b in N._ask(SimpleNamespace(value=box), 6)(iter([batch]))) / len(x)

    few, many = asked(8), asked(16)
    assert 1 <= few < 3 and many < 1.15 * few
    df = spark.createDataFrame(clustered(300, 5), SCHEMA)
    plan = N.nearest_of_all(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
