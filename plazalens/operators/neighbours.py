"""The k nearest places of every place (R9, R6): an index of grid-ordered blocks.

The answer has n x k rows; pairs of places are never listed. Steps:

1. Places at equal coordinates are one point that carries its ``k + 1`` smallest
   ids: no place can need more of them, so a spot that holds a third of all
   places is one point like any other.
2. Points are ranged by the Z-order code of a fine grid over the bounding box
   and cut, in that order, into blocks of ``block_points`` to twice as many
   points. Blocks hold equal numbers, so a dense cell is split over many.
3. Within its block a point meets ``k + 1`` ids (itself included) within some
   radius: no neighbour lies farther out.
4. The search widens from there: a point asks every block whose bounding box
   lies within its radius, after the farthest corners of near boxes have
   tightened it. Most points ask their own block and a neighbour.
5. Asking is an equality join on the block number, split by AQE where a block
   is asked often; only points within the radius leave the join.

Distances are compared as the square roots they are reported as, in the same
arithmetic everywhere; rounding is monotone, so no box bound can exceed the
distance of a point in the box and no tie is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.session import scratch_path
from plazalens.sources.io import materialize

BLOCK_POINTS = 1024
BLOCKS_PER_SLICE = 1 << 18  # block bounds are broadcast in slices of at most so many rows (12 MB)
POINTS_PER_TASK = 1 << 17
GRID_BITS = 31
_TILE = 1 << 20  # distances held at once in a task

_BLOCKED = "x double, y double, n long, radius double, block long"
_BOUNDS = ("x0", "x1", "y0", "y1", "ids")


def _spread(c: Column) -> Column:
    """The 31 low bits of ``c`` at the even places of a long."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _z_code(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Z-order code of the grid cell; only the order depends on it, never the result."""
    def cell(c, low, high):
        extent = high / 2 - low / 2
        share = (c / 2 - F.lit(low / 2)) / F.lit(extent) if extent > 0 else F.lit(0.0)
        return F.least(F.floor(share * float(1 << GRID_BITS)), F.lit((1 << GRID_BITS) - 1)).cast("long")

    return F.shiftleft(_spread(cell(y, *box[2:])), 1).bitwiseOR(_spread(cell(x, *box[:2])))


def _one_per_id(places: DataFrame, id_col: str, x_col: str, y_col: str) -> DataFrame:
    # + 0.0 turns -0.0 into 0.0, so that equal coordinates are one value in every step
    at = F.struct(*[(F.col(c).cast("double") + F.lit(0.0)).alias(a) for c, a in ((x_col, "x"), (y_col, "y"))])
    inf = float("inf")
    found = places.select(F.col(id_col).alias("id"), at.alias("at")).filter(
        F.col("id").isNotNull() & (F.abs("at.x") < inf) & (F.abs("at.y") < inf))
    return found.groupBy("id").agg(F.min("at").alias("at")).select("id", "at.x", "at.y")


def _points(one: DataFrame, k: int) -> DataFrame:
    """A row for each distinct point with its k + 1 smallest ids; a hot spot costs k + 1 rows a partition."""
    rank = F.row_number().over(Window.partitionBy("x", "y").orderBy("id"))
    return (one.withColumn("r", rank).filter(F.col("r") <= k + 1)
            .groupBy("x", "y").agg(F.sort_array(F.collect_list("id")).alias("ids")))


def _distances(x, y, px, py):
    dx, dy = x[:, None] - px[None, :], y[:, None] - py[None, :]
    return np.sqrt(dx * dx + dy * dy)


def _kth(dist, n, need):
    """Per row of distances: the smallest one within which ``need`` ids lie (infinite if there are fewer)."""
    order = np.argsort(dist, axis=1, kind="stable")
    held = np.cumsum(n[order], axis=1)
    place = (held < need).sum(axis=1)
    inside = place < dist.shape[1]
    out = np.full(len(dist), np.inf)
    rows = np.nonzero(inside)[0]
    out[rows] = dist[rows, order[rows, place[rows]]]
    return out


def _rows_at_once(width: int) -> int:
    return max(1, _TILE // max(1, width))


def _local_radius(x, y, n, need):
    step = _rows_at_once(len(x))
    return np.concatenate([_kth(_distances(x[i:i + step], y[i:i + step], x, y), n, need)
                           for i in range(0, len(x), step)])


def _cut_blocks(need: int, size: int):
    """Cuts a task's points, in their order, into blocks; the last one takes the rest, at most twice the size."""
    def block(x, y, n, number):
        out = [x, y, n, _local_radius(x, y, n, need), np.full(len(x), number)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in out], ["x", "y", "n", "radius", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held = [np.empty(0), np.empty(0), np.empty(0, np.int64)]
        for b in batches:
            held = [np.concatenate([h, b.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            while len(held[0]) >= 2 * size:
                yield block(*[h[:size] for h in held], number)
                held, number = [h[size:] for h in held], number + 1
        if len(held[0]):
            yield block(*held, number)

    return run


def _ask(bounds, need: int):
    """(x, y, radius, block) for every block of ``bounds`` that a point has to look into."""
    def wanted(x, y, radius, box):
        numbers, x0, x1, y0, y1, ids = box
        # the boxes that any of these points can reach
        far = radius.max()
        gx = np.maximum(np.maximum(x0 - x.max(), x.min() - x1), 0.0)
        gy = np.maximum(np.maximum(y0 - y.max(), y.min() - y1), 0.0)
        near = np.nonzero(np.sqrt(gx * gx + gy * gy) <= far)[0]
        numbers, x0, x1, y0, y1, ids = (a[near] for a in box)
        step = _rows_at_once(len(near))
        for i in range(0, len(x) if len(near) else 0, step):
            px, py, r = x[i:i + step, None], y[i:i + step, None], radius[i:i + step]
            wx, wy = np.maximum(np.abs(px - x0), np.abs(px - x1)), np.maximum(np.abs(py - y0), np.abs(py - y1))
            r = np.minimum(r, _kth(np.sqrt(wx * wx + wy * wy), ids, need))
            dx = np.maximum(np.maximum(x0 - px, px - x1), 0.0)
            dy = np.maximum(np.maximum(y0 - py, py - y1), 0.0)
            at, block = np.nonzero(np.sqrt(dx * dx + dy * dy) <= r[:, None])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in (px[at, 0], py[at, 0], r[at], numbers[block])], ["px", "py", "radius", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = bounds.value
        for b in batches:
            x, y, radius, block = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cuts = np.nonzero(np.diff(block))[0] + 1  # points of a block are near each other
            for lo, hi in zip([0, *cuts], [*cuts, len(x)]):
                if hi > lo:
                    yield from wanted(x[lo:hi], y[lo:hi], radius[lo:hi], box)

    return run


def nearest_of_all(places: DataFrame, k: int = 5, id_col: str = "place_id", x_col: str = "latitude",
                   y_col: str = "longitude", block_points: int = BLOCK_POINTS) -> DataFrame:
    """(id, rank, neighbour, distance): the ``k`` nearest other places of every place, exactly.

    Nearness is the Euclidean distance of the two coordinates, as in
    :func:`recommend_nearby`; ties go to the smaller id. A place is never its
    own neighbour, one at the same coordinates is (distance 0). With fewer than
    ``k`` other places each gets all of them; a single place or an empty table
    gives no row. A place with a null id or a coordinate that is null or not
    finite takes no part; of rows that share an id the one with the smallest
    coordinates counts. Other columns of ``places`` do not matter.

    Runs jobs: the points are counted and written in blocks to the scratch folder.
    """
    if k < 1 or block_points < 1:
        raise ValueError("k and block_points must be at least 1")
    spark, need = places.sparkSession, k + 1
    block_points = max(block_points, need)
    path = scratch_path(spark, "neighbours")
    one = materialize(_one_per_id(places, id_col, x_col, y_col), f"{path}/places")
    points = materialize(_points(one, k), f"{path}/points")
    total, *box = points.agg(F.count(F.lit(1)), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    tasks = max(1, -(-total // POINTS_PER_TASK))
    z = _z_code(F.col("x"), F.col("y"), tuple(box) if total else (0.0, 0.0, 0.0, 0.0))
    ordered = points.select("x", "y", F.size("ids").cast("long").alias("n"), z.alias("z")).repartitionByRange(
        tasks, "z", "x", "y").sortWithinPartitions("z", "x", "y").select("x", "y", "n")
    ordered.mapInArrow(_cut_blocks(need, block_points), _BLOCKED).write.parquet(f"{path}/blocks")
    blocked = spark.read.schema(_BLOCKED).parquet(f"{path}/blocks")

    bounds = blocked.groupBy("block").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
                                          F.max("y").alias("y1"), F.sum("n").alias("ids"))
    bounds = materialize(bounds, f"{path}/bounds")
    slices = max(1, -(-bounds.count() // BLOCKS_PER_SLICE))
    asked = None
    for i in range(slices):  # a slice of bounds at a time: at most some 12 MB each through the driver
        part = bounds.filter(F.pmod(F.xxhash64("block"), F.lit(slices)) == i).toPandas()
        box = (part["block"].to_numpy(np.int64), *[part[c].to_numpy(np.float64 if c != "ids" else np.int64) for c in _BOUNDS])
        found = blocked.select("x", "y", "radius", "block").mapInArrow(
            _ask(spark.sparkContext.broadcast(box), need), "px double, py double, radius double, block long")
        asked = found if asked is None else asked.unionByName(found)

    gap = lambda a, b: (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
    met = (asked.join(blocked.select("x", "y", "block"), "block")
           .withColumn("distance", F.sqrt(gap("px", "x") + gap("py", "y")))
           .filter(F.col("distance") <= F.col("radius")).select("px", "py", "x", "y", "distance"))
    near = met.join(points, ["x", "y"]).select("px", "py", "distance", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("px", "py").orderBy("distance", "id"))
    lists = (near.withColumn("r", rank).filter(F.col("r") <= need).groupBy("px", "py")
             .agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("near")))
    mine = one.join(lists, (one["x"] == lists["px"]) & (one["y"] == lists["py"]))
    others = F.slice(F.filter("near", lambda e: e["id"] != F.col("id")), 1, k)
    return mine.select("id", F.posexplode(others).alias("pos", "e")).select(
        F.col("id").alias(id_col), (F.col("pos") + 1).alias("rank"), F.col("e.id").alias("neighbour"),
        F.col("e.distance").alias("distance"))
