"""Vector rows for the search operators: validity, matrices, and the meeting of rows and queries.

A stated query set meets all rows in blocks. The rows stay where they are
written; the queries come in slices of a bounded number, each broadcast, and a
task that reads rows holds one block of them, one slice and the best rows of
each of its queries so far. Nothing but those best rows is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache


def valid_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
               scale: float = 1.0) -> DataFrame:
    """(id, v) of rows with an id and a vector of components finite after scaling; ``v`` holds doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) != float("inf")))
    return (vectors.select(F.col(id_col).alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite))


def query_rows(rows: DataFrame, wanted: Column) -> DataFrame:
    """One row per query id; of several rows with that id the smallest vector asks."""
    return rows.filter(wanted).groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The first ``width`` components of each row (all without it); missing ones are zero."""
    sizes = np.asarray(pc.list_value_length(column))
    width = int(sizes.max(initial=0)) if width is None else width
    flat = column.flatten().to_numpy()
    out = np.zeros((len(sizes), width))
    if (sizes > width).any():
        flat = flat[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < width]
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def tails(column: pa.Array, width: int) -> np.ndarray:
    """Length of what each row has beyond its first ``width`` components."""
    sizes = np.asarray(pc.list_value_length(column))
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    beyond = np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[row] >= width
    return np.sqrt(np.bincount(row[beyond], weights=flat[beyond] ** 2, minlength=len(sizes)))


class Best:
    """The ``k`` best rows of each query so far; ties by id."""

    def __init__(self, queries: int, k: int, largest: bool, kind: type):
        self.k, self.sign = k, -1 if largest else 1
        self.ids = [np.zeros(0, np.int64)] * queries
        self.scores = [np.zeros(0, kind)] * queries

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.append(self.ids[i], ids), np.append(self.scores[i], scores)
        first = np.lexsort((ids, scores if self.sign > 0 else ~scores))[:self.k]  # ~x falls as x rises, at both ends
        self.ids[i], self.scores[i] = ids[first], scores[first]

    def last(self, i: int) -> float | None:
        """The score that a further row has to reach, once there are ``k``."""
        return self.scores[i][-1] if len(self.ids[i]) == self.k else None

    def batches(self, query_ids: list) -> Iterator[pa.RecordBatch]:
        for q, ids, scores in zip(query_ids, self.ids, self.scores):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(ids), pa.int64()), pa.array(ids), pa.array(scores)],
                                                 ["query_id", "vec_id", "score"])


def meet(rows: DataFrame, queries: DataFrame, start: Callable, search: Callable, best: Callable, score_type: str,
         slice_queries: int, block_rows: int) -> DataFrame:
    """(query_id, vec_id, score): the best rows that each task finds for every query.

    ``search(block of rows, start(queries of a slice), best)`` is called for
    the Arrow blocks of ``rows`` and adds to ``best(number of queries)``;
    ``queries`` has an id and a vector first.
    """
    slices = max(1, -(-queries.count() // slice_queries))
    found = None
    for k in range(slices):
        shared = rows.sparkSession.sparkContext.broadcast(
            queries.filter(F.pmod(F.xxhash64("id"), F.lit(slices)) == k).toArrow())

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            release_worker_cache()
            asked = shared.value.combine_chunks()
            state, held = start(asked), best(asked.num_rows)
            for b in batches:
                for lo in range(0, b.num_rows, block_rows):
                    search(b.slice(lo, block_rows), state, held)
            yield from held.batches(asked.column("id").to_pylist())

        part = rows.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")
        found = part if found is None else found.unionByName(part)
    return found


def top_rows(scored: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first ``k`` rows of each query_id by ``order``, with their rank."""
    w = Window.partitionBy("query_id").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
