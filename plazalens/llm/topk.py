"""Exact top-k inner products by norm-bucketed retrieval.

Method: vectors are ranged by falling length into buckets. All queries meet
the first bucket; its k-th best score is a lower bound of each query's answer,
and a task's own k-th best so far a better one. A bucket whose longest vector
times the query's length cannot reach it is passed over. Inside a bucket the local cosine threshold
(bound / (query length * longest vector)) picks the pruning: a high one uses
coordinate pruning - a vector with such a cosine must lie in a narrow range of
the query's strongest coordinates - a low one length pruning, the prefix of
vectors that are long enough. Survivors are verified with integer products.

Defined results: components are floor(scale * x) in integers; rows with a null
id, a null vector or a null or non-finite component take no part; a missing
trailing component is zero; candidates are all rows with another id, repeated
rows each; a query id that repeats asks with its smallest vector; products
beyond 64 bits are computed exactly and reported at the end of the long range;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import written
from plazalens.llm.vectors import Best, matrix, meet, query_rows, top_rows, valid_rows

SLACK = 1 - 1e-9  # room for rounding in every pruning bound
COORDINATES = 4
HIGH_COSINE = 0.6


def _pruned(rows: np.ndarray, norms: np.ndarray, query: np.ndarray, length: float, bound: float) -> np.ndarray:
    """Row numbers that can reach ``bound``; ``norms`` fall."""
    if not np.isfinite(bound) or bound <= 0 or not 0 < length < np.inf:
        return np.arange(len(rows))
    longest = int(np.searchsorted(-norms, -(bound / length) * SLACK, side="right"))  # length pruning
    if not longest or bound * SLACK / (length * norms[0]) < HIGH_COSINE:
        return np.arange(longest)
    unit = query / length
    keep = np.ones(longest, bool)
    t = np.minimum(1.0, bound * SLACK / (length * norms[:longest]))  # local cosine threshold of each row
    for c in np.argsort(-np.abs(unit))[:COORDINATES]:
        # a cosine of t leaves each unit coordinate a range round q * t; it ends at 1 beyond the pole
        x, q = rows[:longest, c] / norms[:longest], unit[c]
        half = np.sqrt(np.maximum(0.0, (1 - q * q) * (1 - t * t)))
        keep &= (x >= np.where(q > -t, q * t - half, -1.0) - 1e-9) & (x <= np.where(q < t, q * t + half, 1.0) + 1e-9)
    return np.flatnonzero(keep)


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products, saturated at the long range."""
    top = np.abs(rows).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query))
    if top < 2 ** 52:
        return (rows @ query).astype(np.int64)
    if top < 2 ** 62:
        return rows.astype(np.int64) @ query.astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, query)) for r in rows]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, x)) for x in exact], np.int64)


def _start(asked: pa.Table):
    v = [np.array(x.as_py(), np.float64) for x in asked.column("v").combine_chunks()]
    return asked.column("id").to_numpy(), v, [float(np.sqrt(q @ q)) for q in v], asked.column("extra").to_numpy()


def _search(block: pa.RecordBatch, queries, best: Best) -> None:
    v = block.column(1)
    sizes = pc.list_value_length(v).to_numpy()
    flat = v.flatten().to_numpy()
    norms = np.sqrt(np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=flat * flat, minlength=len(sizes)))
    order = np.argsort(-norms, kind="stable")
    norms, ids, rows = norms[order], block.column(0).to_numpy()[order], None
    for i, (query_id, query, length, bound) in enumerate(zip(*queries)):
        if (least := best.last(i)) is not None:
            bound = max(bound, float(least))
        if bound > 0 and 0 < length < np.inf and np.isfinite(bound) and length * norms[0] < bound * SLACK:
            continue  # the longest vector cannot reach the bound
        if rows is None:
            rows = matrix(v)[order]
        if len(query) > rows.shape[1]:
            query = query[:rows.shape[1]]  # what the rows lack multiplies to nothing; the length stays
        elif len(query) < rows.shape[1]:
            query = np.pad(query, (0, rows.shape[1] - len(query)))
        some = _pruned(rows, norms, query, length, bound)
        some = some[ids[some] != query_id]
        if len(some):
            best.add(i, ids[some], _products(rows[some], query))


def top_products(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
                 vector_col: str = "embedding", bucket_rows: int = 8192, chunk_queries: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` largest integer products of every query.

    ``is_query`` is a condition on the column ``id``.
    """
    def whole(x: Column) -> Column:
        return F.when(F.abs(x * scale) < 2.0 ** 52, F.floor(x * scale).cast("double")).otherwise(x * scale)

    buckets = max(1, -(-vectors.count() // bucket_rows))
    rows = valid_rows(vectors, id_col, vector_col, scale).select(F.col("id").cast("long"), F.transform("v", whole).alias("v"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    # the id splits a run of equal lengths among buckets
    rows = written(rows.repartitionByRange(buckets, F.col("norm").desc(), "id").withColumn(
        "block", F.spark_partition_id().cast("long")), "by_length")
    first_block = rows.agg(F.min("block")).first()[0]  # that of the longest vectors
    queries = query_rows(rows, is_query).withColumn("extra", F.lit(float("-inf")))

    def search(rows: DataFrame, queries: DataFrame) -> DataFrame:
        return meet(rows.select("id", "v"), queries.select("id", "v", "extra"), _start, _search,
                    lambda n: Best(n, k, True, np.int64), "long", chunk_queries, bucket_rows)

    first = written(search(rows.filter(F.col("block") == first_block), queries), "first_bucket")
    best = top_rows(first, k, [F.col("score").desc(), F.col("vec_id")])
    bound = best.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).otherwise(float("-inf")).alias("extra"))
    bounded = queries.drop("extra").join(bound, F.col("id") == F.col("query_id"), "left").select(
        "id", "v", F.coalesce("extra", F.lit(float("-inf"))).alias("extra"))
    found = first.unionByName(search(rows.filter(F.col("block") != first_block), bounded))
    return top_rows(found, k, [F.col("score").desc(), F.col("vec_id")]).select("query_id", "rank", "vec_id", "score")
