"""Approximate nearest neighbours by randomly rotated one-bit codes.

Method: every vector, less the mean of all, is rotated by a random orthogonal
matrix and kept as one sign bit per dimension with two scalars: its length and
the inner product of its direction with its code. From the packed bits and
the scalars a query estimates its inner product with every row; the spread of
that estimate gives an error bound of ``error_bound`` deviations. Rows whose
lower distance bound exceeds neither the k-th smallest upper bound of the block
nor the k-th best distance so far are reranked with exact distances in double
precision. The code covers as many components as most vectors have; the length
of what a vector has beyond them is a third scalar and widens its bounds.

Queries meet all rows in blocks; no row is left out, so recall is lost only
where the bound fails (measured against brute force in the tests).

Defined results: rows with a null id, or a null, empty or zero vector, or one
with a null or non-finite component take no part; a missing trailing component
is zero; candidates are all rows with another id, repeated rows each; a query
id that repeats asks with its smallest vector; equal distances are ordered by
id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache, written
from plazalens.llm.vectors import Best, matrix, meet, query_rows, tails, top_rows, valid_rows


class Coder:
    """Rotation and centre shared by all rows and queries."""

    def __init__(self, centre: np.ndarray, seed: int = 0):
        self.dim = max(8, -(-len(centre) // 8) * 8)
        self.centre = np.pad(centre, (0, self.dim - len(centre)))
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((self.dim, self.dim)))
        self.rotation = q * np.sign(np.diag(r))

    def rotate(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rotated unit directions from the centre, and lengths."""
        x = np.pad(v, ((0, 0), (0, self.dim - v.shape[1]))) - self.centre
        length = np.sqrt((x * x).sum(axis=1))
        return (x / np.where(length > 0, length, 1.0)[:, None]) @ self.rotation, length

    def encode(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(packed sign bits, lengths, inner products of direction and code)."""
        unit, length = self.rotate(v)
        bits = unit > 0
        return np.packbits(bits, axis=1), length, np.abs(unit).sum(axis=1) / np.sqrt(self.dim)

    def bounds(self, codes: np.ndarray, length: np.ndarray, own: np.ndarray, unit: np.ndarray, q_length: float,
               error_bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distances of coded rows to one rotated query.

        The inner product of code and query comes from a table of partial
        sums for each byte of the packed bits.
        """
        table = (_BITS @ unit.reshape(-1, 8).T).T  # (bytes, 256)
        picked = table[0][codes[:, 0]]
        for j in range(1, codes.shape[1]):
            picked = picked + table[j][codes[:, j]]
        own = np.maximum(own, 1e-9)
        estimate = (2 * picked - unit.sum()) / np.sqrt(self.dim) / own
        error = np.sqrt(np.maximum(0.0, 1 - own * own)) / own * error_bound / np.sqrt(max(1, self.dim - 1))
        base, scale = length * length + q_length * q_length, 2 * length * q_length
        return base - scale * np.minimum(1.0, estimate + error), base - scale * np.maximum(-1.0, estimate - error)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def build_index(rows: DataFrame, coder: Coder) -> DataFrame:
    """(id, v, code) of every row; ``code`` holds the packed bits and three scalars."""
    shared = rows.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        for b in batches:
            codes, length, own = shared.value.encode(matrix(b.column(1), shared.value.dim))
            scalars = [x.reshape(-1, 1).view(np.uint8) for x in (length, own, tails(b.column(1), shared.value.dim))]
            packed = np.concatenate((codes, *scalars), axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.tobytes() for x in packed], pa.binary())],
                                             ["id", "v", "code"])

    return rows.select(F.col("id").cast("long"), "v").mapInArrow(run, "id long, v array<double>, code binary")


def centre_of(rows: DataFrame) -> np.ndarray:
    """Mean of the first components of all rows, as many as the most frequent vector length."""
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    dim = sizes["size"] if sizes else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for b in batches:
            total += matrix(b.column(0), dim).sum(axis=0)
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(total), pa.array(np.full(dim, n))], ["at", "s", "n"])

    sums = rows.select("v").mapInArrow(run, "at long, s double, n long").groupBy("at").agg(
        (F.sum("s") / F.sum("n")).alias("mean")).orderBy("at").collect() if dim else []
    return np.array([r["mean"] for r in sums], np.float64)


def _search(coder, error_bound: float):
    def start(asked: pa.Table):
        v = asked.column("v").combine_chunks()
        dim = coder.value.dim
        units, lengths = coder.value.rotate(matrix(v, dim))
        return asked.column("id").to_numpy(), [np.array(x.as_py()) for x in v], units, lengths, tails(v, dim)

    def search(block: pa.RecordBatch, queries, best) -> None:
        extra = np.frombuffer(b"".join(block.column(2).to_pylist()), np.uint8).reshape(block.num_rows, -1)
        codes, scalars = np.ascontiguousarray(extra[:, :-24]), np.ascontiguousarray(extra[:, -24:]).view(np.float64)
        length, own, tail = scalars.T
        ids = block.column(0).to_numpy()
        for i, (query_id, query, unit, q_length, q_tail) in enumerate(zip(*queries)):
            low, high = coder.value.bounds(codes, length, own, unit, q_length, error_bound)
            low, high = low + (tail - q_tail) ** 2, high + (tail + q_tail) ** 2
            other = ids != query_id
            high = high[other]
            if not len(high):
                continue
            enough = np.partition(high, best.k - 1)[best.k - 1] if len(high) > best.k else np.inf
            if (worst := best.last(i)) is not None:
                enough = min(enough, worst * worst * (1 + 1e-9))
            some = np.flatnonzero(other & (low <= enough))
            if len(some):
                v = block.column(1).take(pa.array(some))
                d = matrix(v, max(len(query), int(np.asarray(v.value_lengths()).max())))
                d[:, :len(query)] -= query
                best.add(i, ids[some], np.sqrt((d * d).sum(axis=1)))

    return start, search


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            error_bound: float = 3.0, block_rows: int = 8192, chunk_queries: int = 4096, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for every query.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = valid_rows(vectors, id_col, vector_col).filter(F.exists("v", lambda x: x != 0))
    coder = vectors.sparkSession.sparkContext.broadcast(Coder(centre_of(rows), seed))
    index = written(build_index(rows, coder.value), "codes")
    start, search = _search(coder, error_bound)
    found = meet(index, query_rows(index, is_query), start, search, lambda n: Best(n, k, False, np.float64), "double",
                 chunk_queries, block_rows)
    return top_rows(found, k, [F.col("score"), F.col("vec_id")]).select("query_id", "rank", "vec_id", "score")
