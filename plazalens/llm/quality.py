"""Quality classifier: supervised subword embeddings.

Method: a document is the mean of learned vectors of its features - hashed
words, hashed 3- and 4-byte character n-grams of the running text, and a mark
for a word that repeats the one before - followed by a softmax over the two
labels. Vectors and output layer are trained by stochastic gradient descent
in numpy on a bounded sample of labelled rows (``max_rows`` rows and
``max_bytes`` bytes of text per label, those of smallest id hash, then text).
The output is linear in the mean, so scoring needs one number per bucket.

Labels are learned only from rows whose crc32(id as text) mod 5 is not 0;
a label other than 0 or 1 is ignored. Defined results: a null or empty text
(no feature) scores the softmax of a zero vector, 0.5; without labels of both
kinds all rows score 0.5; repeated rows get equal scores; equal id hashes are
ordered by id and text; texts of any length are scored whole, in slices; an
empty table gives an empty result; no other column is an input of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache, text_slices

BITS = 16
GRAMS = (3, 4)
MAX_ROWS = 1000  # training rows per label
MAX_BYTES = 64 << 20  # of their texts per label
FOLDS = 5
SLICE = 1 << 20  # bytes of text whose features are made at a time: about 100 bytes of arrays for each

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, text): the bucket of every feature of texts laid end to end, and the number of its text.

    All substring hashes come from one prefix sum of byte times power.
    """
    n = len(data)
    power = np.cumprod(np.full(n + 1, _P, np.uint64)) * _P_INVERSE
    inverse = np.cumprod(np.full(n + 1, _P_INVERSE, np.uint64)) * _P
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n])))

    def bucket(begin: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        h = ((prefix[end] - prefix[begin]) * inverse[begin] + np.uint64(salt)) * _MIX
        h ^= h >> np.uint64(32)
        return ((h * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)

    text_end = np.repeat(offsets[1:], np.diff(offsets))
    word = ~_SPACE[data]
    inner = np.ones(n, bool)  # not the first byte of a text
    inner[offsets[:-1][offsets[1:] > offsets[:-1]]] = False
    before = np.concatenate(([False], word[:-1])) & inner
    begin = np.flatnonzero(word & ~before)
    after = np.ones(n, bool)
    after[:-1] = ~(word[1:] & inner[1:])
    end = np.flatnonzero(word & after) + 1
    words = bucket(begin, end, 1)
    same = np.flatnonzero((words[1:] == words[:-1]) & (text_end[begin[1:]] == text_end[begin[:-1]])) + 1 if len(begin) else begin
    at, got = [begin, begin[same]], [words, np.zeros(len(same), np.int64)]
    for g in GRAMS:
        start = np.arange(max(0, n - g + 1))
        start = start[start + g <= text_end[start]]
        at.append(start)
        got.append(bucket(start, start + g, g))
    at, got = np.concatenate(at), np.concatenate(got)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return got, text_of[at]


@dataclass
class Model:
    """Per-bucket share of the log-odds of label 1."""

    odds: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        buckets, text = features(data, offsets)
        size = len(offsets) - 1
        total = np.bincount(text, weights=self.odds[buckets], minlength=size)
        return 1 / (1 + np.exp(-total / np.maximum(1, np.bincount(text, minlength=size))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 16, epochs: int = 6, rate: float = 10.0,
          seed: int = 0) -> Model:
    """Stochastic gradient descent over (buckets, counts, label) rows, one document a step."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((1 << BITS, dim), np.float32) * 2 - 1) / dim
    output = np.zeros((dim, 2), np.float32)
    if len({y for _, _, y in rows}) == 2:
        steps, done = epochs * len(rows), 0
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                buckets, counts, label = rows[k]
                lr = rate * (1 - done / steps)
                done += 1
                share = (counts / max(1, counts.sum())).astype(np.float32)
                hidden = share @ vectors[buckets]
                z = hidden @ output
                p = np.exp(z - z.max())
                p /= p.sum()
                p[label] -= 1
                grad = output @ p
                output -= lr * np.outer(hidden, p)
                vectors[buckets] -= lr * share[:, None] * grad
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float64))


def in_fold(id_col: str) -> Column:
    """True for rows that are held out of learning."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS == 0


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, seed: int = 0) -> Model:
    """Model from at most ``max_rows`` labelled rows of ``max_bytes`` of text of each label.

    A row is a labelled id with a text: an id that repeats brings one for each of its different texts.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~in_fold("id")).distinct()
    order = [F.xxhash64("id"), F.col("id")]

    def per_label(rows: DataFrame, order: list[Column]) -> DataFrame:
        some = [rows.filter(F.col("y") == y).orderBy(*order).limit(max_rows) for y in (0, 1)]
        return some[0].unionByName(some[1])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    rows = texts.join(F.broadcast(per_label(known, order)), "id").select(  # at most 2 * max_rows ids
        "id", "y", F.xxhash64("t").alias("h"), F.coalesce(F.octet_length("t"), F.lit(0)).alias("size"))
    before = Window.partitionBy("y").orderBy(*order, "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = per_label(rows.distinct(), [*order, F.col("h")]).withColumn("all", F.sum("size").over(before)).filter(
        F.col("all") <= max_bytes).select("id", "y", "h")
    texts = texts.join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi").withColumn("h", F.xxhash64("t"))
    texts = texts.join(F.broadcast(chosen), ["id", "h"]).dropDuplicates(["id", "h", "y"]).select("id", "y", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for _, _, data, offsets in text_slices(b.column(2), SLICE):
                buckets, text = features(data, offsets)
                buckets = buckets[np.argsort(text, kind="stable")]
                cuts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(offsets) - 1))))
                got += [np.unique(buckets[s:e], return_counts=True) for s, e in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([u.astype("<i4").tobytes() for u, _ in got], pa.binary()),
                pa.array([c.astype("<i4").tobytes() for _, c in got], pa.binary())], ["id", "y", "u", "c"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = texts.mapInArrow(run, f"id {id_type}, y int, u binary, c binary").collect()
    rows.sort(key=lambda r: (r.id, r.y, r.u))
    return train([(np.frombuffer(r.u, "<i4"), np.frombuffer(r.c, "<i4"), r.y) for r in rows], seed=seed)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the column ``score_col``: the probability of label 1."""
    at = docs.columns.index(text_col)
    schema = docs.select("*", F.lit(0.0).alias(score_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        for b in batches:
            scores = [model.scores(data, offsets) for _, _, data, offsets in text_slices(b.column(at), SLICE)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             [*b.schema.names, score_col])

    return docs.mapInArrow(run, schema)
