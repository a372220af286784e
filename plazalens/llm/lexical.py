"""Ranked lexical search by dense blocked multiplication.

Method: one pass over the whole texts keeps each document's number of terms
and the counts of the terms that any item asks for. Corpus statistics follow
from that table. Then document tiles of integer impacts meet item tiles: a tile
of items has a compact vocabulary of its own terms, its weights are a dense
matrix, and a document tile's impacts over the same vocabulary another; their
product in float64 (BLAS) gives all scores of the tile at once. A vocabulary
tile is so narrow that no partial sum reaches 2^53, so every product is exact;
partial sums of several vocabulary tiles are added as 64-bit integers. Each
tile's k best of an item go on, ties by id, and the k best of those are final.

A document's score is the sum over the item's distinct terms of
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 10 + (90 * n * N) div L``.

Items come to the driver ``max_bytes`` of text at a time (more of them mean
more passes), the documents never.

Defined results: a null text has no term; a text of any length is read whole;
equal scores are ordered by id (null last), rows that share an id each count
as a document; of several rows with an item id the smallest text asks; items
without a term, and an empty table on either side, give no row; other columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from plazalens.llm.common import release_worker_cache, written

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of the lower-cased bytes
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
STEP = 1 << 20  # bytes of one text that are split at a time
ITEM_TILE, DOCUMENT_TILE, VOCABULARY_TILE = 64, 512, 2048
IMPACTS = 10 ** 6  # no impact is larger
SALTS = 32
NO_ID = (1 << 63) - 1


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term of a whole text."""
    out: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + STEP
        gap = GAP.search(text, end) if end < len(text) else None  # a term that stands at the cut is not parted
        end = gap.start() if gap else len(text)
        out.update(TERM.findall(text[at:end].lower()))
        at = end
    return out


def term_table(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, counts) of every row: its number of terms, and the vocabulary's terms in it as 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        known = shared.value
        for b in batches:
            sizes, terms, counts = [], [], []
            for text in b.column(1).cast(pa.binary()):
                found = count_terms(text.as_py() or b"")
                mine = sorted((known[t], n) for t, n in found.items() if t in known)
                sizes.append(found.total())
                terms.append(np.array([t for t, _ in mine], "<i4").tobytes())
                counts.append(np.array([n for _, n in mine], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()),
                                              pa.array(counts, pa.binary())], ["id", "n", "terms", "counts"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, "id long, n long, terms binary, counts binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit integers of a binary column end to end, and how many each row has."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<i4").astype(np.int64), np.fromiter(map(len, values), np.int64, len(values)) // 4


def statistics(table: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms, documents of each vocabulary term): ``size`` + 2 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for b in batches:
            n = b.column(0).to_numpy()
            total[:size] += np.bincount(_flat(b.column(1))[0], minlength=size)
            total[size:] += [np.count_nonzero(n), n.sum()]
        some = np.flatnonzero(total)
        for k in range(0, len(some), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(some[k:k + 10_000]), pa.array(total[some[k:k + 10_000]])], ["key", "n"])

    counted = table.select("n", "terms").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 2, np.int64)
    out[counted.column("key").to_numpy()] = counted.column("n").to_numpy()
    return int(out[size]), int(out[size + 1]), out[:size]


class ItemTile:
    """Up to ``ITEM_TILE`` items over their own compact vocabulary."""

    def __init__(self, items: list[tuple[object, list[int]]], weights: np.ndarray):
        self.ids = [i for i, _ in items]
        self.terms = np.unique(np.concatenate([np.array(t, np.int64) for _, t in items]))
        self.matrix = np.zeros((len(self.terms), len(items)))
        for k, (_, own) in enumerate(items):
            at = np.searchsorted(self.terms, own)
            self.matrix[at, k] = weights[own]
        # so many columns that no sum of weight times impact reaches 2^53
        self.width = int(min(VOCABULARY_TILE, max(1, (2 ** 53 - 1) // (max(1, int(weights.max(initial=1))) * IMPACTS))))

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents with a term of the tile, their scores for each item)."""
        column = np.searchsorted(self.terms, term)
        column[column == len(self.terms)] = 0
        own = self.terms[column] == term
        column, impact = column[own], impact[own]
        docs, row = np.unique(doc[own], return_inverse=True)
        total = np.zeros((len(docs), len(self.ids)), np.int64)
        for lo in range(0, len(self.terms), self.width):
            here = (column >= lo) & (column < lo + self.width)
            tile = np.zeros((len(docs), min(self.width, len(self.terms) - lo)))
            tile[row[here], column[here] - lo] = impact[here]
            total += (tile @ self.matrix[lo:lo + self.width]).astype(np.int64)
        return docs, total


class Best:
    """The best rows of each item of a tile so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.ids = [np.zeros(0, np.int64)] * items
        self.scores = [np.zeros(0, np.int64)] * items

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        enough = scores >= self.least  # an equal score may have a smaller id
        for i in np.flatnonzero(enough.any(axis=0)).tolist():
            some = enough[:, i]
            s, d = np.append(self.scores[i], scores[some, i]), np.append(self.ids[i], ids[some])
            first = np.lexsort((d, -s))[:self.k]
            self.scores[i], self.ids[i] = s[first], d[first]
            if len(first) == self.k:
                self.least[i] = s[first[-1]]


def _impacts(n: np.ndarray, tf: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    if 90 * int(n.max(initial=0)) * documents < 1 << 63:
        m = 10 + 90 * n * documents // max(1, all_terms)
    else:
        m = np.array([10 + 90 * int(x) * documents // all_terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _search(table: DataFrame, items: list[tuple[object, list[int]]], weights: np.ndarray, documents: int, all_terms: int,
            k: int, item_type) -> DataFrame:
    """The best rows of every task for each item."""
    tiles = [ItemTile(items[i:i + ITEM_TILE], weights) for i in range(0, len(items), ITEM_TILE)]
    shared = table.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        best = [Best(len(t.ids), k) for t in tiles]
        for b in batches:
            for lo in range(0, b.num_rows, DOCUMENT_TILE):
                part = b.slice(lo, DOCUMENT_TILE)
                term, sizes = _flat(part.column(2))
                doc = np.repeat(np.arange(part.num_rows), sizes)
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                impact = _impacts(part.column(1).to_numpy()[doc], _flat(part.column(3))[0], documents, all_terms)
                for tile, own in zip(tiles, best):
                    docs, scores = tile.scores(doc, term, impact)
                    own.add(ids[docs], scores)
        for tile, own in zip(tiles, best):
            for i, ids, scores in zip(tile.ids, own.ids, own.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(ids), item_arrow), pa.array(ids, mask=ids == NO_ID), pa.array(scores)],
                    ["item_id", "doc_id", "score"])

    schema = f"item_id {item_type.simpleString()}, doc_id long, score long"
    item_arrow = to_arrow_type(item_type)
    return table.filter(F.octet_length("terms") > 0).mapInArrow(run, schema)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", max_bytes: int = 4 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of every item."""
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("t")).groupBy("item_id").agg(
        F.min("t").alias("t"))
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    groups = -(-size // max_bytes)
    item_type = asked.schema["item_id"].dataType
    found = None
    for g in range(groups):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()
        terms = sorted(((r.item_id, sorted(count_terms((r.t or "").encode()))) for r in rows), key=lambda r: r[1])
        terms = [(i, t) for i, t in terms if t]  # items of like terms share a tile
        vocabulary = {t: n for n, t in enumerate(sorted({t for _, own in terms for t in own}))}
        if not vocabulary:
            continue
        table = written(term_table(docs, vocabulary, id_col, text_col), "terms")
        documents, all_terms, df = statistics(table, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        best = _search(table, [(i, [vocabulary[t] for t in own]) for i, own in terms], weights, documents, all_terms,
                       k, item_type)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], StructType([
            StructField("item_id", item_type), StructField("doc_id", LongType()), StructField("score", LongType())]))
    # two steps, so that no task meets the rows of one item from all tasks at once
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    for keys in (["item_id", "salt"], ["item_id"]):
        w = Window.partitionBy(*keys).orderBy(*order)
        salted = salted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return salted.select("item_id", "rank", "doc_id", "score")
