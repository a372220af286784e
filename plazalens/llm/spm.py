"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

Method: the distinct chunks of a batch (white space and the word after it; no
piece of the vocabulary reaches over a word's end) that the worker has not
seen are laid end to end and indexed by a suffix array, sorted far enough for
the longest piece. Every piece is binary-searched for its range of
occurrences; the occurrences are edges over the text, sorted by position.
Relaxing applies, in each chunk, the best edge that joins two neighbouring
symbols (highest score, then leftmost) until none is left, all chunks side by
side; a chunk of more than ``ROUNDS`` characters keeps its candidates in a
heap instead. Characters left without a piece become their byte pieces.

A best-path relaxation gives other ids than the library for a merge-trained
vocabulary, so edges are relaxed in merge order; the answers equal the
library's (tested).

Defined results: a null or empty text has no ids; repeated rows get equal
answers; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import text_slices

MARK = "▁"  # stands for a space
ROUNDS = 48
SORTED = 2  # the suffix array is sorted by so many times 8 bytes
GROUP = 1 << 18  # bytes of chunks that are indexed at a time: about 400 bytes of arrays for each
SLICE = 1 << 20  # bytes of text whose chunks are looked up at a time
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_SEPARATOR = 0xFF


class Vocabulary:
    """Pieces of a SentencePiece BPE model, as bytes and scores."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=model_path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        is_byte = [model.is_byte(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.out = []  # bytes that each id decodes to
        self.pieces: list[tuple[bytes, int, float]] = []
        for i, name in enumerate(names):
            if is_byte[i]:
                self.byte_ids[int(name[1:-1], 16)] = i
                self.out.append(bytes([int(name[1:-1], 16)]))
            elif special[i]:
                self.out.append(b"")
            else:
                if MARK in name.lstrip(MARK):
                    raise ValueError(f"piece {name!r} reaches over a word's end")
                self.pieces.append((name.encode(), i, model.get_score(i)))
                self.out.append(name.replace(MARK, " ").encode())


def _keys(data: np.ndarray, reach: int) -> np.ndarray:
    """The 8 bytes from each position on as one big-endian number, with ``reach`` zero positions at the end."""
    padded = np.concatenate((data, np.zeros(reach + 8, np.uint8))).astype(np.uint64)
    n = len(data) + reach
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + n]
    return out


def suffix_array(data: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` bytes that follow (prefix doubling from 8 bytes on)."""
    n = len(data)
    order = np.argsort(keys[:n])
    covered = 8
    rank = np.zeros(n, np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(keys[order[1:]] != keys[order[:-1]])))
    while covered < depth:
        after = np.zeros(n, np.int64)
        after[:max(0, n - covered)] = rank[covered:] + 1
        both = (rank << 32) | after
        order = np.argsort(both)
        new = np.zeros(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(both[order[1:]] != both[order[:-1]])))
        rank, covered = new, covered * 2
    return order


class Matcher:
    """Finds all occurrences of all pieces in a text by binary search over its suffix array."""

    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = np.array(vocabulary.byte_ids)
        pieces = [p for p, _, _ in vocabulary.pieces]
        self.size = np.array([len(p) for p in pieces])
        self.ids = np.array([i for _, i, _ in vocabulary.pieces])
        self.score = np.array([s for _, _, s in vocabulary.pieces])
        self.rank = np.unique(-self.score, return_inverse=True)[1]  # 0 for the highest score
        self.single = np.array([len(p.decode()) == 1 for p in pieces])
        self.levels = -(-int(self.size.max()) // 8)
        width = self.levels * 8
        low = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), ">u8").reshape(-1, self.levels)
        high = np.frombuffer(b"".join(p.ljust(width, b"\xff") for p in pieces), ">u8").reshape(-1, self.levels)
        self.low, self.high = low.astype(np.uint64), high.astype(np.uint64)

    @staticmethod
    def _bound(keys, order, shift, lo, hi, key, upper) -> np.ndarray:
        """First place in [lo, hi) whose 8 bytes at ``shift`` are not below (``upper``: are above) the key."""
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            at = keys[order[np.minimum(mid, len(order) - 1)] + shift]
            right = open_ & ((at <= key) if upper else (at < key))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo

    def edges(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece number) of every occurrence, by position."""
        keys = _keys(data, self.levels * 8)
        order = suffix_array(data, keys, 8 * SORTED)
        first = keys[order]
        lo = np.searchsorted(first, self.low[:, 0], side="left")
        hi = np.searchsorted(first, self.high[:, 0], side="right")
        for level in range(1, min(SORTED, self.levels)):
            deep = np.flatnonzero((self.size > 8 * level) & (lo < hi))
            if not len(deep):
                break
            a, b = lo[deep], hi[deep]
            lo[deep] = self._bound(keys, order, 8 * level, a, b, self.low[deep, level], False)
            hi[deep] = self._bound(keys, order, 8 * level, a, b, self.high[deep, level], True)
        n = np.maximum(0, hi - lo)
        piece = np.repeat(np.arange(len(n)), n)
        start = order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        for level in range(SORTED, self.levels):  # what the sorting left open of the few longer pieces
            deep = np.flatnonzero(self.size[piece] > 8 * level)
            at, which = keys[start[deep] + 8 * level], piece[deep]
            keep = np.ones(len(start), bool)
            keep[deep] = (at >= self.low[which, level]) & (at <= self.high[which, level])
            start, piece = start[keep], piece[keep]
        by_place = np.argsort(start)
        return start[by_place], piece[by_place]

    def encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as 32-bit bytes."""
        if not chunks:
            return []
        raw = [c.encode() for c in chunks]
        data = np.frombuffer(bytes([_SEPARATOR]).join(raw) + bytes([_SEPARATOR]), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1) - 1  # the separators
        begins = np.concatenate(([0], ends[:-1] + 1))
        start, piece = self.edges(data)
        n = len(data)
        is_head = (data & 0xC0) != 0x80  # first byte of a character, or a separator
        heads = np.flatnonzero(is_head)
        after = np.zeros(n + 1, np.int64)  # end of the symbol that starts here
        after[heads[:-1]] = heads[1:]
        after[heads[-1]] = n
        token = np.full(n, -1, np.int64)
        one = self.single[piece]
        token[start[one]] = self.ids[piece[one]]
        start, piece = start[~one], piece[~one]
        stop = start + self.size[piece]
        chunk = np.searchsorted(ends, start)
        chars = np.diff(np.concatenate(([0], np.cumsum(is_head)[ends])))
        long = chars[chunk] > ROUNDS
        for c in np.unique(chunk[long]).tolist():
            own = slice(*np.searchsorted(chunk, [c, c + 1]))
            self._relax_long(start[own], stop[own], piece[own], after, token, is_head, int(begins[c]), int(ends[c]))
        start, stop, piece, chunk = (x[~long] for x in (start, stop, piece, chunk))
        # by chunk, score and place, in one number: a short chunk's places fit in 8 bits
        order = np.argsort(((chunk * len(self.score) + self.rank[piece]) << 8) | (start - begins[chunk]))
        start, stop, piece, chunk = start[order], stop[order], piece[order], chunk[order]
        while len(start):
            middle = after[start]
            ready = np.flatnonzero(is_head[start] & (middle < stop) & (after[middle] == stop))
            if not len(ready):
                break
            best = ready[np.concatenate(([True], chunk[ready[1:]] != chunk[ready[:-1]]))]
            is_head[middle[best]] = False
            after[start[best]] = stop[best]
            token[start[best]] = self.ids[piece[best]]
            merged = np.zeros(len(raw), bool)
            merged[chunk[best]] = True
            keep = merged[chunk] & is_head[start] & is_head[stop] & (after[start] < stop)
            start, stop, piece, chunk = start[keep], stop[keep], piece[keep], chunk[keep]
        is_head[ends] = False
        heads = np.flatnonzero(is_head)
        found, long = token[heads], after[heads] - heads
        times = np.where(found >= 0, 1, long)  # a character without a piece yields its bytes
        done = np.cumsum(times)
        ids = np.repeat(found, times)
        place = np.repeat(heads - (done - times), times) + np.arange(len(ids))
        ids = np.where(ids >= 0, ids, self.byte_ids[data[np.minimum(place, n - 1)]]).astype(np.uint32).tobytes()
        cuts = np.concatenate(([0], done))[np.searchsorted(heads, np.append(begins, n))].tolist()
        return [ids[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _relax_long(self, start, stop, piece, after, token, is_head, begin, end) -> None:
        """Applies the edges of one long chunk in merge order from a heap."""
        edge = {(s, e): p for s, e, p in zip(start.tolist(), stop.tolist(), piece.tolist())}
        before = {}
        s = begin
        while s < end:
            before[int(after[s])] = s
            s = int(after[s])
        heap: list[tuple[float, int, int, int]] = []

        def offer(s: int) -> None:
            m = int(after[s])
            if m < end and (p := edge.get((s, int(after[m])))) is not None:
                heapq.heappush(heap, (-float(self.score[p]), s, int(after[m]), p))

        s = begin
        while s < end:
            offer(s)
            s = int(after[s])
        while heap:
            _, s, e, p = heapq.heappop(heap)
            m = int(after[s])
            if not is_head[s] or m >= e or int(after[m]) != e:
                continue
            is_head[m] = False
            after[s], token[s] = e, self.ids[p]
            before[e] = s
            offer(s)
            if s > begin:
                offer(before[s])


class Encoder:
    """Whole-text encoder with a bounded cache of chunks."""

    def __init__(self, vocabulary: Vocabulary, max_chunks: int = 350_000):
        self.matcher, self.cache, self.max_chunks = Matcher(vocabulary), {}, max_chunks

    def encode(self, texts: list[str]) -> list[bytes]:
        chunks = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list(dict.fromkeys(c for cs in chunks for c in cs if c not in self.cache))
        known, group, size = {}, [], 0
        for k, c in enumerate(new):
            group.append(c)
            size += len(c)
            if size >= GROUP // 2 or k + 1 == len(new):
                known.update(zip(group, self.matcher.encode(group)))
                group, size = [], 0
        for c in new:
            if len(self.cache) >= self.max_chunks:
                break
            self.cache[c] = known.pop(c)
        cache = self.cache
        return [b"".join([cache[c] if c in cache else known[c] for c in cs]) for cs in chunks]


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """Text of the ids: the first space is the one that encoding puts before a text."""
    text = b"".join(map(vocabulary.out.__getitem__, np.frombuffer(ids, np.uint32).tolist())).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


_ENCODERS: dict[str, Encoder] = {}


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) of every row; ``ids`` are little-endian 32-bit numbers."""
    id_type = docs.schema[id_col].dataType.simpleString()
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path))  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _ENCODERS.get(model_path)
        if enc is None:
            enc = _ENCODERS[model_path] = Encoder(vocabulary.value)
        for b in batches:
            for lo, hi, data, offsets in text_slices(b.column(1), SLICE):
                raw = data.tobytes()
                ids = enc.encode([raw[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1], offsets[1:])])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, f"id {id_type}, n_tokens long, ids binary")


def decode_documents(tokens: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with the column ``decoded``."""
    vocabulary = tokens.sparkSession.sparkContext.broadcast(Vocabulary(model_path))
    at = tokens.columns.index(ids_col)
    schema = tokens.select("*", F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode(vocabulary.value, x.as_buffer().to_pybytes() if x.is_valid else b"") for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return tokens.mapInArrow(run, schema)
