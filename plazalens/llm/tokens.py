"""Exact tokenization of whole texts with a piece cache.

A ``tokenizers`` model handles each pre-token by itself, and no pre-token
holds a non-space character followed by a space. So a text whose white space
is plain is cut at it, each distinct piece is tokenized once per worker by
the library's own normalizer, pre-tokenizer and model, and the ids are put
together by array operations. Any other text (runs of white space that the
mode minds, control or non-ASCII white space, special-token brackets) goes
through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import text_slices, worker_cache

SLICE = 4 << 20  # bytes of text that are encoded at a time
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: byte strings of special-token brackets, control characters and white space that the modes do not cut at
_ODD = [b"<|", *(bytes([c]) for c in (0, 28, 29, 30, 31)), b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e",
        *(bytes([0xE2, 0x80, c]) for c in (*range(0x80, 0x90), 0xA8, 0xA9, 0xAF)), b"\xe2\x81\x9f", b"\xe2\x81\xa0",
        b"\xe3\x80\x80", b"\xef\xbb\xbf"]
#: in mode "spaces" also all white space but single spaces and line breaks
_ODD_SPACES = [b"\t", b"\x0b", b"\x0c", b"\r", b"  ", b" \n", b"\n ", b"\n\n"]


def _odd_texts(data: np.ndarray, offsets: np.ndarray, mode: str) -> np.ndarray:
    """Texts that must not be cut at white space (a superset), from their bytes."""
    raw = data.tobytes()
    odd = np.zeros(len(offsets), bool)
    general = b"\xe2\x80" in raw  # where most of the signs start
    for sign in _ODD + (_ODD_SPACES if mode == "spaces" else []):
        if sign[:2] == b"\xe2\x80" and not general:
            continue
        k = raw.find(sign)
        while k >= 0:
            i = int(np.searchsorted(offsets, k, side="right")) - 1
            odd[i] = True
            k = raw.find(sign, int(offsets[i + 1]))
    if mode == "spaces":
        some = np.flatnonzero(offsets[1:] > offsets[:-1])
        odd[some] |= _WHITE[data[offsets[some]]] | _WHITE[data[offsets[some + 1] - 1]]
    return odd[:-1]


#: head, Latin-1 letters, ASCII punctuation but the apostrophe; the core is empty for any other piece
_SHAPE = re.compile("([\0\n]?)(?:([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)$)?")


def _byte_level() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for the bytes of Latin-1 letters."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    stand_in = {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(stand_in[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


_BYTE_LEVEL = _byte_level()


def id_dtype(vocabulary_size: int) -> np.dtype:
    """Little-endian type of the stored ids: 16 bits where the vocabulary fits."""
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def id_dtype_of(tokenizer_path: str) -> np.dtype:
    from tokenizers import Tokenizer
    return id_dtype(Tokenizer.from_file(tokenizer_path).get_vocab_size())


CACHED_CHARS = 64  # longer pieces and words are encoded each time they are met


class Encoder:
    """Whole-text encoder over one tokenizer.

    Its caches hold ``max_pieces`` pieces and ``max_tokens`` words, each of at
    most ``CACHED_CHARS`` characters, so their bytes are bounded too.

    ``mode`` says how the tokenizer sees white space: ``"spaces"`` keeps it
    (a space belongs to the next word, a line break stands alone),
    ``"words"`` drops it, ``"whole"`` makes no assumption.
    """

    def __init__(self, tokenizer_json: str, mode: str, end_id: int, max_pieces: int = 200_000,
                 max_tokens: int = 700_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.mode, self.max_pieces, self.max_tokens = mode, max_pieces, max_tokens
        self.dtype = id_dtype(self.tok.get_vocab_size())
        self.end = np.array([end_id], self.dtype).tobytes()
        self.pieces: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}
        self.line_break = self._library("\n") if mode == "spaces" else b""

    def _library(self, piece: str) -> bytes:
        return np.array(self.tok.encode(piece, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece; NUL or a line break at its head means that no space stands before it.

        A piece of Latin letters and closing punctuation is two pre-tokens in
        either mode, and the model alone gives their ids.
        """
        head, core, tail = _SHAPE.match(piece).groups()
        if not core or self.mode == "whole":
            if self.mode == "spaces":
                piece = piece[1:] if head == "\0" else piece if head else " " + piece
            return self._library(piece)
        word = core if self.mode == "spaces" else core.lower()
        if not word.isascii():
            word = word.translate(_BYTE_LEVEL)
        if self.mode == "spaces" and not head:
            word = "\u0120" + word
        ids = self.tokens.get(word)
        if ids is None:
            ids = np.array([t.id for t in self.tok.model.tokenize(word)], self.dtype).tobytes()
            if len(self.tokens) < self.max_tokens and len(word) <= CACHED_CHARS:
                self.tokens[word] = ids
        if tail:
            end = self.tokens.get(tail)
            if end is None:
                end = self._library(tail)
                if len(self.tokens) < self.max_tokens and len(tail) <= CACHED_CHARS:
                    self.tokens[tail] = end
            ids += end
        return self.line_break + ids if head == "\n" else ids

    def _ids_of(self, distinct: list[str]) -> list[bytes]:
        out = []
        for p in distinct:
            got = self.pieces.get(p)
            if got is None:
                got = self._piece(p)
                if len(self.pieces) < self.max_pieces and len(p) <= CACHED_CHARS:
                    self.pieces[p] = got
            out.append(got)
        return out

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first, ids, offsets) for runs of texts; each text's ids end with the end id."""
        for lo, hi, data, offsets in text_slices(column, SLICE):
            n = hi - lo
            odd = np.ones(n, bool) if self.mode == "whole" else _odd_texts(data, offsets, self.mode)
            texts = pa.Array.from_buffers(
                pa.large_string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
            plain = texts.filter(pa.array(~odd))
            if self.mode == "spaces":
                plain = pc.binary_join_element_wise(
                    pa.scalar("", plain.type), pc.replace_substring(plain, "\n", " \n"), pa.scalar("\0", plain.type))
            if self.mode == "words":
                split = pc.ascii_split_whitespace(plain)
            else:
                split = pc.split_pattern(plain, " ")
            coded = split.values.dictionary_encode() if len(plain) else None
            cuts = np.asarray(split.offsets) if len(plain) else np.zeros(1, np.int64)
            distinct = self._ids_of(coded.dictionary.to_pylist()) if len(plain) else []
            wholes = [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch(
                texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)] if odd.any() else []
            yield lo, *self._join(odd, coded, cuts, distinct, wholes)

    def _join(self, odd, coded, cuts, distinct, wholes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, from pieces by number: distinct ones, whole texts, the end id."""
        n_distinct, n = len(distinct), len(odd)
        parts = [*distinct, *wholes, self.end]
        sizes = np.fromiter(map(len, parts), np.int32, len(parts)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(parts), self.dtype)
        begins = (np.cumsum(sizes) - sizes).astype(np.int32)
        per_text = np.ones(n, np.int64)
        per_text[~odd] = np.diff(cuts)
        ends = np.cumsum(per_text + 1)  # pieces and the end id
        order = np.empty(int(ends[-1]), np.int32)
        order[ends - 1] = len(parts) - 1
        slot = np.ones(len(order), bool)
        slot[ends - 1] = False
        order[ends[odd] - 2] = n_distinct + np.arange(len(wholes))
        slot[ends[odd] - 2] = False
        if coded is not None:
            order[slot] = np.asarray(coded.indices)[cuts[0]:cuts[-1]]
        size = sizes[order]
        done = np.cumsum(size, dtype=np.int64)
        at = np.repeat(begins[order] - (done - size).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        ids = flat[at]
        return ids, np.concatenate(([0], done[ends - 1]))


def encoder(tokenizer_json: str, mode: str, end_id: int) -> Encoder:
    """The worker's encoder: its cache lasts until another operator's task runs in the worker."""
    return worker_cache(("encoder", hash(tokenizer_json), mode, end_id), lambda: Encoder(tokenizer_json, mode, end_id))


def encode_documents(docs: DataFrame, tokenizer_path: str, mode: str, end_id: int,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, local, n, ids, tally) of every row.

    ``ids`` are ids of type ``id_dtype_of(tokenizer_path)`` ending with ``end_id``, ``part`` the
    task that made the row and ``local`` the ids before it in that task.
    ``tally`` holds, on the first row of each run of rows, the run's distinct
    ids and then their counts (32-bit), so counting need not read the ids.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    with open(tokenizer_path, encoding="utf-8") as f:  # read once on the driver: its size is the vocabulary's
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(source.value, mode, end_id)
        part, local = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, ids, offsets in enc.encode(b.column(1)):
                n = len(offsets) - 1
                count = np.bincount(ids)
                used = np.flatnonzero(count)
                tally = np.concatenate((used, count[used])).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, n), pa.array(np.full(n, part, np.int32)),
                    pa.array(offsets[:-1] + local), pa.array(np.diff(offsets)),
                    pa.Array.from_buffers(pa.binary(), n, [
                        None, pa.py_buffer((offsets * ids.itemsize).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())]),
                    pa.array([tally] + [None] * (n - 1), pa.binary())], ["id", "part", "local", "n", "ids", "tally"])
                local += int(offsets[-1])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, f"id {id_type}, part int, local long, n long, ids binary, tally binary")


def part_bases(tokens: DataFrame) -> DataFrame:
    """(part, base): the ids in all earlier parts, one row per part."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
