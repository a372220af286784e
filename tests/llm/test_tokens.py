import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plazalens.llm.huffman import Decoder, canonical_codes, code_lengths, encode_to_files, pack_bits, read_files, with_crc32
from plazalens.llm.packing import pack
from plazalens.llm.tokens import Encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "é", "ß", "Σ", "'s", "'", "12", "!", "?.", "<|endoftext|>", " ",
          "​", "\x1c", "\x00", " \n", "日本", "é", "\r\n", "½", "ﬁ", "word", "don't", "᠎", "﻿", "Word,",
          "<|startoftext|>", "ÀÖ", "×", " ", "’"]


def fuzz(n):
    rng = random.Random(7)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]


def direct(path, texts, end):
    tok = Tokenizer.from_file(path)
    return [e.ids + [end] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path,mode", [(BYTE, "spaces"), (WORD, "words"), (BYTE, "whole")])
def test_encoder_equals_the_library(path, mode):
    with open(path, encoding="utf-8") as f:
        e = Encoder(f.read(), mode, 0, max_pieces=50, max_tokens=60)
    texts = fuzz(3000) + ["", None, " ", "\n", "The cat. sat on, the mat\nand (slept)", "x" * 9_000_000]
    got = []
    for lo, ids, offsets in e.encode(pa.array(texts)):
        assert lo == len(got)
        got += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == direct(path, texts, 0)


def frame(spark, texts):
    rows = [(k * 3 % 101 if k < 90 else k + 100, t, "x", k) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n int").repartition(5), rows


def test_packing_covers_every_id_once(spark):
    texts = ["some words and more " * 400, "", None, "tiny"] * 3 + fuzz(60) + ["long " * 60000]
    docs, rows = frame(spark, texts)
    out = pack(docs, BYTE, window=1024).collect()
    want = {r[0]: ids for r, ids in zip(rows, direct(BYTE, [r[1] for r in rows], 0))}
    pieces = {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        cut = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(cut) == r.length and zlib.crc32(cut.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
    assert pieces.keys() == want.keys()
    for d, ps in pieces.items():
        ps.sort(key=lambda r: r.start)
        assert [p.start for p in ps] == np.cumsum([0] + [p.length for p in ps]).tolist()[:-1]
        assert sum(p.length for p in ps) == len(want[d])
    total = sum(map(len, want.values()))
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(-(-total // 1024)))
    for s, ps in sequences.items():
        ps.sort()
        assert [o for o, _ in ps] == np.cumsum([0] + [n for _, n in ps]).tolist()[:-1]
        assert sum(n for _, n in ps) == (1024 if s < total // 1024 else total % 1024)


def test_packing_of_an_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), BYTE).collect() == []


@pytest.mark.parametrize("limit", [16, 6])
def test_codes_round_trip(limit):
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.geometric(0.08, 5000) - 1, 60).astype(np.uint32)
    counts = np.bincount(ids, minlength=70)
    lengths = code_lengths(counts, limit)
    assert lengths.max() <= max(limit, 6) and ((lengths > 0) == (counts > 0)).all()
    assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
    bits, at = pack_bits(ids, canonical_codes(lengths), lengths)
    assert (Decoder(lengths).decode(bits, at[::256].copy(), len(ids)) == ids).all()
    assert len(bits) == (int((lengths[ids].astype(int)).sum()) + 7) // 8


def test_lengths_are_optimal_without_a_tight_limit():
    import heapq
    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1])
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert int((code_lengths(counts, 16).astype(int) * counts).sum()) == cost
    assert code_lengths(np.array([0, 7]), 16).tolist() == [0, 1]


def test_files_round_trip(spark, tmp_path):
    texts = ["some words and more " * 4000, "", None, "tiny"] * 3 + fuzz(60)
    docs, rows = frame(spark, texts)
    encode_to_files(docs, str(tmp_path / "f"), WORD)
    got = {r.id: r for r in with_crc32(read_files(spark, str(tmp_path / "f"))).collect()}
    want = {r[0]: ids for r, ids in zip(rows, direct(WORD, [r[1] for r in rows], 1))}
    at = 0
    for d in sorted(want):
        ids = np.array(want[d], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(want)


def test_files_of_an_empty_table_and_of_null_ids(spark, tmp_path):
    encode_to_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"), WORD)
    assert read_files(spark, str(tmp_path / "e")).collect() == []
    docs = spark.createDataFrame([(None, "a b"), (2, "c"), (2, "c"), (1, None)], "doc_id long, text string")
    encode_to_files(docs, str(tmp_path / "n"), WORD)
    rows = sorted(read_files(spark, str(tmp_path / "n")).collect(), key=lambda r: r.start)
    assert [(r.id, r.start, r.n_tokens) for r in rows] == [(None, 0, 3), (1, 3, 1), (2, 4, 2), (2, 6, 2)]
