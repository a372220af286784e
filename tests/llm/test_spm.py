import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from plazalens.llm.queries import op7_sentencepiece
from plazalens.llm.spm import Encoder, Matcher, Vocabulary, decode, decode_documents, encode_documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", " ", "  ", "\n", "   ", "é", "ß", "日本", "ing", "▁", "12", "\x00", "tion", "th", "e", "x",
         "\t", "🙂", "́", "nn", "<s>", "<0x41>"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


def texts():
    rng = random.Random(1)
    return (["".join(rng.choices(PARTS, k=rng.randint(0, 25))) for _ in range(1500)]
            + ["", " ", "the" * 300, "a" * 500 + " b", " " * 40, "日本" * 80, "x" * 60, "anthethingion" * 9])


@pytest.mark.parametrize("max_chunks", [400_000, 5])
def test_ids_and_text_equal_the_library(library, vocabulary, max_chunks):
    enc = Encoder(vocabulary, max_chunks)
    for batch in (texts(), texts()[:50]):
        for t, got in zip(batch, enc.encode(batch)):
            want = library.encode(t)
            assert np.frombuffer(got, np.uint32).tolist() == want, t
            assert decode(vocabulary, got) == library.decode(want), t


def test_edges_are_all_occurrences(vocabulary):
    data = np.frombuffer("▁the▁theory\xff".encode()[:-2] + b"\xff", np.uint8)
    raw = data.tobytes()
    start, piece = Matcher(vocabulary).edges(data)
    want = sorted((k, p) for p, (b, _, _) in enumerate(vocabulary.pieces) for k in range(len(raw)) if raw.startswith(b, k))
    assert sorted(zip(start.tolist(), piece.tolist())) == want and (np.diff(start) >= 0).all()


def test_documents(spark, library):
    rows = [(1, "two words"), (1, "two words"), (2, None), (3, ""), (None, "no id"), (4, "long " * 40000 + "x" * 30000)]
    docs = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")
    out = decode_documents(encode_documents(docs, MODEL), MODEL).collect()
    assert sorted(((r.id, r.n_tokens, r.decoded) for r in out), key=str) == sorted(
        ((i, len(library.encode(t or "")), t or "") for i, t in rows), key=str)
    empty = docs.filter("false")
    assert decode_documents(encode_documents(empty, MODEL), MODEL).collect() == []


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op7_sentencepiece(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = np.array(library.encode(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
