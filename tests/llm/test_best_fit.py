import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from plazalens.llm.best_fit import best_fit, best_fit_pack
from plazalens.llm.queries import op12_best_fit

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
TOK.encode_special_tokens = True


def ids_of(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts, window=1024):
    """Every id of every document once, in gapless sequences of at most ``window``; returns the number of sequences."""
    docs = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert docs.keys() == texts.keys()
    for i, pieces in docs.items():
        ids, at = ids_of(texts[i]), 0
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        for k, r in enumerate(pieces):
            want = (len(ids) - 1) % window + 1 if k == 0 else window
            assert (r.start, r.length) == (at, want)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + want], "<u4").tobytes())
            at += want
        assert at == len(ids)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= window
    return len(sequences)


def frame(spark, texts, parts=4):
    return spark.createDataFrame([(i, t, 1, "b", 0) for i, t in texts.items()],
                                 "doc_id long, text string, bin int, done string, part int").repartition(parts)


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "house", "x", "seven"]) for _ in range(n))


def test_best_fit_takes_the_fullest_bin():
    bins, places = best_fit(np.array([600, 500, 420, 100, 24, 1024]), 1024)
    assert bins.tolist() == [1, 2, 1, 2, 2, 0] and places.tolist() == [0, 0, 600, 500, 600, 0]


def test_pieces_and_few_sequences(spark):
    rng = random.Random(5)
    texts = {k: words(rng, rng.randrange(1, 900)) for k in range(400)}
    texts |= {1000: None, 1001: "", 1002: words(rng, 5000), 1003: words(rng, 1023), 1004: words(rng, 1024), None: "no id"}
    total = sum(len(ids_of(t)) for t in texts.values())
    for parts, options in ((1, {}), (30, {}), (30, dict(fan_in=2, hand_on=3, chunk=8))):
        got = check(best_fit_pack(frame(spark, texts, parts), PATH, **options).collect(), texts)
        least = -(-total // 1024)
        assert least <= got <= least * (1.02 if parts == 1 else 1.05 if not options else 1.35) + 1  # a task holds 13 documents


def test_small_leftovers_of_all_tasks_meet(spark):
    texts = {k: words(random.Random(k), 60) for k in range(64)}  # a few ids a task
    assert check(best_fit_pack(frame(spark, texts, 32), PATH).collect(), texts) <= -(-sum(len(ids_of(t)) for t in texts.values()) // 1024) + 1


def test_ids_repeated_rows_and_empty_table(spark):
    rows = [(1, "same words"), (1, "same words"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = best_fit_pack(docs, PATH, with_ids=True).collect()
    assert len(got) == 3 and sorted(r.offset for r in got) == [0, *sorted(len(ids_of(t)) for t in [rows[2][1]] + [rows[0][1]])][:1] + sorted(r.offset for r in got)[1:]
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == sorted(ids_of(t) for _, t in rows)
    assert best_fit_pack(docs.filter("false"), PATH).collect() == []


def test_query_over_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = check(op12_best_fit(spark, sf).collect(), texts)
    assert got <= 1.02 * -(-sum(len(ids_of(t)) for t in texts.values()) // 1024) + 1
