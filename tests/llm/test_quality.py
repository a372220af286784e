import zlib

import numpy as np
import pyarrow as pa
import pytest

from plazalens.llm import quality as Q
from plazalens.llm.common import text_slices
from plazalens.llm.queries import op2_quality

SF = "/root/testdata/sf0.01"


def feature_lists(texts):
    out = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.string())):
        buckets, text = Q.features(data, offsets)
        out += [sorted(buckets[text == i].tolist()) for i in range(len(offsets) - 1)]
    return out


def test_features_do_not_depend_on_neighbouring_texts():
    texts = ["a a word", "", None, "word", "x", "é é\nfoo  bar", "tail "]
    assert feature_lists(texts) == [feature_lists([t])[0] for t in texts]
    n_words = [3, 0, 0, 1, 1, 4, 1]
    same = [1, 0, 0, 0, 0, 1, 0]
    for t, w, s, f in zip(texts, n_words, same, feature_lists(texts)):
        n = len((t or "").encode())
        assert len(f) == w + s + sum(max(0, n - g + 1) for g in Q.GRAMS)


def test_equal_substrings_share_a_bucket():
    a, b = feature_lists(["abcd", "zz abcd"])
    assert set(a) <= set(b)


def test_held_out_accuracy_and_columns(spark):
    out = op2_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(out) == n
    held = [r for r in out if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    good = [r.predicted for r in held if labels[r.doc_id] == 1]
    bad = [r.predicted for r in held if labels[r.doc_id] == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.1


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    assert (Q.learn(docs, labels).odds == Q.learn(docs, flipped).odds).all()


def brute_scores(rows, labels, max_rows=Q.MAX_ROWS):
    """Scores from features counted text by text in plain Python, with the learner's own gradient steps."""
    def buckets(t):
        raw = (t or "").encode()
        mask, p = (1 << 64) - 1, int(Q._P)

        def bucket(piece, salt):
            h = (sum((c + 1) * pow(p, k, 1 << 64) for k, c in enumerate(piece)) + salt) * int(Q._MIX) & mask
            h ^= h >> 32
            return (h * int(Q._MIX) & mask) >> (64 - Q.BITS)

        words = raw.split()
        out = [bucket(w, 1) for w in words]
        out += [0 for a, b in zip(out, out[1:]) if a == b]
        return out + [bucket(raw[k:k + g], g) for g in Q.GRAMS for k in range(len(raw) - g + 1)]

    got = {k: buckets(t) for k, (_, t) in enumerate(rows)}
    by_id = {i: k for k, (i, _) in enumerate(rows)}
    some = [i for i in labels if i in by_id and zlib.crc32(str(i).encode()) % 5]
    train = []
    for i in some:
        u, c = np.unique(got[by_id[i]], return_counts=True)
        train.append((i, labels[i], u.astype("<i4"), c.astype("<i4")))
    train.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    model = Q.train([(u, c, y) for _, y, u, c in train])
    return {i: 1 / (1 + np.exp(-np.mean(model.odds[got[k]]))) if got[k] else .5 for k, (i, _) in enumerate(rows)}


def test_scores_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    short = [(i, t[:1500] if t else t) for i, t in docs] + [(100_000, None), (100_001, "")]
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    d = spark.createDataFrame(short, "doc_id long, text string")
    lab = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    got = {r.doc_id: r.score for r in Q.score_documents(d, Q.learn(d, lab)).collect()}
    want = brute_scores(short, labels)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-9


def test_learning_rows_are_bounded_whatever_the_ids(spark):
    rows = [(2, f"text number {k}") for k in range(50)] + [(2, "same")] * 50 + [(3, "other words"), (4, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (3, 0), (4, 0)], "doc_id long, quality int")
    seen = []
    old = Q.train
    try:
        Q.train = lambda rows, **k: seen.append(rows) or old(rows, **k)
        Q.learn(docs, labels, max_rows=10, max_bytes=4000)
    finally:
        Q.train = old
    assert sorted(y for _, _, y in seen[0]).count(1) == 10 and len(seen[0]) <= 12


@pytest.mark.parametrize("n_labels", [0, 1])
def test_without_both_labels_every_text_scores_a_half(spark, n_labels):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "text", "c"), (3, "text", "c"), (None, "x" * 100000, "d")],
                                 "doc_id long, text string, id string")
    labels = spark.createDataFrame([(3, 1), (1, None)][:n_labels * 2], "doc_id long, quality int")
    scored = Q.score_documents(docs, Q.learn(docs, labels))
    assert [r.score for r in scored.collect()] == [0.5] * 5


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.score_documents(docs, Q.learn(docs, labels)).collect() == []
