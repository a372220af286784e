import collections
import math
import random
import re

import numpy as np
import pytest

from plazalens.llm import lexical as X
from plazalens.llm.queries import op13_ranked_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def terms(t):
    return TERM.findall((t or "").translate(LOW))


def brute(docs, items, k=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    everything = sum(b.total() for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if t is not None:
            asked[i] = min(asked.get(i, t), t, key=lambda x: x.encode())
    out = []
    for i, t in asked.items():
        scored = []
        for doc, bag in bags:
            n, score = bag.total(), 0
            for q in set(terms(t)):
                if bag[q]:
                    m = 10 + 90 * n * n_docs // everything
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1))) * (10 ** 9 * bag[q] // (1000 * bag[q] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(i, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, terms string").repartition(3),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int"))


VOCABULARY = [f"w{k}" for k in range(60)] + ["É", "é", "Straße", "A1", "a1", "x"]


def test_ranks_match_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choices(VOCABULARY, k=rng.randrange(0, 50)))) for k in range(300)]
    docs += [(k, "w1, w2;w3_W1") for k in range(300, 330)] + [(None, "w1 w2 w3 w1"), (7, "w1 w2 w3"), (8, None), (9, ""), (10, "--")]
    items = [(k, " ".join(rng.choices(VOCABULARY, k=rng.randrange(1, 20)))) for k in range(90)]
    items += [(200, None), (201, "..."), (202, "unknown words"), (3, "w1"), (None, "w1 w2")]
    d, q = frames(spark, docs, items)
    want = brute(docs, items)
    assert answer(X.rank_documents(d, q)) == want
    assert answer(X.rank_documents(d, q, max_bytes=900)) == want  # several passes
    assert answer(X.rank_documents(d, q, k=1)) == brute(docs, items, 1)


def test_tiles_add_up(monkeypatch):
    rng = np.random.default_rng(7)
    weights = rng.integers(0, 40000, 500)
    items = [(k, sorted(rng.choice(500, 80, replace=False).tolist())) for k in range(64)]
    doc, term = np.repeat(np.arange(40), 100), np.concatenate([rng.choice(500, 100, replace=False) for _ in range(40)])
    impact = rng.integers(1, 10 ** 6, len(doc))
    want = np.array([[sum(int(weights[t]) * int(i) for t, i in zip(term[doc == d], impact[doc == d]) if t in own)
                      for _, own in items] for d in range(40)])
    for width in (2048, 7):
        monkeypatch.setattr(X, "VOCABULARY_TILE", width)
        docs, got = X.ItemTile(items, weights).scores(doc, term, impact)
        assert docs.tolist() == list(range(40)) and (got == want).all()


def test_no_partial_sum_reaches_the_limit_of_doubles():
    tile = X.ItemTile([(0, [0])], np.array([(1 << 53) // X.IMPACTS // 3]))
    assert tile.width * ((1 << 53) // X.IMPACTS // 3) * X.IMPACTS < 1 << 53 and tile.width == 3
    assert X._impacts(np.array([10 ** 12]), np.array([5]), 10 ** 12, 10 ** 14)[0] == 5 * 10 ** 9 // (5000 + 8 * (10 + 90 * 10 ** 10))


def test_long_texts_are_read_whole(spark, monkeypatch):
    monkeypatch.setattr(X, "STEP", 1000)
    text = " ".join(["Wort", "é" * 700, "x" * 1500, "--" * 600, "tail"] * 50)
    assert X.count_terms(text.encode()) == {t.encode(): n for t, n in collections.Counter(terms(text)).items()}


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "a")])])
def test_empty_and_tiny(spark, docs, items):
    d, q = frames(spark, docs, items)
    assert answer(X.rank_documents(d, q)) == (brute(docs, items) if docs and items else [])


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert answer(op13_ranked_search(spark, sf)) == brute(docs, items)
