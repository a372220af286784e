import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from plazalens.llm import prefix_trie as T
from plazalens.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, node string, open int"


def brute(rows):
    """Nodes of the trie from every prefix of every rebuilt conversation."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, *x[2:]))] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    below = collections.defaultdict(list)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not below[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.select(*T.COLUMNS).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)


def some_rows(seed, convs, texts, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        rows += [(c, k, rng.choice(["user", "assistant"]), rng.choice(texts)) for k in range(rng.randrange(1, longest))]
    return rows


TEXTS = ["", "a", "bb", "é" * 5, "long " * 30]


@pytest.mark.parametrize("at_once", [1_000_000, 40, 6])
def test_nodes_match_brute_force(spark, at_once):
    rows = some_rows(1, [*range(0, 60), *range(100, 260, 3), 500, 777], TEXTS)
    rows += [(c, k, "user", "hot") for c in range(300, 380) for k in range(3)]  # one conversation a third of all times
    rows += [(None, 1, "user", "x"), (5, None, None, None), (5, None, "user", None), (0, 1, "user", "bb"), (-250, 1, None, "z")]
    random.Random(2).shuffle(rows)
    got = answer(T.prefix_trie(T.rebuilt(T.sequences(frame(spark, rows))), at_once))
    assert got == brute(rows)


def test_single_and_empty(spark):
    assert answer(T.prefix_trie(T.rebuilt(T.sequences(frame(spark, []))))) == []
    rows = [(101, 1, "user", "only")]  # crc32 decides whether its turn goes
    assert answer(T.prefix_trie(T.rebuilt(T.sequences(frame(spark, rows))))) == brute(rows)
    long = [(600, k, "user", "t" * (k % 3)) for k in range(120)] + [(601, k, "user", "t" * (k % 3)) for k in range(90)]
    long += [(600, 3001, "user", "y" * 300_000)]
    assert answer(T.prefix_trie(T.rebuilt(T.sequences(frame(spark, long))))) == brute(long)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    out = op11_prefix_trie(spark, sf)
    assert tuple(out.columns) == T.COLUMNS and answer(out) == brute(rows)


def test_extents_are_those_of_a_scan():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(0, 4, n)
        table = T.SparseTable(values)
        for least in range(1, 4):
            at = np.arange(n)
            want_right = [next((k - 1 for k in range(i + 1, n) if values[k] < least), n - 1) for i in range(n)]
            want_left = [next((k for k in range(i, 0, -1) if values[k] < least), 0) for i in range(n)]
            assert table.right(at, np.full(n, least)).tolist() == want_right
            assert table.left(at, np.full(n, least)).tolist() == want_left
        lo = rng.integers(0, n, 50)
        hi = np.minimum(n - 1, lo + rng.integers(0, n, 50))
        assert table.least(lo, hi).tolist() == [values[a:b + 1].min() for a, b in zip(lo, hi)]
