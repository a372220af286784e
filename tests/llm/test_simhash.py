import itertools

import numpy as np
import pytest
import xxhash

from plazalens.llm.components import star_components
from plazalens.llm.simhash import bit_sliced_links, fingerprint, links, near_dedup


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for w in "\t\n\x0b\x0c\r":
        words = words.replace(w, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=2):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a][1] ^ fps[b][1]).bit_count() <= radius:
            parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted([(i, fp, low.get(find(k))) for k, (i, fp) in enumerate(fps)], key=str)


def answer(df):
    return sorted([(r.id, r.fp % (1 << 64), r.component_id) for r in df.collect()], key=str)


def test_fingerprint_matches_brute_force():
    for t in ["", "one", "One two", "a b c d e f g a b c", "É è\tß\n x  y\x0bz \xa0q", "w " * 70000]:
        assert fingerprint(t.encode()) == brute_fingerprint(t)


@pytest.mark.parametrize("cap", [4096, 3])
def test_components_match_brute_force(spark, cap):
    base = " ".join(f"w{k}" for k in range(300))
    rows = [(k, base + " " + "tail" * (k % 3)) for k in range(12)]
    rows += [(20 + k, " ".join(f"v{j + k}" for j in range(400))) for k in range(10)]
    rows += [(40, None), (41, ""), (42, " \n"), (None, "lonely words here"), (None, base), (43, "A b"), (44, "a B"),
             (45, "a B"), (46, "x" * 200000)]
    df = spark.createDataFrame([(i, t, i, "c") for i, t in rows], "doc_id long, text string, id long, fp string")
    assert answer(near_dedup(df, cap=cap)) == brute_components(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup(df).collect() == []


def test_close_fingerprints_link_with_and_without_chunks(spark):
    rng = np.random.default_rng(3)
    roots = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = set()
    for r in roots.tolist():
        for _ in range(12):
            x = r
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    want = set()
    group = {x: x for x in fps}
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 2 and group[a] != group[b]:
            lo, hi = sorted((group[a], group[b]))
            group = {k: lo if v == hi else v for k, v in group.items()}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for cap in (4096, 4):
        stars = {r.a: r.b for r in star_components(links(nodes, 2, cap)).collect()}
        got = {}
        for x, sx in zip(fps, signed):
            got.setdefault(stars.get(sx, sx), set()).add(x)
        want = {}
        for x in fps:
            want.setdefault(group[x], set()).add(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_hot_group_of_dense_neighbours():
    # every pair of the group is within two bits: the forest stays linear
    fp = np.array([0] + [1 << b for b in range(64)], np.uint64)
    pairs = list(bit_sliced_links(fp, np.zeros(65, np.int64), 2))
    assert sum(len(i) for i, _ in pairs) <= 2 * 65


def test_long_chain_settles(spark):
    edges = spark.range(400).selectExpr("id as a", "id + 1 as b")
    stars = star_components(edges)
    assert stars.filter("b <> 0").count() == 0 and stars.count() == 400
