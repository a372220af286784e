import collections

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F
from test_secrets import brute_base
from test_simhash import brute_components

import __spark_entry__ as E
from plazalens.llm.common import read_table

SF = "/root/testdata/sf0.001"


def brute_lines(rows, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"
    low = {c: c + 32 for c in range(65, 91)}
    keys = [[x.strip(strip).translate(low) for x in (t or "").split("\n")] for _, t in rows]
    docs = collections.defaultdict(set)
    for (i, _), ks in zip(rows, keys):
        for k in ks:
            if len(k) >= min_chars:
                docs[k].add(i)
    out = {}
    for (i, t), ks in zip(rows, keys):
        kept = [x for x, k in zip((t or "").split("\n"), ks) if len(docs.get(k, ())) < min_docs or max(docs[k]) == i]
        out[i] = "\n".join(kept)
    return out


def brute_mask(text):
    out, done = [], 0
    for s, _, e in brute_base(text):
        if s >= done:
            out += [text[done:s], "[SECRET]"]
        done = max(done, e)
    return "".join(out) + text[done:]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = read_table(spark, SF, "documents"), []
    out.append(docs)
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), "test_stage")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "secret scans", "packing"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes
        assert df.filter("n_chars <> char_length(text)").count() == 0


def test_quality_keeps_good_documents(spark, steps):
    kept, labels = texts(steps[1]), {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    before = texts(steps[0])
    assert kept.items() <= before.items()
    assert all(i in kept for i, q in labels.items() if q == 1 and i in before)
    bad = [i in kept for i, q in labels.items() if q == 0 and i in before]
    assert sum(bad) <= 0.25 * len(bad)  # 200 documents train it here; see test_quality for held-out figures


def test_lines_match_brute_force(steps):
    rows = sorted(texts(steps[1]).items())
    assert texts(steps[2]) == brute_lines(rows)


def test_one_of_each_group_stays(steps):
    rows = sorted(texts(steps[2]).items())
    want = {i for i, _, c in brute_components(rows) if i == c}
    assert texts(steps[3]) == {i: t for i, t in rows if i in want}


def test_secrets_are_masked(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert after == {i: brute_mask(t) for i, t in before.items()}


def test_packing_covers_what_is_left(steps):
    out = steps[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in out} == set(texts(steps[4])) and all(r.n == r.all for r in out)


def test_run_is_the_registered_query(spark, steps):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = E.queries()["pipeline"](spark, SF)
    got = rows.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = steps[5].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(got) == sorted(want) and set(key) < set(rows.columns)


def test_odd_rows_pass_all_stages(spark):
    rows = [(1, None, "en"), (1, None, "en"), (None, "no id here", None), (2, "", "de"), (3, "x " * 100000, "en"),
            (4, "password=abcdefabcdef0123", None)]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for start in (docs, docs.filter("false")):
        d = start
        for _, stage in P.STAGES:
            d = P.written(stage(spark, d, SF), "odd")
        ids = {r.doc_id for r in d.collect()}
        assert ids <= {1, None, 2, 3, 4} and (not start.isEmpty() or not ids)


def test_repeated_and_missing_ids(spark):
    rng = __import__("random").Random(3)
    other = [" ".join(rng.choices([f"word{k}" for k in range(500)], k=40)) for _ in range(4)]
    rows = [(1, other[0]), (1, other[1]), (None, other[2]), (None, other[2]), (None, other[0]), (2, other[1]), (None, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "a", 1, 2, "b") for i, t in rows],
                                 "doc_id long, text string, key string, row int, id int, line_dedup string")
    out = P.keep_one_of_each_group(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, other[0]), (1, other[1]), (None, other[2]), (3, "")], key=str)


def test_clashing_columns_pass_all_stages(spark):
    rows = [(k, f"a line of text that is number {k} here\nsecond", "a", 1, 2, "b", 0.5) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, row int, id int, line_dedup string, score double")
    d = docs
    for _, stage in P.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.dtypes == docs.dtypes
    assert P.STAGES[-1][1](spark, d, SF).select("doc_id").distinct().count() == d.count()


def test_finished_stages_leave_no_tables(spark):
    from pathlib import Path

    from plazalens.session import scratch_root

    root = Path(scratch_root(spark).replace("file:", ""))
    before = set(root.iterdir())
    P.run(spark, SF).count()
    names = {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p not in before and not p.name.count("-") == 4}
    assert names == {"stage_3", "packing"}


def test_few_planted_formats_are_masked(spark):
    keys = ["mk-" + "".join("QXZ7890"[(k * k * 5 + j * (k + 3)) % 7] for j in range(20)) for k in range(16)]
    rows = [(k, f"api_key={v} end" if k < 12 else f"see {v} end") for k, v in enumerate(keys)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert texts(P.mask_secrets(spark, docs, SF)) == {k: "[SECRET] end" if k < 12 else "see [SECRET] end" for k, _ in rows}
