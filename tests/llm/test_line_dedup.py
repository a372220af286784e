import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_pipeline import brute_lines

import __spark_entry__ as E
from plazalens.llm.line_dedup import keep_bitmaps, line_dedup
from tools.oracle_check import rows_of

A, B, C = "a line of some twenty letters", "Another line of twenty letters", "\t A LINE of some twenty letters \x0b"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, line_dedup string, id int")


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_repeated_lines_stay_in_the_largest_document(spark):
    rows = [(1, f"{A}\nshort\n{B}"), (2, f"{C}\n{A}\n"), (9, f"{A}\n{A}\nx"), (5, B), (7, "short\nshort"), (8, "short")]
    out = line_dedup(frame(spark, rows).drop("line_dedup"))
    assert texts(out) == sorted([(1, f"short\n{B}"), (2, ""), (9, f"{A}\n{A}\nx"), (5, B), (7, "short\nshort"), (8, "short")])
    counts = {r.doc_id: tuple(r.line_dedup) for r in out.collect()}
    assert counts[2] == (3, 2) and counts[9] == (3, 0) and counts[8] == (1, 0)
    assert out.columns == ["doc_id", "text", "id", "line_dedup"]


def test_repeated_ids_are_one_document(spark):
    out = line_dedup(frame(spark, [(5, f"{A}\nx"), (5, A), (7, A)]))
    assert texts(out) == [(5, f"{A}\nx"), (5, A), (7, A)] or texts(out) == [(5, A), (5, f"{A}\nx"), (7, A)]
    out = line_dedup(frame(spark, [(5, f"{A}\nx"), (5, A), (7, A), (6, A)]))
    assert sorted(t for _, t in texts(out)) == ["", "", A, "x"]


def test_clashing_columns_are_handed_through(spark):
    out = line_dedup(frame(spark, [(1, A), (2, A), (3, A)]))
    assert out.columns == ["doc_id", "text", "line_dedup", "id", "line_dedup_"]
    assert sorted((r.text, r.line_dedup, r.id, r.line_dedup_.n_dropped) for r in out.collect()) == [
        ("", "x", 7, 1), ("", "x", 7, 1), (A, "x", 7, 0)]


def test_odd_rows(spark):
    long = "\n".join(f"{A} {k % 500}" for k in range(3000))
    rows = [(None, A), (None, A), (3, A), (4, None), (4, ""), (5, long), (6, long), (7, long), (3, A), (8, "é" * 19 + "\n" + "é" * 20)]
    got = texts(line_dedup(frame(spark, rows).select("doc_id", "text")))
    want = [(None, ""), (None, ""), (3, A), (3, A), (4, None), (4, ""), (5, ""), (6, ""), (7, long), (8, rows[-1][1])]
    assert [(i, t or "") for i, t in got] == [(i, t or "") for i, t in sorted(want, key=str)]
    assert keep_bitmaps(frame(spark, []).select("doc_id", "text")).collect() == []
    assert line_dedup(frame(spark, []).select("doc_id", "text")).collect() == []


lines = st.sampled_from([A, A.upper(), f" {A}\t", B, "short", "", "é" * 20, "É" * 20, "x" * 20, "x" * 19 + " "])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(lines, max_size=90).map("\n".join), max_size=8))
def test_any_documents_match_brute_force(spark, docs):
    rows = list(enumerate(docs))
    out = line_dedup(frame(spark, rows).select("doc_id", "text"))
    assert {i: t for i, t in texts(out)} == brute_lines(rows)


def test_plan_is_native(spark):
    df = line_dedup(frame(spark, [(1, A)]).select("doc_id", "text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_query_matches_its_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = E.queries()[name](spark, sf)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(res.fetchall(), cols)


def test_a_hot_line_is_spread_before_the_range_partition(spark):
    from plazalens.llm.line_dedup import repeated_keys
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(A)).otherwise(
        F.concat(F.lit("a line that is only here "), "id")).alias("text"))
    assert [r.keep for r in repeated_keys(df, "doc_id", "text", 20, 3).collect()] == [2997]
