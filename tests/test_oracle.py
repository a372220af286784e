"""Every catalogue query against its DuckDB oracle on sf0.001, plus entry()."""

import duckdb
import pytest
from conftest import SF0001

import __spark_entry__ as E

from plazalens.plans import catalog  # noqa: E402
import tools.oracle_check as oc  # noqa: E402
from tools.oracle_check import TABLES, rows_of  # noqa: E402

oc.STRICT = True  # floats must be bit-identical to the oracle's

QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}  # the others are tested in tests/llm
ORACLE = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF0001)
    srows = rows_of([tuple(r) for r in sdf.collect()], sdf.columns)
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert srows == rows_of(res.fetchall(), dcols)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "gmap_id", "rating", "text", "date", "review_id"]
    assert df.count() > 0
