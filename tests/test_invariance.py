"""Same results under different shuffle partition counts; stage invariants."""

import pytest
from conftest import SF0001

from plazalens.plans import catalog
from tools.oracle_check import rows_of


def _rows(spark, name):
    df = catalog.QUERIES[name](spark, SF0001)
    return rows_of([tuple(r) for r in df.collect()], df.columns)


@pytest.mark.parametrize("name", ["gold_reviews", "sentiment_score_rules", "recommend_similar_bulk",
                                  "recommend_nearby_bulk", "pk_duplicates", "cosine_to_anchor"])
def test_partition_count_invariance(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(_rows(spark, name))
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_sentiment_rows_equal_review_rows(spark):
    texts = catalog.dv.texts(spark, SF0001)
    assert catalog.QUERIES["sentiment_table"](spark, SF0001).count() == texts.count()


