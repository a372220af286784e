"""The corpus pipeline: each stage calls one operator of ``plazalens.llm``.

Documents that the quality classifier rejects go; repeated lines go; of each
group of near-duplicates the document with the smallest id stays; secrets are
masked; what is left is packed. Every stage but the last returns the columns
of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.llm import quality, secrets
from plazalens.llm.common import free_name, read_table, remove_table, scratch_scope, written
from plazalens.llm.line_dedup import line_dedup
from plazalens.llm.packing import pack
from plazalens.llm.queries import KEEP_SCORE
from plazalens.llm.simhash import near_dedup


def _recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """``docs`` in the columns of ``like``, its n_chars counted again."""
    if "n_chars" in like.columns:
        kind = like.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.char_length("text").cast(kind))
    return docs.select(like.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of score ``KEEP_SCORE`` or more under the quality classifier."""
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"))
    score = free_name("score", docs)
    scored = quality.score_documents(docs, model, score_col=score)
    return scored.filter(F.col(score) >= KEEP_SCORE).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the one of largest id."""
    return _recounted(line_dedup(docs), docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that of smallest id, then smallest text hash; no id counts as the largest."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"),
                   F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")).alias("key")
    keyed = docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    groups = near_dedup(keyed.select("key", F.col("row.text").alias("text")), id_col="key", shingle=3, radius=2)
    first = groups.filter(F.col("id") == F.col("component_id")).select(F.col("id").alias("key"))
    # equal rows have one key; they go on the join's partitioning
    return keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mask."""
    return _recounted(secrets.mask_secrets(docs, secrets.learn(docs)), docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the documents in sequences of 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), mode="spaces", end_id=0, window=1024)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("secret scans", mask_secrets),
    ("packing", pack_documents),
]
ORACLE_SQL = None  # no stage after the trained classifier can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again for the next.

    What a stage wrote for itself goes when its result stands, and a result when the next one does.
    """
    docs, last = read_table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        if k + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        with scratch_scope(spark) as made:
            docs = written(stage(spark, docs, sf_dir), f"stage_{k}")
            result = made.pop()
        if last:
            remove_table(spark, last)
        last = result
    return docs
