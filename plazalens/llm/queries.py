"""The queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.llm.ann import nearest
from plazalens.llm.best_fit import best_fit_pack
from plazalens.llm.common import read_table
from plazalens.llm.huffman import encode_to_files, read_files, with_crc32
from plazalens.llm.lexical import rank_documents
from plazalens.llm.licenses import scan_licenses
from plazalens.llm.line_dedup import line_dedup
from plazalens.llm.packing import pack
from plazalens.llm.prefix_trie import COLUMNS, prefix_trie, rebuilt, sequences
from plazalens.llm.quality import in_fold, learn as learn_quality, score_documents
from plazalens.llm.secrets import find_secrets, learn, span_text
from plazalens.llm.simhash import near_dedup
from plazalens.llm.spm import decode_documents, encode_documents
from plazalens.llm.topk import top_products
from plazalens.session import scratch_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                      F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = """
WITH l AS (
  SELECT doc_id, pos, lines[pos] AS line,
         translate(trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
r AS (
  SELECT k, max(doc_id) AS keep FROM l WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT doc_id, pos, line, r.k IS NOT NULL AND doc_id <> r.keep AS dropped
  FROM l LEFT JOIN r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


KEEP_SCORE = 0.3


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, learn_quality(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", in_fold("doc_id").alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                mode="spaces", end_id=0, window=1024)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return out.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text that they decode to, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    tokens = encode_documents(read_table(spark, sf_dir, "documents"), model)
    return decode_documents(tokens, model).select(
        F.col("id").alias("doc_id"), "n_tokens", F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    encode_to_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"),
                    mode="words", end_id=1)
    return with_crc32(read_files(spark, path)).withColumnRenamed("id", "doc_id")


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10, scale=1024)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
q AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM q, v WHERE q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = find_secrets(docs, learn(docs))

    def of(kind: int):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return out.select(F.col("id").alias("doc_id"), of(0).alias("n_assign"), of(1).alias("n_access"),
                      of(2).alias("n_hex"), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                      span_text(F.col("spans")).alias("spans"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(sequences(read_table(spark, sf_dir, "conversations")))).select(*COLUMNS)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                         mode="spaces", end_id=2, window=1024)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ts)) AS n_all FROM d WHERE len(ts) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)),
o AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM o, s GROUP BY t, n_docs),
p AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all)))) AS BIGINT) AS score
  FROM q JOIN o USING (t) JOIN w USING (t), s GROUP BY item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_quality, op3_licenses, op4_packing, op5_nearest, op6_simhash,
    op7_sentencepiece, op8_token_files, op9_top_products, op10_secrets, op11_prefix_trie, op12_best_fit,
    op13_ranked_search)}
ORACLE = {"op1_line_dedup": OP1_SQL, "op9_top_products": OP9_SQL, "op13_ranked_search": OP13_SQL}
