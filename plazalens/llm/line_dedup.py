"""Line dedup: keep bitmaps per document instead of rewritten text.

Method: every eligible line is reduced to a 128-bit hash of its key; the
hashes (once per document) are pre-aggregated per (hash, salt),
range-partitioned by hash with a secondary sort by document, and the first
row of each hash - its largest document - is streamed out with the number of
documents. Lines whose hash repeats lose their place everywhere else; the
answer is one compressed bitmap per document that loses a line. Only
DataFrame functions are used.

Defined results: a null text is one empty line; rows that share an id are one
document for the repeat count, and all rows with the largest id keep their
lines; each row without an id is a document of its own, below all ids; a line that stands several times in
a document stays or goes as a whole; a text of any length is split whole; an
empty table gives an empty result; other columns are handed through whatever
their names, and the counts are added as ``line_dedup``, or that with as many
underscores as make it a new name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import ascii_lower, free_name

WHITE = " \t\n\x0b\x0c\r"


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, th): ``th`` is a hash of the text; with the id it names the row's list of lines."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return d.withColumn("th", F.xxhash64("t"))


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _eligible(line: Column, min_chars: int) -> Column:
    return (F.char_length(line) >= min_chars) & (F.char_length(F.btrim(line, F.lit(WHITE))) >= min_chars)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def repeated_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int,
                  salts: int = 32) -> DataFrame:
    """(h1, h2, keep): hashes found in ``min_docs`` documents and their largest id.

    The salt spreads a hot hash over ``salts`` groups, each summed map-side
    first, so the range partition gets at most ``salts`` rows of one hash.
    """
    lines = F.filter(F.split("t", "\n", -1), lambda x: _eligible(x, min_chars))
    both = F.array_distinct(F.transform(lines, lambda x: F.concat_ws(":", *_hashes(_key(x)))))
    once = _rows(docs, id_col, text_col).select("id", F.explode(both).alias("k")).select(
        F.substring_index("k", ":", 1).cast("long").alias("h1"),
        F.substring_index("k", ":", -1).cast("long").alias("h2"),
        F.pmod(F.hash("id"), F.lit(salts)).alias("salt"), "id")
    # the rows of one id have one salt; repeats of an id go before the counts are made
    per_id = once.groupBy("h1", "h2", "salt", "id").agg(F.count("*").alias("n"))
    summed = per_id.groupBy("h1", "h2", "salt").agg(
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(1)).alias("n"), F.max("id").alias("last"))
    ranged = summed.repartitionByRange("h1", "h2").sortWithinPartitions(
        "h1", "h2", F.col("last").desc_nulls_last())
    group = Window.partitionBy("h1", "h2")
    return (ranged.withColumn("r", F.row_number().over(group.orderBy(F.col("last").desc_nulls_last())))
            .withColumn("docs", F.sum("n").over(group))
            .filter((F.col("r") == 1) & (F.col("docs") >= min_docs))
            .select("h1", "h2", F.col("last").alias("keep")))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, th, n_dropped, keep) of every document that loses a line.

    ``keep`` holds (word, bits) for each 64-line word with a dropped line,
    bit i set when line ``64 * word + i`` stays; absent words keep all lines.
    """
    repeated = repeated_keys(docs, id_col, text_col, min_chars, min_docs)
    lines = (_rows(docs, id_col, text_col).select("id", "th", F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
             .filter(_eligible(F.col("line"), min_chars)).withColumn("key", _key(F.col("line"))))
    h1, h2 = _hashes(F.col("key"))
    lines = lines.select("id", "th", "pos", h1.alias("h1"), h2.alias("h2"))
    dropped = lines.join(repeated, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keep")))
    words = (dropped.select("id", "th", F.shiftright("pos", 6).alias("word"),
                            F.expr("shiftleft(1L, pos % 64)").alias("bit"))
             .repartition("id", "th").groupBy("id", "th", "word").agg(F.bit_or("bit").alias("bits")))
    return words.groupBy("id", "th").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with its text cut to the kept lines, plus n_lines and n_dropped.

    All columns of ``docs`` come back under their names (``n_lines`` and
    ``n_dropped`` of the result are in a struct column after them).
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(row, F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = d.withColumn("th", F.xxhash64("t"))
    b = bitmaps.select(F.col("id").alias("b_id"), F.col("th").alias("b_th"), "n_dropped", "keep")
    j = d.join(b, d["id"].eqNullSafe(b["b_id"]) & (d["th"] == b["b_th"]), "left")
    # the bitmap's words in order, the absent ones filled with all ones
    j = j.withColumn("dense", F.expr(
        "flatten(transform(keep, (e, i) -> concat(array_repeat(-1L,"
        " e.word - 1 - if(i = 0, -1, get(keep, i - 1).word)), array(e.bits))))"))
    j = j.withColumn("lines", F.split("t", "\n", -1))
    kept = F.expr("array_join(filter(lines, (l, i) -> (coalesce(shiftright(get(dense, shiftright(i, 6)),"
                  " i % 64), -1L) & 1L) = 1L), '\\n')")
    t = F.when(F.col("keep").isNull(), F.col("t")).otherwise(kept)
    return j.select("row", t.alias("kept"), F.struct(
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped")).alias("line_dedup")).select(
        *[F.col("kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns],
        F.col("line_dedup").alias(free_name("line_dedup", docs)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Bitmaps computed and applied in one go."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
