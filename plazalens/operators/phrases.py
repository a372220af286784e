"""Lexicon entries of several words, met as single tokens of a text (R2, L4).

The phrases are a table keyed by their words. The word n-grams of a text, of
the lengths that occur in the table, meet it by equality, so the time does not
grow with the number of phrases; only a text's own few phrases come back to it,
and there the leftmost and, of those, the longest match wins. A matched phrase
is one token from then on: rules that look at neighbouring tokens see it whole.
A list of few phrases is looked for inside each row instead, which moves no text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.text import tokens
from plazalens.operators.dictionary import DICTIONARY_MAX_ROWS, quote, word_grams
from plazalens.operators.join import maybe_broadcast

IN_PLACE_PHRASES = 32  # so few are looked for in each text; more meet its n-grams
_OPEN, _CLOSE = "\u0001", "\u0002"  # control characters are in no token


def phrase_key(col: str | Column, signs: bool = False) -> Column:
    """The tokens of an entry joined by single blanks, as a merged token reads."""
    return F.array_join(tokens(col, signs=signs), " ")


def phrase_index(entries: DataFrame, col: str = "token", signs: bool = False) -> DataFrame:
    """(key, n): the distinct entries of two or more tokens and their number of tokens."""
    toks = tokens(col, signs=signs)
    return entries.select(F.array_join(toks, " ").alias("key"), F.size(toks).alias("n")).filter("n > 1").distinct()


def _merged(toks: Column, pattern: Column) -> Column:
    """The tokens with every match of ``pattern`` as one token.

    Every token stands between blanks of its own, so adjacent phrases share none.
    """
    line = F.concat(F.lit(" "), F.array_join(toks, "  "), F.lit(" "))
    marked = F.regexp_replace(line, F.concat(F.lit("(?iu)(?:"), pattern, F.lit(")")), F.lit(f"{_OPEN}$0{_CLOSE}"))
    parts = F.regexp_extract_all(marked, F.lit(f"{_OPEN}[^{_CLOSE}]*{_CLOSE}| [^ {_OPEN}{_CLOSE}]+ "), F.lit(0))
    return F.transform(parts, lambda p: F.replace(
        F.trim(F.translate(p, _OPEN + _CLOSE, "")), F.lit("  "), F.lit(" ")))


def _merged_in_place(texts: DataFrame, tokens_col: str, keys: Sequence[str]) -> DataFrame:
    """``merge_phrases`` for a few phrases (longest first): a text's own ones by plain search in its lower-cased line."""
    line = F.concat(F.lit(" "), F.replace(F.lower(F.array_join(tokens_col, " ")), F.lit(" "), F.lit("  ")), F.lit(" "))
    spaced = [f" {k.replace(' ', '  ')} " for k in keys]
    found = F.concat_ws("|", *[F.when(F.contains(F.col("_line"), F.lit(p)), quote(F.lit(p))) for p in spaced])
    marked = texts.withColumn("_line", line).withColumn("_pattern", F.nullif(found, F.lit(""))).drop("_line")
    merged = F.when(F.col("_pattern").isNotNull(), _merged(F.col(tokens_col), F.col("_pattern"))).otherwise(F.col(tokens_col))
    return marked.withColumn(tokens_col, merged).drop("_pattern")


def merge_phrases(texts: DataFrame, tokens_col: str, entries: DataFrame, key: Sequence[str],
                  entry_col: str = "token", signs: bool = False) -> DataFrame:
    """``texts`` with ``tokens_col`` (an array) holding each phrase of ``entries`` as one token.

    ``key`` names columns that tell the token arrays apart, a hash of the text
    for instance: equal keys have equal tokens. Rows, their number and the other columns are
    kept; null and empty arrays, and texts without a phrase, stay as they are.
    Case does not matter and is kept. A text is met whole, whatever its length.
    Up to ``IN_PLACE_PHRASES`` phrases are found in each row, without a shuffle
    (one job brings them). More run a job for the phrase lengths (a few
    numbers) and one for a size check: n-grams are made and met in place; past
    that only texts with a phrase bring their phrases, which AQE broadcasts
    when they are few.
    """
    index = phrase_index(entries, entry_col, signs)
    few = index.limit(IN_PLACE_PHRASES + 1).collect()
    if not few:
        return texts
    if len(few) <= IN_PLACE_PHRASES:
        return _merged_in_place(texts, tokens_col, [r.key for r in sorted(few, key=lambda r: (-r.n, r.key))])
    lengths = sorted(r.n for r in index.select("n").distinct().collect())
    words = F.split(F.lower(F.array_join(tokens_col, " ")), " ")
    grams = texts.select(*key, words.alias("_w")).select(
        *key, F.explode(F.array_distinct(F.concat(*[word_grams(F.col("_w"), n) for n in lengths]))).alias("key"))
    met = grams.join(maybe_broadcast(index, DICTIONARY_MAX_ROWS), "key")
    longest_first = F.sort_array(F.collect_set(F.struct((-F.col("n")).alias("n"), "key")))
    found = met.groupBy(*key).agg(longest_first.alias("_found")).select(*key, F.array_join(F.transform(
        "_found", lambda f: F.concat(F.lit(" "), F.replace(quote(f.key), F.lit(" "), F.lit("  ")), F.lit(" "))), "|")
        .alias("_pattern"))
    merged = F.when(F.col("_pattern").isNotNull(), _merged(F.col(tokens_col), F.col("_pattern"))).otherwise(
        F.col(tokens_col))
    return texts.join(found, list(key), "left").withColumn(tokens_col, merged).drop("_pattern")
