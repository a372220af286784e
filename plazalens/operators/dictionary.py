"""Texts that hold a term of a long list (F1): an equality join of word n-grams.

One alternation has to be compiled and tried whole, at every word. Here the
list is a table keyed by the words of each term; a text's word n-grams, of the
lengths that occur in the list, meet it by equality, so the time does not grow
with the number of terms. What meets is checked by the term's own pattern:
the answer is that of ``matches_terms``, punctuation inside a term
included.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.operators.join import maybe_broadcast

DICTIONARY_MAX_ROWS = 1_000_000  # broadcast up to so many terms, tens of MB; beyond it AQE chooses
_WORDS = "[a-z0-9_]+"
_SPECIAL = r"([\\.\[\]{}()*+?^$|#&~-])"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))


def _dictionary(terms: DataFrame, term_col: str) -> DataFrame:
    """(term, key, n): distinct lower-cased terms, their words as one string and their number."""
    t = terms.select(F.lower(F.col(term_col)).alias("term")).filter(F.col("term") != "").distinct()
    return t.select("term", F.array_join(_words(F.col("term")), " ").alias("key"), F.size(_words(F.col("term"))).alias("n"))


def quote(term: Column) -> Column:
    """A term as a pattern that matches it literally."""
    return F.regexp_replace(term, F.lit(_SPECIAL), F.lit(r"\\$1"))


def _at_boundaries(text: Column, term: Column) -> Column:
    return F.rlike(text, F.concat(F.lit(r"\b"), quote(term), F.lit(r"\b")))


def word_grams(words: Column, n: int) -> Column:
    """The word n-grams of an array, as strings."""
    last = F.size(words) - n + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def dictionary_hits(texts: DataFrame, text_col: str, terms: DataFrame, term_col: str = "term") -> DataFrame:
    """(text, terms): each distinct lower-cased text that holds terms between word boundaries, with those terms, sorted.

    Null texts and null or empty terms take no part; of equal terms one is
    named. A text is met whole, whatever its length: its n-grams carry a hash
    of it, and it meets the few terms found there once. Runs a job for the
    term lengths of the list (a few numbers) and one for its size check.
    """
    words = _dictionary(terms, term_col)
    lengths = sorted(r.n for r in words.select("n").distinct().collect())
    distinct = texts.select(F.lower(F.col(text_col)).alias("text")).filter(F.col("text").isNotNull()).distinct()
    hashed = distinct.select(F.xxhash64("text").alias("h"), "text")
    parts = [hashed.limit(0).select("h", F.lit("").alias("term"))]
    keyed = [n for n in lengths if n > 0]
    if keyed:
        grams = F.array_distinct(F.concat(*[word_grams(F.col("w"), n) for n in keyed]))
        met = hashed.select("h", _words(F.col("text")).alias("w")).select("h", F.explode(grams).alias("key")).join(
            maybe_broadcast(words.filter("n > 0").select("key", "term"), DICTIONARY_MAX_ROWS), "key")
        parts.append(met.select("h", "term"))
    if 0 in lengths:  # terms without an ASCII word: by their first character
        chars = hashed.select("h", F.explode(F.array_distinct(F.split("text", ""))).alias("c"))
        odd = words.filter("n = 0").select(F.substring("term", 1, 1).alias("c"), "term")
        parts.append(chars.join(odd, "c").select("h", "term"))
    found = functools.reduce(DataFrame.unionByName, parts).groupBy("h").agg(F.collect_set("term").alias("found"))
    held = F.filter("found", lambda t: _at_boundaries(F.col("text"), t))
    return hashed.join(found, "h").select("text", F.sort_array(held).alias("terms")).filter(F.size("terms") > 0)


def filter_dictionary(df: DataFrame, col: str, terms: DataFrame, term_col: str = "term") -> DataFrame:
    """Rows of ``df`` whose ``col`` holds a term, as ``filter_terms`` keeps them; repeated rows stay (F1).

    Distinct texts only meet the list; rows come back by a semi join on the text, which AQE splits on a hot one.
    """
    hit = dictionary_hits(df, col, terms, term_col).select(F.col("text").alias("_text"))
    return df.join(hit, F.lower(F.col(col)) == F.col("_text"), "left_semi")
