"""Lexicon sentiment as a Spark job.

Plan: tokens of each text are built as an array inside its row; with rules
on, every token takes its three preceding tokens by index from the same
array (no window, no shuffle of tokens, no lambda). The tokens are exploded in
place, joined with the lexicon (broadcast behind a size check), adjusted by
booster and negation rules as column arithmetic, and summed per review. The
sum runs as a partial aggregate before the only shuffle, so each partition
sends one row per review. Texts never leave their partition.

Entries of several words are merged into single tokens before that
(``operators/phrases.py``).

The score is the published compound normalisation ``s / sqrt(s*s + 15)``.
Negators, boosters, capitals, the contrast word, '!'/'?', idioms, emoticons and
the "never so" and "least" cases follow the published rules. An idiom counts
wherever it stands, not only beside a word of the lexicon.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.functions.text import escape_regex, tokens
from plazalens.operators.join import maybe_broadcast
from plazalens.operators.phrases import merge_phrases, phrase_key
from plazalens.schemas import (
    BOOSTER_DAMPING,
    BOOSTER_INCREMENT,
    BOOSTERS_DOWN,
    BOOSTERS_DOWN_PHRASES,
    BOOSTERS_UP,
    CAPITALS_INCREMENT,
    CONTRAST_AFTER,
    CONTRAST_BEFORE,
    EXCLAMATION_MAX,
    EXCLAMATION_STEP,
    IDIOMS,
    LEAST_EXCEPT_AFTER,
    LEXICON,
    QUESTION_CAP,
    QUESTION_MAX_COUNT,
    QUESTION_STEP,
    NEGATION_SCALAR,
    NEGATIVE_TO,
    NEGATORS,
    NEVER_SO_FACTOR,
    NEVER_SO_WORDS,
    POSITIVE_FROM,
    VADER_ALPHA,
)

#: the published rules, for ``sentiment_scores(..., **PUBLISHED_RULES)``
PUBLISHED_RULES = dict(
    negators=NEGATORS,
    boosters=[(w, BOOSTER_INCREMENT) for w in BOOSTERS_UP] + [(w, -BOOSTER_INCREMENT) for w in BOOSTERS_DOWN + BOOSTERS_DOWN_PHRASES],
    contrast="but", punctuation=True, capitals=True, idioms=IDIOMS, emoticons=True, special_cases=True)
SUM_EPSILON = 1e-9  # far below any real valence sum, far above summation noise (~1e-15)
LEXICON_MAX_ROWS = 1_000_000  # a (token, valence) hash table of tens of MB per executor


def _lexicon_lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(line, token, valence) of every non-blank line; a valence that is no number is null."""
    lines = spark.read.text(path).withColumnRenamed("value", "line").filter(F.trim("line") != "")
    fields = F.split("line", escape_regex(sep), -1)
    return lines.select("line", F.nullif(F.lower(F.trim(F.get(fields, F.lit(0)))), F.lit("")).alias("token"),
                        F.trim(F.get(fields, F.lit(1))).try_cast("double").alias("valence"))


def read_lexicon(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Lexicon file: one ``token<sep>valence`` per line, extra fields ignored (L2).

    Lines that are not of this form are left out here and reported by
    :func:`lexicon_rejects`; a repeated token is resolved by :func:`unique_lexicon`.
    """
    return unique_lexicon(_lexicon_lines(spark, path, sep).select("token", "valence").na.drop())


def lexicon_rejects(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """The non-blank lines that :func:`read_lexicon` leaves out."""
    return _lexicon_lines(spark, path, sep).filter("token IS NULL OR valence IS NULL").select("line")


def unique_lexicon(lexicon: DataFrame) -> DataFrame:
    """One row per lower-cased token: of several, the valence of largest size (then the larger)."""
    return (lexicon.select(F.lower("token").alias("token"), F.struct(F.abs("valence"), "valence").alias("v"))
            .groupBy("token").agg(F.max("v").alias("v")).select("token", "v.valence"))


def lexicon_frame(spark: SparkSession, entries: Iterable[tuple[str, float]]) -> DataFrame:
    return spark.createDataFrame([(t, float(v)) for t, v in entries], LEXICON)


def _count_char(text: Column, ch: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(ch), F.lit("")))


def punctuation_emphasis(text: Column) -> Column:
    """Emphasis from '!' and '?' in a text (published rule, see schemas)."""
    ep = F.least(_count_char(text, "!"), F.lit(EXCLAMATION_MAX)) * F.lit(EXCLAMATION_STEP)
    qm = _count_char(text, "?")
    qa = (F.when(qm <= 1, F.lit(0.0))
           .when(qm <= QUESTION_MAX_COUNT, qm * F.lit(QUESTION_STEP))
           .otherwise(F.lit(QUESTION_CAP)))
    return F.coalesce(ep + qa, F.lit(0.0))


def compound(s: Column, alpha: float = VADER_ALPHA) -> Column:
    """Published normalisation of a valence sum into [-1, 1]."""
    return s / F.sqrt(s * s + F.lit(alpha))


def label(score: Column, parity: bool = False) -> Column:
    """positive (>= 0.3), neutral (between), negative.

    A null score gives a null label; ``parity=True`` gives 'negative' as
    the reference's ``otherwise`` does (D9).
    """
    lab = (F.when(score >= POSITIVE_FROM, F.lit("positive"))
            .when((score > NEGATIVE_TO) & (score < POSITIVE_FROM), F.lit("neutral")))
    if parity:
        return lab.otherwise(F.lit("negative"))
    return lab.when(score.isNotNull(), F.lit("negative"))


def _in_capitals(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _literal_map(pairs: Sequence[tuple[str, float]]) -> Column | None:
    kv = []
    for w, v in pairs:
        kv += [F.lit(w), F.lit(v)]
    return F.create_map(*kv) if kv else None


def _modifiers(lex: DataFrame, boosters: Sequence[tuple[str, float]]) -> DataFrame:
    """Boosters that act on the next words: those that are not lexicon words.

    ``lex`` is the (size-checked, broadcast) lexicon, so the anti join is
    map-side; the result has at most ``len(boosters)`` rows and is broadcast.
    """
    spark = lex.sparkSession
    bdf = spark.createDataFrame([(w.lower(), float(v)) for w, v in boosters], "token string, scalar double")
    return F.broadcast(bdf.join(lex.select("token"), "token", "left_anti"))


def sentiment_scores(
    reviews: DataFrame,
    lexicon: DataFrame,
    id_col: str = "review_id",
    text_col: str = "text",
    negators: Sequence[str] | None = None,
    boosters: Sequence[tuple[str, float]] | None = None,
    alpha: float = VADER_ALPHA,
    round_to: int | None = None,
    contrast: str | None = None,
    punctuation: bool = False,
    capitals: bool = False,
    idioms: Sequence[tuple[str, float]] | None = None,
    emoticons: bool = False,
    special_cases: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(id, ``keep`` columns, sentiment_score), one row for every review; null text -> null score.

    ``negators`` / ``boosters`` switch on the rules of the three preceding
    tokens (L4): a booster adds +-scalar (sign follows the valence), damped
    0.95 / 0.9 at distance 2 / 3; a negator multiplies by -0.74.
    ``contrast`` (e.g. ``"but"``) halves the valences before the first
    occurrence of that word and multiplies those after it by 1.5;
    ``punctuation`` adds the '!'/'?' emphasis to a non-zero sum; ``capitals``
    moves a word in capitals away from zero when the text is of mixed case.
    ``idioms`` (also an empty list) are added to the lexicon, and all entries of
    several words, of lexicon, boosters and negators alike, are met as one
    token: leftmost first, then longest. ``emoticons`` makes chunks of signs
    tokens, so that lexicon entries such as ``:)`` are met.
    ``special_cases``: "never so" and "never this" strengthen a word instead of
    negating it, and "least" negates the next word except after "at" and "very".

    Ids may repeat, as the gold review key does (D11): token sums are grouped
    by id and a 128-bit hash of the text; rows that share both have one score,
    which is given once for each of them. Of a token that the lexicon lists
    twice the valence of largest size counts.
    """
    rules = bool(negators) or bool(boosters) or special_cases
    toks = tokens(text_col, lower=not capitals, signs=emoticons)
    extra = []
    if contrast and idioms is None:
        extra.append(F.array_position(tokens(text_col, signs=emoticons), contrast.lower()).alias("_cpos"))
    if capitals:
        loud = F.size(F.filter(toks, _in_capitals))
        extra.append(((loud > 0) & (loud < F.size(toks))).alias("_mixed"))
    if punctuation:
        extra.append(punctuation_emphasis(F.col(text_col)).alias("_amp"))
    kept = [f"_k{i}" for i in range(len(keep))]
    text = F.col(text_col)
    base = reviews.select(F.col(id_col).alias("_id"), *[F.col(c).alias(k) for c, k in zip(keep, kept)],
                          text.isNull().alias("_null"), F.xxhash64(text).alias("_h1"),
                          F.xxhash64(F.lit(1), text).alias("_h2"), toks.alias("_t"), *extra)
    if idioms is not None:
        lexicon = lexicon.select("token", "valence").unionByName(lexicon_frame(lexicon.sparkSession, idioms))
        other = [w for w, _ in boosters or []] + list(negators or [])
        entries = lexicon.select("token").unionByName(lexicon_frame(lexicon.sparkSession, [(w, 0.0) for w in other])
                                                      .select("token"))
        base = merge_phrases(base, "_t", entries, ["_h1", "_h2"], signs=emoticons)
        several = phrase_key("token", emoticons)
        lexicon = lexicon.withColumn("token", F.when(F.contains(several, F.lit(" ")), several).otherwise(F.col("token")))
        boosters = [(" ".join(w.split()), x) for w, x in boosters or []]
        negators = [" ".join(w.split()) for w in negators or []]
        if contrast:
            base = base.withColumn("_cpos", F.array_position(F.transform("_t", F.lower), contrast.lower()))
    key = ["_id", *kept, "_null", "_h1", "_h2"]
    carry = [c for c in ("_cpos", "_amp", "_mixed") if c in base.columns]  # per-text values
    exploded = base.select(*key, "_t", *carry, F.posexplode_outer("_t").alias("_pos", "token"))
    if rules or contrast:
        # preceding tokens by index into the same array; inside the fused
        # stage the array is referenced, not copied per token
        exploded = exploded.select(
            *key, "token", "_pos", *carry,
            *[F.lower(F.get(F.col("_t"), F.col("_pos") - k)).alias(f"p{k}") for k in (1, 2, 3)])
    else:
        exploded = exploded.drop("_t")

    if capitals:
        exploded = exploded.withColumn("_loud", F.col("_mixed") & _in_capitals(F.col("token"))).withColumn(
            "token", F.lower("token"))
    lex = maybe_broadcast(unique_lexicon(lexicon.select("token", "valence")), LEXICON_MAX_ROWS)
    # words without a valence add nothing; a text's first row stays to stand for the text
    scored = exploded.join(lex, "token", "left").filter(
        F.col("valence").isNotNull() | (F.coalesce(F.col("_pos"), F.lit(0)) == 0))
    v = F.col("valence")
    if capitals:
        v = F.when(F.col("_loud"), v + F.signum(v) * CAPITALS_INCREMENT).otherwise(v)
    if rules:
        boosters = list({w.lower(): float(x) for w, x in (boosters or [])}.items())  # the last of a repeated word
        neg = [w.lower() for w in (negators or [])]
        if boosters:
            # a booster word carries no valence of its own
            v = F.when(F.element_at(_literal_map(boosters), F.coalesce(F.col("token"), F.lit(""))).isNotNull(),
                       F.lit(None).cast("double")).otherwise(v)
            mods = _modifiers(lex, boosters)
            for k in (1, 2, 3):
                m = mods.select(F.col("token").alias(f"_m{k}"), F.col("scalar").alias(f"_s{k}"))
                scored = scored.join(m, F.col(f"p{k}") == F.col(f"_m{k}"), "left")
        for k in (1, 2, 3):
            prev = F.coalesce(F.col(f"p{k}"), F.lit(""))
            if boosters:
                b = F.col(f"_s{k}") * F.lit(BOOSTER_DAMPING[k])
                v = v + F.coalesce(F.when(v < 0, -b).otherwise(b), F.lit(0.0))
            change = F
            if special_cases and k > 1:
                between = [F.coalesce(F.col(f"p{j}"), F.lit("")).isin(NEVER_SO_WORDS) for j in range(1, k)]
                change = change.when((prev == "never") & functools.reduce(Column.__or__, between),
                                     v * F.lit(NEVER_SO_FACTOR[k]))
            if neg:
                change = change.when(prev.isin(neg), v * F.lit(NEGATION_SCALAR))
            v = v if change is F else change.otherwise(v)
        if special_cases:  # "least" as a word of the lexicon has its valence instead
            least = _modifiers(lex, [("least", 0.0)]).select(F.col("token").alias("_least"))
            scored = scored.join(least, F.col("p1") == F.col("_least"), "left")
            v = F.when(F.col("_least").isNotNull() & ~F.coalesce(F.col("p2"), F.lit("")).isin(LEAST_EXCEPT_AFTER),
                       v * F.lit(NEGATION_SCALAR)).otherwise(v)
    if contrast:
        # token index vs the (1-based) index of the first contrast word
        c0 = F.col("_cpos") - 1
        factor = (F.when((F.col("_cpos") > 0) & (F.col("_pos") < c0), F.lit(CONTRAST_BEFORE))
                   .when((F.col("_cpos") > 0) & (F.col("_pos") > c0), F.lit(CONTRAST_AFTER))
                   .otherwise(F.lit(1.0)))
        v = v * factor
    # a row starts at its first token (or its only, empty one)
    aggs = [F.sum(F.coalesce(v, F.lit(0.0))).alias("_s"),
            F.count_if(F.coalesce(F.col("_pos"), F.lit(0)) == 0).alias("_rows")]
    if punctuation:
        aggs.append(F.max("_amp").alias("_amp"))
    agg = scored.groupBy(*key).agg(*aggs)
    s_col = F.col("_s") / F.col("_rows")
    if punctuation:
        # The sign test ignores summation noise: a sum that is zero in exact
        # arithmetic can come out as +-1e-16 depending on the order of the
        # additions, and must not be amplified to +-1.168.
        s_col = (F.when(s_col > SUM_EPSILON, s_col + F.col("_amp"))
                  .when(s_col < -SUM_EPSILON, s_col - F.col("_amp")).otherwise(s_col))
    score = F.when(F.col("_null"), F.lit(None).cast("double")).otherwise(compound(s_col, alpha))
    if round_to is not None:
        # + 0.0 turns a rounded -0.0 into 0.0
        score = F.round(score, round_to) + F.lit(0.0)
    one = agg.select(*key, "_rows", score.alias("sentiment_score"))
    return one.select(F.col("_id").alias(id_col), *[F.col(k).alias(c) for c, k in zip(keep, kept)], "sentiment_score",
                      F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_row")).drop("_row")


def sentiment_table(reviews: DataFrame, lexicon: DataFrame, id_col: str = "review_id",
                    text_col: str = "text", parity: bool = False, keep: Sequence[str] = (), **kw) -> DataFrame:
    """(review_id, sentiment_score double, sentiment, ``keep`` columns), a row for each review.

    Without further arguments the published rules apply (``PUBLISHED_RULES``);
    arguments for :func:`sentiment_scores` replace them altogether, except ``round_to``.
    """
    rules = {k: v for k, v in kw.items() if k != "round_to"} or PUBLISHED_RULES
    s = sentiment_scores(reviews, lexicon, id_col, text_col, keep=keep, round_to=kw.get("round_to"), **rules)
    return s.select(F.col(id_col).alias("review_id"),
                    F.col("sentiment_score").cast("double").alias("sentiment_score"),
                    label(F.col("sentiment_score"), parity).alias("sentiment"), *keep)


def extremes(table: DataFrame, n: int, highest: bool, score_col: str = "sentiment_score",
             id_col: str = "review_id") -> DataFrame:
    """Lowest (T2) or highest (T3) ``n`` by score, ties by id.

    ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own top ``n`` and only those reach the final merge.
    """
    order = F.col(score_col).desc_nulls_last() if highest else F.col(score_col).asc_nulls_last()
    return table.orderBy(order, F.col(id_col).asc()).limit(n)
