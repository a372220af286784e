"""Column expressions over text: term filters, state extraction, tokens.

All of these are built-in Spark expressions (JVM side, code-generated); no
Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.schemas import US_STATES

_REGEX_META = set("\\.^$|?*+()[]{}")


def escape_regex(term: str) -> str:
    """Escape regex metacharacters, leaving letters, spaces and '&' alone."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in term)


def grouped_alternation(alternatives: Iterable[str]) -> str:
    """``(?:a1|a2|...)`` with alternatives sharing a first letter grouped.

    ``(?:Alabama|AL|Alaska|...)`` becomes ``(?:A(?:labama|L|laska|...)|...)``.
    Alternatives that start with different letters can never match at the
    same position, and inside a group the original order is kept, so the
    leftmost-first result is the same as the flat alternation; the regex
    engine just stops trying 100 alternatives at every character.
    Alternatives must be escaped already; one that starts with a non-letter
    stays a group of its own.
    """
    groups: dict[str, list[str]] = {}
    order: list[str] = []
    for a in alternatives:
        key = a[0] if a and a[0].isalnum() else "\0" + a
        if key not in groups:
            groups[key] = []
            order.append(key)
        groups[key].append(a)
    parts = []
    for key in order:
        alts = groups[key]
        if len(alts) == 1 or key.startswith("\0"):
            parts.extend(alts)
        else:
            parts.append(key + "(?:" + "|".join(a[1:] for a in alts) + ")")
    return "(?:" + "|".join(parts) + ")"


def term_pattern(terms: Iterable[str], lower: bool = True) -> str:
    """Whole-word alternation ``\\b(t1|t2|...)\\b`` over the given terms.

    Terms are lower-cased (the text is lower-cased before matching) and
    escaped, so a term is matched literally.
    """
    seen: list[str] = []
    for t in terms:
        t = t.lower() if lower else t
        if t not in seen:
            seen.append(t)
    return r"\b(" + "|".join(escape_regex(t) for t in seen) + r")\b"


def fast_term_pattern(terms: Iterable[str], lower: bool = True) -> str:
    """Same matches as :func:`term_pattern`, alternatives grouped by letter."""
    seen: list[str] = []
    for t in terms:
        t = t.lower() if lower else t
        if t not in seen:
            seen.append(t)
    return r"\b" + grouped_alternation(escape_regex(t) for t in seen) + r"\b"


def matches_terms(col: str | Column, terms: Iterable[str]) -> Column:
    """True when the lower-cased text contains one of the terms as a word."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c).rlike(fast_term_pattern(terms))


def filter_terms(df: DataFrame, col: str, terms: Iterable[str]) -> DataFrame:
    """Keep rows whose ``col`` holds one of ``terms`` as a whole word (F1)."""
    return df.filter(matches_terms(col, terms))


def state_pattern(states: Iterable[tuple[str, str]] = US_STATES) -> str:
    """Alternation of every state name and code as a whole word, in order."""
    parts = []
    for name, code in states:
        parts.append(r"\b" + escape_regex(name) + r"\b")
        parts.append(r"\b" + escape_regex(code) + r"\b")
    return "|".join(parts)


def fast_state_pattern(states: Iterable[tuple[str, str]] = US_STATES) -> str:
    """Same matches as :func:`state_pattern`: ``\\b(?:grouped names and codes)\\b``.

    Every alternative of the flat pattern is ``\\bX\\b``; factoring the word
    boundaries out of an ordered alternation keeps the leftmost-first choice
    (a failed trailing boundary backtracks into the next alternative).
    """
    alts = []
    for name, code in states:
        alts += [escape_regex(name), escape_regex(code)]
    return r"\b" + grouped_alternation(alts) + r"\b"


def extract_state(col: str | Column, anchor: str = "first", default: str = "Unknown",
                  states: Iterable[tuple[str, str]] = US_STATES) -> Column:
    """State name or code found in an address.

    ``anchor="first"`` takes the leftmost hit, as the reference does (so in
    "Kansas City, MO" the city wins, D12); ``anchor="last"`` takes the
    rightmost hit, which is where a postal address puts the state.
    No hit gives ``default``.
    """
    c = F.col(col) if isinstance(col, str) else col
    pat = fast_state_pattern(states)
    # The regex runs once per row: no alternative can match the empty string,
    # so an empty extraction means "no hit" (the reference tests with rlike
    # first and then extracts, two passes of a 100-way alternation).
    if anchor == "first":
        hit = F.nullif(F.regexp_extract(c, pat, 0), F.lit(""))
    elif anchor == "last":
        hit = F.try_element_at(F.regexp_extract_all(c, F.lit(pat), F.lit(0)), F.lit(-1))
    else:
        raise ValueError("anchor must be 'first' or 'last'")
    return F.coalesce(hit, F.lit(default))


def state_code_map(states: Iterable[tuple[str, str]] = US_STATES) -> Column:
    """Literal name -> code map (50 entries, fixed size)."""
    kv = []
    for name, code in states:
        kv += [F.lit(name), F.lit(code)]
    return F.create_map(*kv)


def map_state(col: str | Column, states: Iterable[tuple[str, str]] = US_STATES) -> Column:
    """State name -> code; anything else (codes, 'Unknown') kept as is.

    A literal map lookup: a row expression with no join and no Python.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.element_at(state_code_map(states), c), c)


#: a word: letters of any script, with apostrophes inside it ("isn't")
WORD = r"\p{L}+(?:'\p{L}+)*"


#: a chunk of signs between white space: two or more characters without a letter, at least one of them
#: neither digit nor letter (":)", "<3", "+1"), or eyes, at most one nose and a letter (":D", ":-p")
SIGNS = r"(?<![^\t-\r ])(?:(?=\p{N}*[^\p{N}\t-\r ])[^\p{L}\p{Cc} ]{2,}|[:;=%|][-^'*]?\p{L})(?![^\t-\r ])"


def tokens(col: str | Column, lower: bool = True, signs: bool = False) -> Column:
    """Words of a text (L1), lower-cased by default, the curly apostrophe read as the straight one.

    ``signs`` adds chunks of signs, as emoticons are, in their places. A text
    without a token gives an empty array, a null text a null array.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = F.replace(c, F.lit("\u2019"), F.lit("'"))
    pattern = f"{SIGNS}|{WORD}" if signs else WORD
    return F.regexp_extract_all(F.lower(c) if lower else c, F.lit(pattern), F.lit(0))


def tokenize(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """One row per token: (id, pos, token), pos 0-based over non-empty tokens.

    ``posexplode`` is a narrow operation: tokens never leave the partition of
    their text.
    """
    return df.select(id_col, F.posexplode(tokens(text_col)).alias("pos", "token"))


def contains_ci(col: str | Column, pattern: str) -> Column:
    """Case-insensitive regex search; null text gives false (F2)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.rlike("(?i)" + pattern), F.lit(False))


def truncate(col: str | Column, n: int) -> Column:
    """First ``n`` characters."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, n)
