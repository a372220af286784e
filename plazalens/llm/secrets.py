"""Secret scan with automata inferred from the credentials of the corpus itself.

Method: three fixed patterns find labelled credentials. A bounded sample of
their distinct values per kind (``max_examples`` of smallest hash, at most
``max_symbols`` characters in all, values over ``LONG`` characters last) is
parted by format, that is by the sequence of signs between letters and digits.
Each format's values are written as a prefix tree over character classes whose
statistically compatible states are merged (Hoeffding test) into one
probabilistic automaton; formats of fewer than three values also share one.
The unlabelled runs of the whole corpus - runs of 12 or more credential
characters, closing full stops aside, each distinct one once - give the
background: an automaton over the parts between ``=`` and ``/`` whose states
are the last two characters. Every such run is scored by the likelihood ratio
of its format's automata to the background, or to independent characters of
plain text (``_PRIOR``) where these explain a part better; ``MIN_BITS`` or more
make it a span of kind ``format``. Of a run that is none, each part of 12
characters or more is scored too. What has that ratio to plain characters
alone is not counted into the background. A candidate is left out only where a
base span covers it whole.

Defined results: a null text is empty; positions are code points, the end
exclusive; repeated rows get equal answers, and of tied formats any gives the
same span; a text of any length is scanned whole; with no labelled credential
the patterns alone answer; an empty table gives an empty result. Other columns
are not read, or handed through by ``mask_secrets``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache, text_slices, written
from plazalens.llm.grammar import Automaton, shape

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a match is a maximal run
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
SIGNS = "+/_.=-"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + SIGNS
LEAST = 12  # characters of a candidate
MIN_BITS = 16.0  # likelihood ratio of a span, log2
MAX_EXAMPLES = 1500  # distinct labelled values per kind
MAX_SYMBOLS = 1 << 18  # their characters per kind
LONG = 4096
SLICE = 1 << 20  # bytes of text that are scanned at a time
CACHE_BYTES = 8 << 20  # verdicts kept by a task
SPAN = "array<struct<start:long,kind:int,end:long>>"

_CODE = np.zeros(256, np.uint8)  # 0 is no credential character, and the edge of a run
_CODE[list(LETTERS.encode())] = np.arange(1, len(LETTERS) + 1)
_STATES = len(LETTERS) + 1
_HEXIT = np.zeros(256, bool)
_HEXIT[list(b"0123456789abcdef")] = True
_SKELETON = str.maketrans("", "", LETTERS[:62])

#: Independent characters of plain text: the end, capitals, small letters, digits, signs.
_PRIOR = np.array([0.05] + [0.15 / 26] * 26 + [0.5 / 26] * 26 + [0.2 / 10] * 10 + [0.1 / 6] * 6)
_PLAIN = np.log2(_PRIOR)
_BACK = 4  # a context's weight for the next shorter one, for each of its different followers
_PART = re.compile("[^=/]+")


def format_of(value: str) -> str:
    """The signs of a value in order."""
    return value.translate(_SKELETON)


def _runs(member: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` member bytes; no run goes on into the next text."""
    first = np.zeros(len(member) + 1, bool)
    first[offsets] = True
    begin, end = member.copy(), member.copy()
    begin[1:] &= ~member[:-1] | first[1:-1]
    end[:-1] &= ~member[1:] | first[1:-1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = e - s >= least
    return s[long], e[long]


def worth_patterns(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text can hold a base span: a superset, found on the raw bytes of many texts at once."""
    hit = np.zeros(len(offsets), bool)
    raw = data.tobytes()
    low = raw.lower()
    for word, text in (*((w, low) for w in KEYWORDS), (b"AKIA", raw)):
        k = text.find(word)
        while k >= 0:
            i = int(np.searchsorted(offsets, k, side="right")) - 1
            hit[i] = True
            k = text.find(word, int(offsets[i + 1]) - len(word) + 1)  # one hit a text is enough; a word may lie over an edge
    s, _ = _runs(_HEXIT[data], offsets, 16)
    hit[np.searchsorted(offsets, s, side="right") - 1] = True
    return hit[:-1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, str]]:
    """(text, start, end, value) of every candidate run; places are bytes of the text."""
    s, e = _runs(_CODE[data] > 0, offsets, LEAST)
    raw = data.tobytes()
    texts = np.searchsorted(offsets, s, side="right") - 1
    for i, a, b, first in zip(texts.tolist(), s.tolist(), e.tolist(), offsets[texts].tolist()):
        value = raw[a:b].rstrip(b".")
        if len(value) >= LEAST:
            yield i, a - first, a - first + len(value), value.decode("ascii")


def pieces_of(value: str) -> list[tuple[int, int]]:
    """The value whole, then its parts between '=' and '/' that are long enough."""
    inner = [m.span() for m in _PART.finditer(value)]
    return [(0, len(value))] + [(a, b) for a, b in inner if LEAST <= b - a < len(value)]


def grams(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(contexts and characters as one number, number of the value) for each character and the end of each value."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    codes = _CODE[np.frombuffer(("\0\0" + "\0\0\0".join(values) + "\0").encode("ascii"), np.uint8)].astype(np.int32) if values else np.zeros(0, np.int32)
    ends = np.cumsum(sizes + 3)  # two edges before each value and one after
    at = np.arange(len(codes))
    before = np.zeros(len(codes), bool)
    before[ends - sizes - 3] = before[ends - sizes - 2] = True
    at = at[~before]
    return (codes[at - 2] * _STATES + codes[at - 1]) * _STATES + codes[at], np.repeat(np.arange(len(values)), sizes + 1)


class Background:
    """Order-two automaton of the parts of the unlabelled runs; plain characters where nothing was counted."""

    def __init__(self, three: np.ndarray | None = None):
        three = np.zeros(_STATES ** 3, np.int64) if three is None else three
        cube = three.reshape(_STATES, _STATES, _STATES)
        square = cube.sum(axis=0)
        # counts of a character after two, one and no character, and of each context and its different followers
        counts = [square.sum(axis=0), square.ravel(), three]
        seen = [np.array([square.sum()]), square.sum(axis=1), cube.sum(axis=2).ravel()]
        kinds = [np.array([np.count_nonzero(counts[0])]), np.count_nonzero(square, axis=1), np.count_nonzero(cube, axis=2).ravel()]
        p = _PRIOR
        for n in (0, 1, 2):  # a context of n characters backs off to that of n - 1
            weight = _BACK * np.maximum(1, kinds[n])
            shorter = np.tile(p.reshape(-1, _STATES), (len(seen[n]) * _STATES // p.size, 1))
            p = (counts[n].reshape(-1, _STATES) + weight[:, None] * shorter) / (seen[n] + weight)[:, None]
        self.logs = np.log2(p).ravel()

    def bits(self, parts: list[str]) -> np.ndarray:
        """Log2 likelihood of each part and its end; that of plain characters where it is larger."""
        gram, part = grams(parts)
        return np.maximum(np.bincount(part, weights=self.logs[gram], minlength=len(parts)),
                          np.bincount(part, weights=_PLAIN[gram % _STATES], minlength=len(parts)))


def _formats(values: list[str]) -> tuple[dict[str, Automaton], Automaton | None]:
    """An automaton for each format, and one for all values of formats seen less than three times."""
    groups = defaultdict(list)
    for v in values:
        groups[format_of(v)].append(v)
    rare = [v for g in groups.values() if len(g) < 3 for v in g]
    return ({k: Automaton([shape(v) for v in g], values=g) for k, g in groups.items()},
            Automaton([shape(v) for v in rare], values=rare) if rare else None)


class Scorer:
    """Spans of candidate values under a model, remembered while they fit ``CACHE_BYTES``."""

    def __init__(self, formats: dict, background: np.ndarray | None):
        self.formats, self.background = list(formats.values()), Background(background)
        self.known: dict[str, tuple] = {}
        self.held = 0

    def spans(self, values: list[str]) -> dict[str, tuple]:
        """value -> its places that are secrets."""
        if not self.formats:
            return {}
        fresh = [v for v in dict.fromkeys(values) if v not in self.known]
        if fresh:
            if self.held > CACHE_BYTES:
                self.known, self.held, fresh = {}, 0, list(dict.fromkeys(values))
            parts = list(dict.fromkeys(p for v in fresh for p in _PART.findall(v)))
            bits = dict(zip(parts, self.background.bits(parts).tolist()))
            got: dict[str, list] = {v: [] for v in fresh}
            for v in fresh:
                for a, b in pieces_of(v):
                    own = _PART.findall(v[a:b])
                    low = sum(map(bits.get, own)) + (b - a - sum(map(len, own))) * _PLAIN[-1]
                    if self._fits(v[a:b], low + MIN_BITS):
                        got[v].append((a, b))
                        if b - a == len(v):
                            break
            self.known |= {v: tuple(p) for v, p in got.items()}
            self.held += sum(map(len, fresh)) + 150 * len(fresh)
        return self.known

    def _fits(self, value: str, least: float) -> bool:
        own = format_of(value)
        return any(a is not None and a.bits(value, least) > -math.inf
                   for formats, rare in self.formats for a in (formats.get(own), rare))


def _in_text(raw: np.ndarray, spans: list[tuple[int, int]], text: str) -> list[tuple[int, int]]:
    """Byte spans of ASCII values as code points."""
    if len(text) == len(raw):
        return spans
    shift = [int(np.count_nonzero((raw[:a] & 0xC0) == 0x80)) for a, _ in spans]
    return [(a - k, b - k) for (a, b), k in zip(spans, shift)]


def _outside(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each span is not covered whole by a base span."""
    best, reach = 0, []  # the farthest end of the base spans that start so early
    for s, _, e in base:
        best = max(best, e)
        reach.append(best)
    starts = [s for s, _, _ in base]
    return [not (k := bisect_right(starts, a)) or reach[k - 1] < b for a, b in spans]


def _scan(column: pa.Array, scorer: Scorer) -> Iterator[tuple[int, str, list, list]]:
    """(row, text, base spans, all spans) of the texts that have a span."""
    for lo, _, data, offsets in text_slices(column, SLICE):
        found = list(candidates(data, offsets))
        known = scorer.spans([f[3] for f in found])
        learned: dict[int, list] = defaultdict(list)
        for i, start, _, value in found:
            for a, b in known.get(value, ()):
                learned[i].append((start + a, start + b))
        for i in sorted({*np.flatnonzero(worth_patterns(data, offsets)).tolist(), *learned}):
            raw = data[offsets[i]:offsets[i + 1]]
            text = raw.tobytes().decode("utf-8", "replace")
            base = base_spans(text)
            more = _in_text(raw, learned.get(i, []), text)
            yield lo + i, text, base, sorted(base + [(a, 3, b) for (a, b), free in zip(more, _outside(more, base)) if free])


def labelled_credentials(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, value): the key's value, access key or hex run of every base match; kind 3 for each other candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        for b in batches:
            for _, _, data, offsets in text_slices(b.column(0), SLICE):
                rows: dict[tuple[int, str], None] = {}
                runs = defaultdict(list)
                for i, start, end, value in candidates(data, offsets):
                    runs[i].append((start, end, value))
                patterns = worth_patterns(data, offsets)
                for i in np.flatnonzero(patterns).tolist():
                    raw = data[offsets[i]:offsets[i + 1]]
                    text = raw.tobytes().decode("utf-8", "replace")
                    base = base_spans(text)
                    rows |= {(0, m.group(2)): None for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12}
                    rows |= {(kind, text[s:e]): None for s, kind, e in base if kind}
                    free = _outside(_in_text(raw, [r[:2] for r in runs[i]], text), base)
                    runs[i] = [r for r, f in zip(runs[i], free) if f]
                rows |= {(3, value): None for own in runs.values() for _, _, value in own}
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()),
                                                  pa.array([v for _, v in rows], pa.string())], ["kind", "value"])

    return docs.select(F.col(text_col).alias("t")).mapInArrow(run, "kind int, value string")


def _count_grams(runs: DataFrame, formats: dict) -> np.ndarray:
    """Counts of three characters in a row over the runs, less what a format explains better than plain characters."""
    shared = runs.sparkSession.sparkContext.broadcast(formats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, total = Scorer(shared.value, None), np.zeros(_STATES ** 3, np.int64)
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                values = b.column(0).slice(k, 1024).to_pylist()
                known = scorer.spans(values)
                parts = [m.group() for v in values for m in _PART.finditer(v)
                         if not any(s <= m.start() and m.end() <= e for s, e in known[v])]
                total += np.bincount(grams(parts)[0], minlength=len(total))
        some = np.flatnonzero(total)
        for k in range(0, len(some), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(some[k:k + 10_000]), pa.array(total[some[k:k + 10_000]])], ["gram", "n"])

    counted = runs.select("value").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(_STATES ** 3, np.int64)
    out[counted.column("gram").to_numpy()] = counted.column("n").to_numpy()
    return out


def learn(docs: DataFrame, text_col: str = "text", max_examples: int = MAX_EXAMPLES, max_symbols: int = MAX_SYMBOLS) -> dict:
    """The automata of each kind and the counts of the background; empty where the corpus labels no credential.

    At most ``max_examples`` values of ``max_symbols`` characters a kind come
    to the driver; the background is counted on all runs.
    """
    found = written(labelled_credentials(docs, text_col).distinct(), "credentials")
    counts = {r["kind"]: r["count"] for r in found.filter("kind < 3").groupBy("kind").count().collect()}
    formats = {}
    for kind, n in sorted(counts.items()):
        own = found.filter((F.col("kind") == kind) & (F.length("value") <= max_symbols)).withColumn("h", F.xxhash64("value"))
        if n > 2 * max_examples:  # about 2 * max_examples rows are left for the exact choice below
            own = own.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * 2 * max_examples / n))
        order = [F.length("value") > LONG, F.pmod("h", F.lit(1 << 30)), F.col("value")]
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sample = own.orderBy(*order).limit(max_examples).withColumn("all", F.sum(F.length("value")).over(before))
        values = [r["value"] for r in sample.filter(F.col("all") <= max_symbols).select("value").collect()]
        if values:
            formats[kind] = _formats(sorted(values))
    return {"formats": formats, "background": _count_grams(found.filter("kind = 3"), formats)} if formats else {}


def find_secrets(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: the pattern spans, and those with the learned ones, by start and kind."""
    id_type = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_symbols states a kind, and the counts

    def listed(spans: list) -> list:
        return [dict(start=s, kind=k, end=e) for s, k, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        scorer = Scorer(shared.value.get("formats", {}), shared.value.get("background"))
        for b in batches:
            base: list = [[] for _ in range(b.num_rows)]
            both: list = [[] for _ in range(b.num_rows)]
            for k, _, own, spans in _scan(b.column(1), scorer):
                base[k], both[k] = listed(own), listed(spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, span), pa.array(both, span)],
                                             ["id", "base", "spans"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, f"id {id_type}, base {SPAN}, spans {SPAN}")


def span_text(spans: Column) -> Column:
    """kind:start:end of a span column, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])), ",")


def mask_secrets(docs: DataFrame, model: dict, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``find_secrets`` replaced by ``mask`` (overlapping spans by one)."""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        scorer = Scorer(shared.value.get("formats", {}), shared.value.get("background"))
        for b in batches:
            column = b.column(at)
            pieces, done_rows = [], 0
            for k, text, _, spans in _scan(column, scorer):
                parts, done = [], 0
                for s, _, e in spans:
                    if s >= done:
                        parts += [text[done:s], mask]
                    done = max(done, e)
                if parts:
                    pieces += [column.slice(done_rows, k - done_rows), pa.array(["".join([*parts, text[done:]])], column.type)]
                    done_rows = k + 1
            if pieces:
                arrays = list(b.columns)
                arrays[at] = pa.concat_arrays([*pieces, column.slice(done_rows)])
                b = pa.RecordBatch.from_arrays(arrays, b.schema.names)
            yield b

    return docs.mapInArrow(run, docs.schema)
