"""Licence scan with a positional rare-token index.

Method: the words of all licence templates are indexed with their positions,
and the inverse document frequency of each is counted over the whole corpus.
A file whose words hold enough of a template's idf looks up those of the
template's words that are rarest among the file's own. Each occurrence meets
the postings of its word; occurrences whose distances agree with those of the
template, drifting from one to the next, form a chain, and a chain of enough
rare words is verified: the template's mandatory key phrases must stand there
in order (``KEY_GAP`` words may stand in between), and the score is the
idf-weighted share of the template's words in the best alignment with that
part of the file. Base phrases are mandatory as a whole, so each of their
places is found exactly.

Defined results: A-Z are lower-cased; a null text is empty; a text of any
length is read whole; repeated rows get equal answers; words of equal idf are
ranked by the alphabet, and equal scores give one score; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import release_worker_cache

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# The base phrases and their labels.
BASE = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Passages of public licences, as label -> (passage, mandatory key phrases).
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software", ("permission is hereby granted free of charge", "without restriction")),
    "apache-2": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("apache license", "except in compliance with the license")),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met redistributions of source code must retain the above copyright "
        "notice this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "following conditions are met")),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation", ("gnu general public license", "redistribute it")),
    "gpl-notice": ("this work is licensed under the gnu general public license version",
                   ("licensed under the gnu general public license",)),
    "mpl-2": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at", ("mozilla public license", "subject to the terms")),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee")),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software", ("free and unencumbered software",)),
    "cc-by": ("this work is licensed under a creative commons attribution", ("creative commons attribution",)),
}

# What follows those passages in the whole texts of the public licences.
REST = {
    "mit": (
        "and to permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
        "shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
        "of contract tort or otherwise arising from out of or in connection with the software or the use or other "
        "dealings in the software"),
    "apache-2": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license"),
    "bsd": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution this software "
        "is provided by the copyright holders and contributors as is and any express or implied warranties including but "
        "not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in "
        "no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
        "exemplary or consequential damages including but not limited to procurement of substitute goods or services "
        "loss of use data or profits or business interruption however caused and on any theory of liability whether in "
        "contract strict liability or tort including negligence or otherwise arising in any way out of the use of this "
        "software even if advised of the possibility of such damage"),
    "gpl": (
        "either version 3 of the license or at your option any later version this program is distributed in the hope "
        "that it will be useful but without any warranty without even the implied warranty of merchantability or fitness "
        "for a particular purpose see the gnu general public license for more details you should have received a copy of "
        "the gnu general public license along with this program"),
    "isc": (
        "the software is provided as is and the author disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall the author be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the "
        "use or performance of this software"),
    "unlicense": (
        "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means "
        "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain we make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law the software "
        "is provided as is without warranty of any kind express or implied including but not limited to the warranties "
        "of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable "
        "for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of "
        "or in connection with the software or the use or other dealings in the software"),
}

#: The label that a template stands for where it is not its own name.
LABEL_OF = {"gpl-notice": "gpl"}


@dataclass
class Template:
    label: str
    base: bool
    words: list[bytes]
    keys: list[tuple[int, int]] = field(default_factory=list)  # (first word, end) of mandatory phrases


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def templates() -> list[Template]:
    out = []
    for label, phrase in BASE.items():
        w = phrase.encode().split()
        out.append(Template(label, True, w, [(0, len(w))]))
    whole = [(label, f"{TEMPLATES[label][0]} {rest}", TEMPLATES[label][1]) for label, rest in REST.items()]
    for label, passage, keys in [*((x, *t) for x, t in TEMPLATES.items()), *whole]:
        w = passage.encode().split()
        t = Template(LABEL_OF.get(label, label), False, w)
        for key in keys:
            k = key.encode().split()
            at = next(i for i in range(len(w)) if w[i:i + len(k)] == k)
            t.keys.append((at, at + len(k)))
        out.append(t)
    return out


KEY_GAP = 2  # words that may stand inside a mandatory phrase


def find_phrase(words: list[bytes], phrase: list[bytes], lo: int, hi: int) -> bool:
    """Whether the phrase's words stand in order between ``lo`` and ``hi``, at most ``KEY_GAP`` others among them."""
    for s in range(lo, hi):
        if words[s] == phrase[0]:
            at, k, end = s, 0, min(hi, s + len(phrase) + KEY_GAP)
            while at < end and k < len(phrase):
                k += words[at] == phrase[k]
                at += 1
            if k == len(phrase):
                return True
    return False


class Index:
    """Postings of the words of every template, by corpus idf."""

    def __init__(self, frequency: dict[bytes, int], documents: int, min_share: float = 0.7,
                 rare_words: int = 8, min_votes: int = 3, drift: int = 3):
        self.templates = templates()
        self.min_share, self.rare_words, self.min_votes, self.drift = min_share, rare_words, min_votes, drift
        self.idf = {w: math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1e-6
                    for t in self.templates for w in t.words}
        self.postings: list[dict[bytes, list[int]]] = []
        for tpl in self.templates:
            own: dict[bytes, list[int]] = defaultdict(list)
            for p, w in enumerate(tpl.words):
                own[w].append(p)
            # rarest first: a file takes those that it holds, in this order
            self.postings.append({w: own[w] for w in sorted(own, key=lambda w: (-self.idf[w], w))})
        self.whole = [sum(self.idf[w] for w in t.words) for t in self.templates]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], set[str], float]:
        """Base places (start, label), labels of the other templates, and the best score."""
        held = self.idf.keys() & set(words)
        base, extra, score = [], set(), 0.0
        if not held:
            return base, extra, score
        places: dict[bytes, list[int]] = defaultdict(list)
        for at, w in enumerate(words):
            if w in held:
                places[w].append(at)
        for t, tpl in enumerate(self.templates):
            postings = self.postings[t]
            if tpl.base:
                if all(w in held for w in postings):
                    w, own = next(iter(postings.items()))
                    starts = dict.fromkeys(at - p for at in places[w] for p in own)
                    found = [s for s in starts if s >= 0 and words[s:s + len(tpl.words)] == tpl.words]
                    base += [(s, tpl.label) for s in found]
                    score = 1.0 if found else score
                continue
            # no place of the file can hold more of the template than the file does
            if sum(self.idf[w] * len(p) for w, p in postings.items() if w in held) < self.min_share * self.whole[t]:
                continue
            rare = [w for w in postings if w in held][:self.rare_words]
            for lo, hi in self._chains(len(tpl.words), sorted((at, p) for w in rare for at in places[w] for p in postings[w]),
                                       min(self.min_votes, len(rare)), len(words)):
                share = self._verify(t, words, lo, hi)
                if share >= self.min_share:
                    extra.add(tpl.label)
                    score = max(score, share)
        return sorted(base), extra, score

    def _chains(self, size: int, anchors: list[tuple[int, int]], votes: int, n: int) -> Iterator[tuple[int, int]]:
        """Parts of the file round chains of agreeing anchors (place in the file, place in the template)."""
        length, first = [1] * len(anchors), list(range(len(anchors)))
        oldest, parts = 0, []
        for k, (at, p) in enumerate(anchors):
            while at - anchors[oldest][0] > 2 * size:
                oldest += 1
            for j in range(oldest, k):
                gap, step = at - anchors[j][0], p - anchors[j][1]
                if gap > 0 and step > 0 and abs(gap - step) <= self.drift + step // 3 and length[j] >= length[k]:
                    length[k], first[k] = length[j] + 1, first[j]
            if length[k] >= votes:
                at0, p0 = anchors[first[k]]
                rest = size - 1 - p
                parts.append((max(0, at0 - p0 - p0 // 3 - 2 * self.drift), min(n, at + rest + rest // 3 + 2 * self.drift + 1)))
        lo = hi = None
        for a, b in sorted(parts):  # overlapping parts are one
            if hi is not None and a <= hi:
                hi = max(hi, b)
                continue
            if hi is not None:
                yield lo, hi
            lo, hi = a, b
        if hi is not None:
            yield lo, hi

    def _verify(self, t: int, words: list[bytes], lo: int, hi: int) -> float:
        """Idf share of the template's words in the best alignment with words ``lo`` to ``hi``; 0 without a key phrase."""
        tpl, postings = self.templates[t], self.postings[t]
        if not all(find_phrase(words, tpl.words[a:b], lo, hi) for a, b in tpl.keys):
            return 0.0
        # heaviest increasing run of template places; best[p] is the heaviest that ends before or at place p
        best = [0.0] * (len(tpl.words) + 1)
        for w in words[lo:hi]:
            for p in reversed(postings.get(w, ())):  # a word of the file stands for one place only
                gain = best[p] + self.idf[w]
                q = p + 1
                while q < len(best) and best[q] < gain:
                    best[q] = gain
                    q += 1
        return min(1.0, best[-1] / self.whole[t])


def _vocabulary() -> list[bytes]:
    return sorted({w for t in templates() for w in t.words})


def word_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """Documents of the corpus that hold each licence word, and their number.

    The driver gets one row per licence word; a task sends at most as many.
    """
    vocabulary = set(_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[bytes, int] = defaultdict(int)
        n = 0
        for b in batches:
            n += b.num_rows
            for text in b.column(0).cast(pa.binary()):
                for w in vocabulary.intersection(words_of(text.as_py() or b"")):
                    count[w] += 1
        names = [w.decode() for w in count]
        yield pa.RecordBatch.from_arrays([pa.array([*names, None], pa.string()),
                                          pa.array([*count.values(), n], pa.int64())], ["word", "n"])

    rows = (docs.select(F.col(text_col).alias("t")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    return ({r.word.encode(): r.n for r in rows if r.word is not None},
            next((r.n for r in rows if r.word is None), 0))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    frequency, n = word_frequencies(docs, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        index = Index(frequency, n)
        for b in batches:
            rows = []
            for text in b.column(1).cast(pa.binary()):
                words = words_of(text.as_py() or b"")
                base, extra, score = index.scan(words)
                own = {label for _, label in base}
                rows.append((len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                             ",".join(sorted(own)), ",".join(sorted(own | extra)), score))
            cols = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, f"id {id_type}, n_words long, n_base long, first_word long, last_word long,"
                             " base_labels string, labels string, score double")
