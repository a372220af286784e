import re

import pytest

from plazalens.llm.licenses import BASE, REST, TEMPLATES, Index, scan_licenses, words_of
from plazalens.llm.queries import op3_licenses


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for label, phrase in BASE.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k:k + len(p)] == p]
    return (len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None),
            ",".join(sorted({x for _, x in places})))


TEXTS = ["", None, "Released under the MIT License.", "Apache License, Version 2.0 under-the\n(MIT) license under the mit license",
         "CC BY-NC 4.0 cc by nc", "cc cc by nc by cc by  nc", "mit mit mit license", "UNDER THE Émit license",
         "under the mit licenses", "x" * 100000 + " cc/by/nc", "license " * 30000,
         "Intro words here. " + TEMPLATES["mit"][0].upper() + " and more text",
         "before " + " ".join(w for k, w in enumerate(TEMPLATES["bsd"][0].split()) if k != 27) + " after",
         "the license of the software permission software public license rights",
         "This work is licensed under the GNU General Public License, version 3."]


def key(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)


def test_base_matches_brute_force_and_templates_are_found(spark):
    docs = spark.createDataFrame([(k, t, "clash", 2) for k, t in enumerate(TEXTS)],
                                 "doc_id long, text string, labels string, n_words int")
    rows = {r.id: r for r in scan_licenses(docs).collect()}
    for k, t in enumerate(TEXTS):
        assert key(rows[k]) == brute(t), t
        assert set(filter(None, rows[k].base_labels.split(","))) <= set(rows[k].labels.split(","))
        assert 0 <= rows[k].score <= 1
    assert [rows[k].labels for k in (11, 12, 13, 14)] == ["mit", "bsd", "", "gpl"]


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_key_phrase_is_mandatory():
    index = Index({}, 100)
    words = words_of(TEMPLATES["mpl-2"][0].replace("mozilla", "mosaic").encode())
    assert index.scan(words)[1] == set()


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_matches_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    out = op3_licenses(spark, f"/root/testdata/{sf}").collect()
    assert len(out) == len(docs)
    for r in out:
        assert key(r) == brute(docs[r.doc_id])


def rare_altered(label):
    """The passage without the six of its words that the alphabet puts first, but for those of the key phrases."""
    passage, keys = TEMPLATES[label]
    fixed = {w for k in keys for w in k.split()}
    drop = [w for w in sorted(set(passage.split())) if w not in fixed][:6]
    return " ".join(w if w not in drop else "altered" for w in passage.split())


def prefixed(label):
    words = TEMPLATES[label][0].split()
    return " ".join(f"rem {w}" if k % 9 == 0 else w for k, w in enumerate(words))


def lcs_share(index, tpl, words):
    """Heaviest common subsequence of a template and some words, as a share of the template."""
    row = [0.0] * (len(tpl.words) + 1)
    for w in words:
        new = row[:]
        for p, x in enumerate(tpl.words):
            new[p + 1] = max(new[p], row[p + 1], row[p] + (index.idf[x] if x == w else 0.0))
        row = new
    return row[-1] / sum(index.idf[w] for w in tpl.words)


def brute_extra(index, words):
    """Labels and best share from every window of the file."""
    labels, best = set(), 0.0
    for tpl in index.templates:
        size = len(tpl.words)
        for s in range(0, max(1, len(words) - size // 2)) if not tpl.base else ():
            part = words[s:s + size + size // 3 + 6]
            if all(key_stands(part, tpl.words[a:b]) for a, b in tpl.keys):
                share = lcs_share(index, tpl, part)
                if share >= 0.7:
                    labels.add(tpl.label)
                    best = max(best, share)
    return labels, best


def key_stands(words, phrase):
    import itertools
    n = len(phrase)
    return any(all(words[i] == w for i, w in zip(at, phrase))
               for s in range(len(words)) if words[s] == phrase[0]
               for at in itertools.combinations(range(s, min(len(words), s + n + 2)), n) if at[0] == s)


CASES = {label: [TEMPLATES[label][0], rare_altered(label), prefixed(label)] for label in TEMPLATES}


@pytest.mark.parametrize("label", sorted(set(TEMPLATES) - {"gpl-notice", "cc-by"}))
def test_altered_and_prefixed_passages_are_found(label):
    index = Index({}, 100)
    for text in CASES[label]:
        base, extra, score = index.scan(words_of(f"some words before {text} and after".encode()))
        want, best = brute_extra(index, words_of(f"some words before {text} and after".encode()))
        assert label in extra and extra == want and abs(score - max(best, 1.0 if base else 0.0)) < 1e-9


def test_labels_and_scores_match_brute_force(spark):
    import random
    rng = random.Random(4)
    prose = "the of software a copy and license this is free to any person with public notice file source".split()
    texts = []
    for k in range(24):
        label = rng.choice(sorted(TEMPLATES))
        words = TEMPLATES[label][0].split()
        words = [w for w in words if rng.random() > 0.05 * (k % 9)]
        texts.append(" ".join(rng.choices(prose, k=rng.randrange(0, 25)) + words + rng.choices(prose, k=rng.randrange(0, 25))))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    from plazalens.llm.licenses import word_frequencies
    index = Index(*word_frequencies(docs))
    for r in scan_licenses(docs).collect():
        words = words_of(texts[r.id].encode())
        want, best = brute_extra(index, words)
        own = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == want | own
        assert abs(r.score - (1.0 if own else best)) < 0.02


@pytest.mark.parametrize("label", sorted(REST))
def test_a_whole_text_with_a_changed_beginning_is_found(label):
    passage, keys = TEMPLATES[label]
    fixed = {w for k in keys for w in k.split()}
    begin = " ".join("changed" if k % 2 and w not in fixed else w for k, w in enumerate(passage.split()))
    words = words_of(f"see {begin} {REST[label]} end".encode())
    assert label in Index({}, 100).scan(words)[1] and label in brute_extra(Index({}, 100), words)[0]
