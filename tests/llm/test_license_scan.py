"""License scanning against plain edit distances over all word spans, and through the query."""

import random
import re

import pytest
from cases import AWKWARD, by_id, empty, make, with_repeats

from gildhall.llm.license_scan import BASE, NOTICES, Notice, digest, scan, words_of
from gildhall.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def distance(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def plain(text, notices=NOTICES):
    """What the contract's columns must be: all exact places, and a label wherever some span is near enough."""
    words = plain_words(text)
    places = [(i, n.label) for n in BASE for i in range(len(words)) if words[i:i + n.phrase.count(" ") + 1] == n.phrase.split()]
    best, labels = 0.0, set()
    for n in notices:
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                span = " ".join(words[i:j])
                if len(span) > len(n.phrase) + n.edits:
                    break
                if len(span) >= len(n.phrase) - n.edits:
                    d = distance(span, n.phrase, n.edits)
                    if d <= n.edits:
                        labels.add(n.label)
                        best = max(best, 1 - d / len(n.phrase))
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(labels)), round(best, 9))


def row(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))


def edited(rng, phrase, n):
    chars = list(phrase)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcxyz ")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcxyz "))
    return "".join(chars)


def noisy(seed):
    rng = random.Random(seed)
    stray = ["license", "the", "public", "Apache", "cc", "by", "MIT", "gnu", "general", "é日", "free", "of", "software", "copy", "x"]
    parts = []
    for _ in range(rng.randrange(6)):
        parts.append(" ".join(rng.choice(stray) for _ in range(rng.randrange(6))))
        n = rng.choice(NOTICES)
        parts.append(edited(rng, n.phrase, rng.randrange(n.edits + 2)))
    return rng.choice([" ", "\n", ", ", "--"]).join(parts)


TEXTS = ["GNU General-Public\tLicense, the mit licence!", "cc by cc by\ncc  by", "cc byte", "ccby", "gnu general public licenses", "Apache Lisense 2.0",
         "xapache license", "mit license mit license", "licensed under the apache license version 2 0", "release under teh MIT license",
         "mit\x00license", "mit license", "MİT LICENSE", "gnugeneralpubliclicense", "license " * 50]


def test_all_spans(spark):
    texts = TEXTS + [noisy(s) for s in range(120)]
    got = by_id(digest(scan(make(spark, texts))))
    for i, t in enumerate(texts, 1):
        assert row(got[i]) == plain(t), t


def test_query_on_awkward_documents(spark, tmp_path):
    texts = [t for t in AWKWARD if len(t or "") < 10_000] + TEXTS
    long = "word " * 30_000 + "Released under the MIT Lisense. " + "word " * 30_000 + "apache license"
    docs = with_repeats(spark, [*texts, long])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op12_license_scan"](spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() and sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 7 for r in rows) == 2
    got = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts, 1):
        assert row(got[i]) == plain(t)
    last = got[len(texts) + 1]
    assert (last.n_words, last.n_base, last.first_word, last.base_labels, last.labels) == (60_007, 1, 60_005, "apache", "apache,mit")


def test_spans_and_empty_table(spark):
    got = scan(make(spark, ["one two Apache Lisense three", "apache license apache license"])).orderBy("doc_id").collect()
    assert [(p.label, p.first_word, p.n_words, p.edits, p.text) for p in got[0].places] == [("apache", 2, 2, 1, "apache lisense")]
    assert [(p.first_word, p.edits) for p in got[1].places] == [(0, 0), (2, 0)]
    assert digest(scan(empty(spark))).count() == 0
    assert digest(scan(make(spark, ["apache license"]), notices=())).first().labels == ""


def test_notices_are_words():
    assert all(words_of(n.phrase) == n.phrase for n in NOTICES)
    with pytest.raises(ValueError):
        scan(None, [Notice("x", "Not Folded")])
