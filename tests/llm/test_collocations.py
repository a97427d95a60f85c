"""Phrase mining against plain counts, its summaries' guarantee, and the query on awkward tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import AWKWARD, empty, make, with_repeats
from pyspark.sql import functions as F

from gildhall.llm import collocations as C
from gildhall.llm.queries import QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(docs, threshold=100, top=2000):
    """docs: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    candidates = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= threshold}
    covered = {}
    for (lang, p), v in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                covered[lang, p[i:i + size]] = max(covered.get((lang, p[i:i + size]), 0), v)
    rows = []
    for (lang, p), a in candidates.items():
        if 100 * covered.get((lang, p), 0) >= 100 * a:
            continue
        score, _, lf, rf = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        rows.append((lang, " ".join(p), a, lf, rf, n[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i, *r[1:]) for i, r in enumerate(mine[:top], 1)]
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def random_docs(seed, n=400):
    rng = random.Random(seed)
    words = ["a", "b", "New", "york", "c\x00d", "état", "日本", "x" * 30, "the", "of"]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(30)):
            parts.append(rng.choice(["new york city hall", "of the", "a a a", rng.choice(words), "b\tc", "one  two   three four five six"]))
            parts.append(rng.choice([" ", "  ", ", ", "\n", "\t", ". ", "\x0b", "-", " "]))
        docs.append(("".join(parts), rng.choice(["en", "de", None, ""])))
    return docs


@pytest.mark.parametrize("seed", range(2))
def test_plain_counts(spark, seed):
    docs = random_docs(seed)
    df = spark.createDataFrame(docs, "text string, lang string")
    want = plain(docs)
    assert len(want) > 20
    assert collected(C.collocations(df)) == want
    assert collected(C.collocations(df, threshold=7, top=30)) == plain(docs, 7, 30)


def test_small_blocks_flushes_and_tables(spark, monkeypatch):
    """The same counts where texts are cut often, tallies are sent early and the bit table is too small."""
    docs = random_docs(5)
    df = spark.createDataFrame(docs, "text string, lang string")

    def phrases(d):
        return sorted(tuple(r) for r in C.frequent_phrases(d).collect())
    want = phrases(df)
    for name, value in (("GROUP_BYTES", 50), ("FLUSH", 1000), ("HELD", 20), ("MAX_BITS", 16)):
        monkeypatch.setattr(C, name, value)
    got = []
    table, _ = C.survivors(C.by_language(df, "text", "lang"), 6, 16)
    marks = np.unpackbits(table, bitorder="little")
    for text, lang in docs:  # every frequent phrase has its bit
        data = text.encode().translate(C.FOLD)
        p = C.Phrases(data, np.array([0]), np.array([len(data)]), ["und" if lang is None else lang])
        for n, first, h in p.hashes():
            got += [(p.langs[0], n, p.phrase(i, n).decode(), int(c)) for i, c in zip(first.tolist(), marks[h >> np.uint64(48)], strict=True)]
    passed = {g[:3] for g in got if g[3]}
    assert {w[:3] for w in want if w[1]} <= passed
    assert phrases(df) == want  # blocks within tasks still count each phrase once


def test_blocks_repeat_only_words_ahead():
    text = b" ".join(b"w%d" % (i % 7) for i in range(500)) + b"\nend of it"
    whole = C.Phrases(text, np.array([0]), np.array([len(text)]), ["x"])
    old, C.GROUP_BYTES = C.GROUP_BYTES, 64
    try:
        parts = [C.Phrases(b, np.array([0]), np.array([own]), ["x"]) for b, own in C.text_blocks(text)]
    finally:
        C.GROUP_BYTES = old
    assert len(parts) > 10

    def counted(ps):
        return Counter(p.phrase(i, n) for p in ps for n, first, _ in p.hashes() for i in first.tolist())
    assert counted(parts) == counted([whole])


def test_summary_keeps_every_frequent_key():
    rng = np.random.default_rng(3)
    stream = np.concatenate([rng.integers(0, 1 << 32, 60_000), np.repeat(rng.integers(0, 1 << 32, 200), 101)]).astype(np.uint32)
    rng.shuffle(stream)
    s = C.Summary(len(stream), 100)
    assert s.capacity > len(stream) / 100
    for part in np.array_split(stream, 50):
        s.add(*np.unique(part, return_counts=True))
        s.merge()
        assert len(s.keys) <= s.capacity
    keys, counts = np.unique(stream, return_counts=True)
    assert 0 < s.taken < 100
    assert set(keys[counts >= 100]) <= set(s.survivors())
    exact = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert all(c <= exact[k] <= c + s.taken for k, c in zip(s.keys.tolist(), s.counts.tolist(), strict=True))


def test_query_on_awkward_documents(spark, tmp_path):
    texts = [t for t in AWKWARD if len(t or "") < 10_000] + ["Same words here. " * 120, "b c d e f g " * 150, "long " * 40_000]
    docs = with_repeats(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = plain([(r.text, r.lang) for r in docs.select("text", "lang").collect()])
    assert {w[0] for w in want} == {"en", "und"}
    assert collected(QUERIES["op13_collocations"](spark, str(tmp_path))) == want


def test_empty_table(spark):
    assert C.collocations(empty(spark)).count() == 0
    assert C.collocations(make(spark, [None, ""])).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 1 << 40
    rows = [("en", 0, "", 50 * big), ("en", 1, "x", 7 * big), ("en", 1, "y", 3 * big), ("en", 2, "x y", 2 * big + 1)]
    monkeypatch.setattr(C, "frequent_phrases", lambda docs, *a: docs)
    r = C.collocations(spark.createDataFrame(rows, "lang string, n int, phrase string, f long")).first()
    assert r.score == 1000 * (2 * big + 1) * 50 * big // (7 * big * 3 * big)
