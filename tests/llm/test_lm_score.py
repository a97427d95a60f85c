import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, empty, with_repeats
from gildhall.llm import _util, lm_score as L
from gildhall.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def lower_words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def vocabulary():
    return L.Vocabulary.read(PATH)


def paths(text, ids, v):
    """All ways to write ``text``, as lists of piece ids; a character without a piece is spelt in bytes."""
    out = []
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        marks = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        way = []
        for a, b in itertools.pairwise(marks):
            if text[a:b] in ids:
                way.append(ids[text[a:b]])
            elif b - a == 1:
                way += [int(v.byte_ids[x]) for x in text[a:b].encode()]
            else:
                break
        else:
            out.append(way)
    return out


def test_forward_and_expected_uses_over_all_paths(vocabulary):
    import sentencepiece

    v = vocabulary
    m = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = {m.id_to_piece(i): i for i in v.ids.tolist()}
    words = ["the", "there", "é日", "\U0001f98a", "qqzy", "a", "tion"]
    lattice = L.Lattice([w.encode() for w in words], v)
    count = np.arange(1.0, len(words) + 1)
    whole, uses = lattice.forward(v.logp)[1], lattice.expected(v.logp, count)
    expected = np.zeros_like(uses)
    for w, c, got in zip(words, count, whole, strict=True):
        ways = paths(L.MARK + w, ids, v)
        mass = [math.exp(sum(v.logp[i] for i in way)) for way in ways]
        assert math.isclose(got, math.log(sum(mass)), rel_tol=1e-9)
        for way, x in zip(ways, mass, strict=True):
            for i in way:
                expected[i] += c * x / sum(mass)
    assert np.allclose(uses, expected)


def check_base(rows, texts):
    words = [(d, [*lower_words(t), None]) for d, t in texts]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in texts}
    c = Counter(w for d, ws in words if not held[d] for w in ws)
    n, size = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in rows}
    for d, ws in words:
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(c[w] > 0 for w in ws), n, held[d])
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + size + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in _util.documents(spark, SF).collect()]
    check_base(QUERIES["op6_lm_score"](spark, SF).collect(), texts)


def test_awkward_rows_over_several_dictionaries(spark, monkeypatch, vocabulary):
    texts = [t if t is None or len(t) < 9000 else t[:9000] for t in AWKWARD]
    docs = with_repeats(spark, texts).where("doc_id <> 7")
    held = _util.held_out(F.col("doc_id"), 7, 2)
    rows = L.score_documents(docs, PATH, held).collect()
    check_base(rows, [(i, t) for i, t in enumerate(texts, 1) if i != 7])
    same = {r["doc_id"]: r["score"] for r in rows}
    assert same[1] == same[2] == same[3]
    assert L.score_documents(empty(spark), PATH, held).collect() == []
    nothing = L.score_documents(docs, PATH, F.lit(True)).collect()
    assert all(r["base_score"] == 0 and r["train_tokens"] == r["n_known"] == 0 and np.isfinite(r["score"]) for r in nothing)


def test_rounds_raise_the_likelihood(spark, vocabulary):
    words = [("the", 40), ("then", 9), ("there", 12), ("thering", 3), ("onthe", 2)]
    table = spark.createDataFrame([(bytearray(w.encode()), c) for w, c in words], "word binary, c long")
    lattice, count = L.Lattice([w.encode() for w, _ in words], vocabulary), np.array([c for _, c in words])
    last = -np.inf
    for rounds in range(4):
        logp = L.fit(table, vocabulary, 5, rounds)
        assert math.isclose(np.exp(logp).sum(), 1, rel_tol=1e-9)
        now = lattice.forward(logp)[1] @ count
        assert now > last
        last = now
