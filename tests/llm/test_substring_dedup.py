import hashlib

import numpy as np

from cases import AWKWARD, WORDS, empty, make, with_repeats
from gildhall.llm import substring_dedup as S


def plain(rows, m):
    words = [(d, WORDS.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for s in range(len(w) - m + 1):
            k = tuple(w[s:s + m])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - m + 1):
            if first[tuple(w[s:s + m])] < d:
                gone[s:s + m] = [True] * m
        kept = " ".join(a for a, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(spark, texts, m, k):
    got = S.remove_earlier(make(spark, texts), window=m, anchor=k).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == plain(list(enumerate(texts, 1)), m)


def test_random_texts_against_all_windows(spark):
    rng = np.random.default_rng(0)
    passages = [" ".join(rng.choice(list("abcdefgh"), 14)) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [" ".join(rng.choice(list("abcdefghij"), rng.integers(0, 20))) for _ in range(3)]
        texts.append("  ".join([parts[0], passages[rng.integers(4)], parts[1], passages[rng.integers(4)][: rng.integers(28)], parts[2]]))
    texts += ["a " * 40, "a\t" * 25, "a b " * 30, "b a " * 11, texts[3], texts[9] + " z"]
    check(spark, texts, 6, 3)


def test_awkward_rows(spark):
    got = S.remove_earlier(with_repeats(spark, AWKWARD)).collect()
    expected = plain(list(enumerate(AWKWARD, 1)), 50)
    assert len(got) == len(AWKWARD) + 3
    for r in got:
        if r["doc_id"]:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == expected[r["doc_id"]]
        else:
            assert r["n_removed"] == 0
    assert expected[15][1] > 59_000  # the long copy went, but for its own end
    assert S.remove_earlier(empty(spark)).collect() == []


def test_default_windows_with_edits_near_passages(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = list(rng.choice(vocabulary, 120))
    texts = []
    for _ in range(25):
        p = list(passage)
        p[rng.integers(120)] = "edit"
        texts.append(" ".join([*rng.choice(vocabulary, rng.integers(0, 60)), *p, *rng.choice(vocabulary, rng.integers(0, 60))]))
    check(spark, texts, 50, 30)
