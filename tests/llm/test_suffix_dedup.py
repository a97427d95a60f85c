import hashlib
from collections import Counter

import numpy as np

from cases import AWKWARD, empty, make, with_repeats
from gildhall.llm import suffix_dedup as S


def plain(rows, m):
    data = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[s:s + m] for _, b in data for s in range(len(b) - m + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), dtype=bool)
        for s in range(len(b) - m + 1):
            if count[b[s:s + m]] > 1:
                gone[s:s + m] = True
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        spans = int(np.diff(np.r_[0, gone.astype(int)]).clip(0).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def texts(n=40):
    rng = np.random.default_rng(4)
    passages = ["".join(rng.choice(list("abé"), 30)) for _ in range(4)]
    out = ["".join(["".join(rng.choice(list("abcd "), rng.integers(0, 25))), passages[rng.integers(4)][rng.integers(4):],
                    "".join(rng.choice(list("abcd "), rng.integers(0, 25))), passages[rng.integers(4)][:rng.integers(30)]]) for _ in range(n)]
    return [*out, "a" * 70, "ab" * 40, "aab" * 20, out[0], out[1] + "x", ""]


def test_random_texts_against_all_strings(spark):
    docs, m = make(spark, texts()), 16
    expected = plain(list(enumerate(texts(), 1)), m)
    assert result(S.remove_repeats(docs, length=m, anchor=9)) == expected


def test_large_groups_are_settled_window_by_window(spark, monkeypatch):
    docs, m = make(spark, texts()), 16
    real = S.repeated_spans
    monkeypatch.setattr(S, "repeated_spans", lambda d, length, anchor: real(d, length, anchor, group_classes=2))
    assert result(S.remove_repeats(docs, length=m, anchor=9)) == plain(list(enumerate(texts(), 1)), m)


def test_awkward_rows(spark):
    short = [t if t is None or len(t) < 9000 else t[:9000] for t in AWKWARD]
    docs = with_repeats(spark, short)
    got = S.remove_repeats(docs).collect()
    rows = [*enumerate(short, 1), (7, short[6])]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got if r["doc_id"]) == plain(rows, 200)
    assert [r["n_removed"] for r in got if r["doc_id"] is None] == [0, 0]
    assert S.remove_repeats(empty(spark)).collect() == []


def test_merge_of_shards_finds_what_one_sort_finds():
    rng = np.random.default_rng(0)
    for depth in (1, 3, 6):
        contexts = [rng.integers(1, 4, rng.integers(depth, 25)).astype(np.uint16) for _ in range(30)]
        windows = np.array([len(c) - depth + 1 for c in contexts])
        every = [tuple(c[s:s + depth]) for c, w in zip(contexts, windows, strict=True) for s in range(w)]
        count = Counter(every)
        for shards in (1, 2, 5):
            assert S.repeated_starts(contexts, windows, depth, shards).tolist() == [count[e] > 1 for e in every]
