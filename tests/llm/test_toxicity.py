import zlib

import numpy as np
from pyspark.sql import functions as F

from cases import AWKWARD, empty, with_repeats
from gildhall.llm import toxicity as T
from gildhall.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    plain = ["".join(rng.choice(list("aeiounrst"), rng.integers(2, 7))) for _ in range(300)]
    texts, y = [], []
    for i in range(n):
        w = list(rng.choice(plain, rng.integers(5, 150)))
        y.append(i % 3 == 0)
        if y[-1]:
            for _ in range(rng.integers(2, 6)):
                w[rng.integers(len(w))] = rng.choice(["Zorg!", "vexx" + "".join(rng.choice(list("abc"), 2))])
        texts.append(" ".join(w))
    return texts, np.array(y, dtype=np.float32)


def test_learns_words_and_spellings():
    texts, y = corpus(450, 0)
    net = T.train([t.lower().encode() for t in texts], y, 0.3)
    other, truth = corpus(150, 1)
    other = [t.replace("vexx", "vexxd") for t in other]  # endings never seen
    assert ((T.scores(net, other) >= 0.3) == (truth == 1)).mean() > 0.9


def test_gradient_is_the_slope():
    texts, y = corpus(12, 2)
    net = T.Network.new(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = T.Words([t.lower().encode() for t in texts] + [b"ab cd"])
    y = np.r_[y, 1]
    of, first, length = T.windows(words.doc, 13)
    weight = np.linspace(1, 2, len(of))

    def loss():
        x = net.inputs(words).astype(np.float64)
        total = 0.0
        gates = {s: x @ net.p["x" + s] + net.p["c" + s] for s in "fb"}
        at = words.word[np.minimum(first[None, :] + np.arange(T.WINDOW)[:, None], len(words.word) - 1)]
        states = np.concatenate([net.run(s, gates[s], at, length) for s in "fb"], axis=2)
        logit = net.pool(states, length)[0]
        p = T.sigmoid(logit)
        total = -(weight * np.where(y[of] == 1, np.log(p), np.log(1 - p))).mean()
        return total

    g = net.gradient(words, first, length, y[of], weight)
    rng = np.random.default_rng(0)
    for name in g:
        flat, slope = net.p[name].reshape(-1), g[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(slope) >= np.quantile(np.abs(slope), 0.5)), 3):
            was = flat[i]
            flat[i] = was + 1e-2
            up = loss()
            flat[i] = was - 1e-2
            down = loss()
            flat[i] = was
            assert abs((up - down) / 2e-2 - slope[i]) < 2e-4 + 0.05 * abs(slope[i]), name


def test_windows_start_at_every_word():
    n = [0, 1, T.WINDOW - 1, T.WINDOW, T.WINDOW + 1, 47, 200]
    doc = np.repeat(np.arange(len(n)), n)
    of, first, length = T.windows(doc, len(n))
    begin = np.cumsum(n) - n
    want = [(d, begin[d] + i, min(k, T.WINDOW)) for d, k in enumerate(n) if k for i in range(max(k - T.WINDOW, 0) + 1)]
    assert list(zip(of.tolist(), first.tolist(), length.tolist(), strict=True)) == want


def test_score_is_that_of_the_highest_window():
    texts, y = corpus(60, 4)
    net = T.train([t.lower().encode() for t in texts], y, 0.3)
    for text, score in zip(texts[:20], T.scores(net, texts[:20]), strict=True):
        w = text.split()
        alone = T.scores(net, [" ".join(w[i:i + T.WINDOW]) for i in range(max(len(w) - T.WINDOW, 0) + 1)])
        assert abs(alone.max() - score) < 1e-5


def test_registered_query(spark):
    rows = QUERIES["op3_toxicity"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert docs[r["doc_id"]] or r["score"] == 0


def test_long_text_in_segments(monkeypatch):
    texts, y = corpus(60, 3)
    net = T.train([t.lower().encode() for t in texts], y, 0.3)
    long = " ".join(t for t, v in zip(texts, y, strict=True) if not v)
    monkeypatch.setattr(T, "GROUP_BYTES", 500)
    assert T.scores(net, [long + " zorg zorg zorg zorg"])[0] > T.scores(net, [long])[0]
    segments = list(T._segments(long.encode()))
    assert len(segments) > 3 and segments[-1].split()[-1] == long.encode().split()[-1]


def test_awkward_rows_and_single_class(spark):
    docs = with_repeats(spark, AWKWARD)
    labels = spark.createDataFrame([(i, i % 2) for i in range(4, 16)] + [(4, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    net = T.fit(docs, labels, F.lit(True))
    assert net.trained
    rows = T.score_documents(docs, net).collect()
    assert len(rows) == len(AWKWARD) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 13))
    one = T.fit(docs, labels.where("toxic = 1"), F.lit(True))
    assert {r["score"] for r in T.score_documents(docs, one).collect()} == {1.0}
    none = T.fit(docs, labels, F.lit(False))
    assert {r["score"] for r in T.score_documents(docs, none).collect()} == {0.0}
    assert T.score_documents(empty(spark), none).collect() == []
