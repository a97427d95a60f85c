import zlib

import numpy as np
from pyspark.sql import functions as F

from cases import AWKWARD, empty, with_repeats
from gildhall.llm import _util, lang_id
from gildhall.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_lang_id"](spark, SF).collect()}
    docs = _util.documents(spark, SF).select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        assert 0 <= got[d["doc_id"]]["score"] <= 1
    held = [(d["lang"], got[d["doc_id"]]["lang_pred"]) for d in docs if got[d["doc_id"]]["held_out"] and d["lang"]]
    assert np.mean([a == b for a, b in held]) > 0.98


def test_awkward_rows_and_nothing_learned(spark):
    docs = with_repeats(spark, AWKWARD)
    model = lang_id.fit(docs, F.lit(True))
    got = lang_id.predict(docs, model).collect()
    assert len(got) == docs.count()
    for r, text in ((r, AWKWARD[r["doc_id"] - 1]) for r in got if r["doc_id"]):
        letters = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"], r["score"] > 0) == (("en", True) if letters else ("und", False))
    none = lang_id.fit(docs, F.lit(False))
    assert {r["lang_pred"] for r in lang_id.predict(docs, none).collect()} == {"und"}
    assert lang_id.predict(empty(spark), lang_id.fit(empty(spark), F.lit(True))).collect() == []


def test_kernel_counts_shared_ngrams():
    texts = [b"abcd", b"abce", b"ABcd 12"]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    m = lang_id.presence(data, np.r_[0, np.cumsum([len(t) for t in texts])])

    def grams(t):
        t = bytes(lang_id.BYTE_CLASS[np.frombuffer(t, dtype=np.uint8)])
        return {t[i:i + n] for n in lang_id.ORDERS for i in range(len(t) - n + 1)}

    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert m[i] @ m[j] == len(grams(a) & grams(b))


def test_long_text_in_strides(monkeypatch):
    data = np.frombuffer(b"the quick brown fox jumps" * 40, dtype=np.uint8)
    whole = lang_id.presence(data, np.array([0, 600, len(data)]))
    monkeypatch.setattr(lang_id, "STRIDE", 64)
    assert (lang_id.presence(data, np.array([0, 600, len(data)])) == whole).all()


def test_accepted_rejects_noise_of_letters_only(spark):
    rng = np.random.default_rng(0)
    letters = np.array([*"abcdefghijklmnopqrstuvwxyz"])

    def noise(words):
        return " ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(words))
    docs = _util.documents(spark, SF)
    model = lang_id.fit(docs, ~_util.held_out(F.col("doc_id"), 4, 2))
    assert -1 < model.floor < 0
    rows = [noise(n) for n in (300, 1000, 3000)] + [noise(5), "ok", None, "", "12 !"]
    more = spark.createDataFrame(list(enumerate(rows, 1_000_000)), "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    kept = {r["doc_id"] for r in lang_id.accepted(docs.unionByName(more), model).collect()}
    clean = {r["doc_id"] for r in docs.where(r"text RLIKE '\\p{L}'").collect()}
    assert kept == clean | {1_000_003, 1_000_004}
    assert lang_id.accepted(empty(spark), model).collect() == []


def test_very_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "SAMPLE_ROWS", 60)
    docs = spark.range(900).selectExpr("id AS doc_id", "concat('wort', id % 30, ' x', id % 30) AS text", "concat('l', id % 30) AS lang")
    model = lang_id.fit(docs, F.lit(True))
    assert len(model.langs) == 30
