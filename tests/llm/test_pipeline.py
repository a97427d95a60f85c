import re

import corpus_pipeline as C
import pytest

from cases import AWKWARD, make
from test_exact_dedup import plain as exact
from test_simhash_dedup import fingerprint, groups
from test_substring_dedup import plain as windows

from gildhall.llm import _util

SF = "/root/testdata/sf0.001"


def kept(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of every stage."""
    docs, out = _util.documents(spark, SF), []
    extra = docs.limit(40).withColumn("doc_id", docs["doc_id"] + 1000)
    docs = docs.unionByName(extra).unionByName(make(spark, AWKWARD, 2000).select(*docs.columns).drop("n_chars").selectExpr("*", "1L AS n_chars"))
    docs = _util.stage(docs.selectExpr(*[c for c in ("doc_id", "text", "lang", "source", "n_chars")]))
    for name, step in C.STAGES:
        result = _util.stage(step(spark, docs, SF))
        out.append((name, docs, result))
        docs = result
    return out


def test_stages_and_columns(stages):
    assert [s[0] for s in stages] == ["language_id", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    for _, before, after in stages[:-1]:
        assert before.schema.names == after.schema.names
        assert after.count() <= before.count()


def test_language_stage_keeps_what_has_a_language(stages):
    before, after = kept(stages[0][1]), kept(stages[0][2])
    assert after == {k: t for k, t in before.items() if t and any(c.isalpha() for c in t)}


def test_exact_stage_keeps_one_of_each(stages):
    before, after = kept(stages[1][1]), kept(stages[1][2])
    keep = {k for _, k, _, _ in exact(list(before.items()))[0]}
    assert after == {k: before[k] for k in keep}
    texts = [re.sub(r"[\x20\x09-\x0D]", "", t) for t in after.values()]
    assert len(set(texts)) == len(texts)


def test_near_stage_keeps_the_smallest_of_each_group(stages):
    before, after = kept(stages[2][1]), kept(stages[2][2])
    component = groups(list(before), [fingerprint(t) for t in before.values()])
    assert after == {k: t for k, t in before.items() if component[k] == k}


def test_substring_stage_cuts_and_drops(stages):
    before, after = kept(stages[3][1]), kept(stages[3][2])
    expected = windows(list(before.items()), 50)
    assert set(after) == {k for k, (n, gone, _) in expected.items() if gone == 0 or gone < n}
    for k, text in after.items():
        n, gone, _ = expected[k]
        assert (text == before[k]) if not gone else len(text.split()) == n - gone
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3][2].collect())


def test_packing_stage_packs_all(stages):
    rows = stages[4][2].collect()
    assert {r["doc_id"] for r in rows} == set(kept(stages[4][1]))


def test_run_gives_the_last_stage(spark):
    docs = C.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(docs.columns) and docs.count() > 0


def test_empty_documents(spark):
    docs = _util.documents(spark, SF).limit(0)
    for _, step in C.STAGES:
        docs = _util.stage(step(spark, docs, SF))
        assert docs.count() == 0


def test_rows_that_repeat_an_id_keep_their_texts(spark):
    def rows(*texts):
        return _util.stage(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long"))

    def texts(df):
        return sorted((r["doc_id"], r["text"]) for r in df.collect())

    # of id 5, one text loses to id 9's longer copy, and two others stay
    docs = rows((5, "alpha beta"), (5, "gamma delta"), (5, "epsilon"), (9, "alpha  beta"), (9, "zeta"), (9, "ze ta"), (9, "z eta"), (5, "gammadelta"), (5, "epsilon"))
    assert texts(C.exact_dedup(spark, docs, SF)) == [(5, "epsilon"), (5, "gamma delta"), (9, "alpha  beta"), (9, "z eta")]

    a, b, c = (" ".join(f"{w}{i}" for i in range(120)) for w in "abc")
    near = texts(C.near_dedup(spark, rows((3, a), (4, b), (4, a + " a0"), (4, c)), SF))
    expected = groups([1, 2, 3, 4], [fingerprint(t) for t in (a, b, a + " a0", c)])
    assert near == sorted([p for k, p in zip((1, 2, 3, 4), [(3, a), (4, b), (4, a + " a0"), (4, c)], strict=True) if expected[k] == k])
    assert expected[3] == 1 and len(near) == 3

    whole = C.substring_dedup(spark, rows((3, a), (4, b + " " + a), (4, c), (4, b)), SF).collect()
    assert len(whole) == 3 and {r["doc_id"] for r in whole} == {3, 4}
    assert sorted(set(" ".join(r["text"] for r in whole).split())) == sorted((a + " " + b + " " + c).split())
    assert sum(len(r["text"].split()) for r in whole) == 360 and all(r["n_chars"] == len(r["text"]) for r in whole)
