import hashlib
import re

from pyspark.sql import functions as F

from cases import AWKWARD, empty, with_repeats
from gildhall.llm import exact_dedup as E


def plain(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            keep = None if best[1] else best[2]
            out.append((None if m[1] else m[2], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = E.exact_duplicates(docs).collect()
    expected, groups = plain(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == expected
    assert sum(r["kept"] for r in got) == groups


def test_awkward_rows(spark):
    check(with_repeats(spark, [*AWKWARD, "l" * 9000, "l" * 9000 + " ", "l" * 9001]))


def test_empty_table(spark):
    assert E.exact_duplicates(empty(spark)).collect() == []


def test_colliding_identifiers_are_salted_anew(spark, monkeypatch):
    real, seen = E.chunk_id, []

    def weak(chunk, salt):
        seen.append(salt)
        if salt == 0:
            return F.struct(F.length(chunk).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
        return real(chunk, salt)

    monkeypatch.setattr(E, "chunk_id", weak)
    check(with_repeats(spark, ["abc", "abd", "abc ", "x y", "q", "r"] + [None] * 3))
    assert set(seen) == {0, 1}


def test_no_python_in_the_plan(spark, capsys):
    E.exact_duplicates(with_repeats(spark, ["abc"] * 9)).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
