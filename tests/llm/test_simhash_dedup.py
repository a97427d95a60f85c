import numpy as np
import xxhash
from pyspark.sql import functions as F

from cases import AWKWARD, WORDS, empty, make, with_repeats
from gildhall.llm import _util
from gildhall.llm import simhash_dedup as S
from gildhall.llm.components import components
from gildhall.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    w = WORDS.findall(lower(text))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, prints):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    x = np.array(prints, dtype=np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x) <= 3):
            a, b = find(i), find(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(x)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: least[find(i)] for i in range(len(x))}


def test_query_against_all_pairs(spark):
    docs = _util.documents(spark, SF).select("doc_id", "text").collect()
    got = QUERIES["op7_simhash_dedup"](spark, SF).collect()
    prints = {d["doc_id"]: fingerprint(d["text"]) for d in docs}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == groups(list(prints), list(prints.values()))


def test_awkward_rows(spark):
    got = S.near_duplicates(with_repeats(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD) + 3
    prints = {i: fingerprint(t) for i, t in enumerate(AWKWARD, 1)}
    expected = groups(list(prints), list(prints.values()))
    for r in got:
        if r["doc_id"]:
            assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == expected[r["doc_id"]]
    assert sorted(r["component_id"] for r in got if r["doc_id"] is None) == sorted([expected[5], expected[8]])
    assert S.near_duplicates(empty(spark)).collect() == []
    lone = make(spark, ["a b c"]).selectExpr("cast(null as long) doc_id", "text")
    assert [r["component_id"] for r in S.near_duplicates(lone).collect()] == [None]


def test_trie_join_with_opened_nodes(spark):
    rng = np.random.default_rng(1)
    values = set()
    for base in rng.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(30):
            v = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 5)):
                v ^= 1 << int(k)
            values.add(v)
    values = sorted(values)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)], "fp long, rep long")
    expected = groups(list(range(len(values))), values)
    for node_rows in (1 << 16, 2):
        got = {r["v"]: r["m"] for r in components(S.links(table, node_rows=node_rows)).collect()}
        assert {i: got.get(i, i) for i in range(len(values))} == expected


def test_fingerprints_that_share_bits_below_their_block(spark):
    """A node whose rows share 14 further bits is opened until its children are small, in one step of counting."""
    rng = np.random.default_rng(2)
    head = 0x5A5A3FFC << 32
    values = sorted({head | int(v) for v in rng.integers(0, 1 << 34, 3000, dtype=np.uint64)}
                    | {head | 1 << k for k in range(30)} | {int(v) for v in rng.integers(0, 2**63, 500, dtype=np.uint64)})
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)], "fp long, rep long")
    node_rows = 700
    keyed = S.trie_nodes(table, node_rows=node_rows)
    sizes = {r["key"]: r["n"] for r in keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert max(sizes.values()) <= 2 * node_rows  # a pair of two children at most
    assert {r["depth"] for r in keyed.select("depth").distinct().collect()} > {0}
    got = {r["v"]: r["m"] for r in components(S.links(table, node_rows=node_rows)).collect()}
    assert {i: got.get(i, i) for i in range(len(values))} == groups(list(range(len(values))), values)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 159)]
    got = {r["v"]: r["m"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {200: 100}
