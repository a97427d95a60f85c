"""The conversation trie against a plain one, on odd tables and through the query."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gildhall.llm.prefix_trie import prefix_trie, turn_sequences
from gildhall.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, name string, words string, depth int, ends string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_name(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    """Turns of each conversation, as lists of (role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), turn_name(role, text), (role, text)))
    return {c: [t for *_, t in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    rows = []
    for p, of in members.items():
        under = [q for q in members if q[:len(p)] == p]
        kids = [q for q in under if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in members) for q in under)
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in under if q)
        last = ",".join(str(c) for c in of if len(convs[c]) == len(p))
        rows.append((of[0], len(p), members[p[:-1]][0] if p else None, len(of), len(kids), leaves, saved, hashlib.sha256(last.encode()).hexdigest()))
    return sorted(rows, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x") for r in rows], SCHEMA)


CASES = {
    "empty": [],
    "one": [(3, 0, "user", "a b")],
    "nulls": [(1, None, None, None), (1, 1, "user", None), (2, None, None, ""), (2, 1, None, "x"), (None, 0, "user", "gone"), (5, 2, "", " \t ")],
    "ties": [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "bot", "a"), (2, 0, "bot", "a"), (2, 0, "user", "a"), (2, 0, "user", "a")],
    "length in a name": [(1, 0, "ab", "c"), (2, 0, "a", "bc")],
    "copies": [(c, t, "user", f"turn {t if c < 30 else t % 3} of many") for c in range(40) for t in range(5)],
    "branches": [(c, t, "user" if t % 2 else "bot", f"w{(c >> t) % 3} " * (t + 1)) for c in range(60) for t in range(c % 9)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_plain_trie(spark, case):
    rows = CASES[case]
    assert collected(prefix_trie(turn_sequences(table(spark, rows)))) == plain_trie(ordered(rows))


def test_long_conversation_and_long_text(spark):
    rows = [(1, t, "user", f"t{t % 5}") for t in range(70)] + [(2, t, "user", f"t{t % 5}") for t in range(41)] + [(3, 0, "user", "word " * 40_000)]
    assert collected(prefix_trie(turn_sequences(table(spark, rows)))) == plain_trie(ordered(rows))


@pytest.mark.parametrize("rows", [
    [(c, t, "user", f"c{c % 7} t{t}") for c in range(100) if c != 40 for t in range(c % 6 + 1)],  # an absent base, short ones
    [(c, 0, None, None) for c in range(45)],
    [],
])
def test_query_on_rebuilt_conversations(spark, tmp_path, rows):
    table(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op11_prefix_trie"](spark, str(tmp_path))
    assert collected(got) == plain_trie(rebuilt(ordered(rows)))


def test_one_prefix_of_a_third_of_all_is_spread(spark):
    """Rows under one hot prefix are joined in parts: no part holds them all."""
    rows = [(c, t, "user", "system" if t == 0 and c % 3 == 0 else f"{c} {t}") for c in range(300) for t in range(4)]
    got = prefix_trie(turn_sequences(table(spark, rows)))
    top = got.where("depth = 1 AND n_convs > 1").collect()
    assert [(r.conv_id, r.n_convs, r.n_leaves) for r in top] == [(0, 100, 100)]
    assert got.where("depth = 0").select("n_leaves").first()[0] == 300
    assert got.agg(F.count("*")).first()[0] == 1 + 1 + 200 + 300 * 3
