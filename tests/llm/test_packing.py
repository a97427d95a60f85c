import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import AWKWARD, empty, with_repeats
from gildhall.llm import _util, packing as P
from gildhall.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check_layout(rows):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def check_pieces(rows, texts, tokenizer):
    """Every text's ids come back whole, in pieces that only the first may be short."""
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == doc)
        assert [p[0] for p in mine] == list(range(len(mine)))
        at = 0
        for _, start, length, crc in mine:
            assert start == at and crc == zlib.crc32(ids[at:at + length].tobytes())
            at += length
        assert at == len(ids)
        assert len(mine) == -(-len(ids) // 1024) and all(p[2] == 1024 for p in mine[1:])


def test_query(spark, tokenizer):
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    texts = [(r["doc_id"], r["text"]) for r in _util.documents(spark, SF).collect()]
    check_pieces(rows, texts, tokenizer)
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert least <= check_layout(rows) <= least * 1.02 + 1


ADDED = ["<|endoftext|>", "a <|endoftext|> b", " <|endoftext|>\n<|endoftext|>  c", "<|endoftext|<|endoftext|>|>", "x<|endoftext|>y " * 900]


def test_added_tokens_and_runs_as_the_library(tokenizer):
    """Added tokens beside all kinds of white space, and random mixtures of letters, marks and line feeds."""
    cache = P.tokenizer_cache(PATH)
    rng = np.random.default_rng(4)
    alphabet = [*"aZé,.'#$\n 1ß_-\t日", "<|endoftext|>", "\n\n", " the", "don't"]
    texts = [*ADDED, *("".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(5000))]
    for turn in range(2):  # the second time from the cache
        assert cache.joined(texts) == cache.encode(texts)
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids.count(50256) == 1


def test_workers_drop_caches_of_other_operators():
    _util._begin("one")
    cache = P.tokenizer_cache(PATH)
    _util._begin("one")
    assert P.tokenizer_cache(PATH) is cache
    _util._begin("two")
    assert P._caches == {}


def test_awkward_rows_in_many_groups(spark, tokenizer):
    docs = with_repeats(spark, [*AWKWARD, "<|endoftext|> is an id", "word " * 700, *ADDED])
    rows = P.pack_documents(docs, PATH, group_pieces=3).collect()
    check_layout(rows)
    single = [r for r in rows if r["doc_id"] not in (7, None)]
    check_pieces(single, [(i, t) for i, t in enumerate([*AWKWARD, "<|endoftext|> is an id", "word " * 700, *ADDED], 1) if i != 7], tokenizer)
    assert sum(r["doc_id"] == 7 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 2
    assert P.pack_documents(empty(spark), PATH).collect() == []


def test_bounds_and_best_fit():
    rng = np.random.default_rng(0)
    for high in (30, 300, 1023):
        sizes = rng.integers(1, high + 1, 400)
        bins, offsets, left = P.best_fit_decreasing(sizes)
        fill = np.bincount(bins, sizes)
        assert (fill + left == 1024).all() and len(left) >= P.lower_bound(sizes) >= -(-int(sizes.sum()) // 1024)
    assert P.lower_bound(np.array([513] * 9)) == 9
    assert P.lower_bound(np.array([342] * 9)) == 5  # two to a bin, by the rounding family
    assert P.lower_bound(np.array([], dtype=int)) == 0


def test_exchange_saves_bins(spark):
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in rng.integers(200, 700, 400)]
    lengths = spark.createDataFrame(list(enumerate(sizes)), "pid long, length long")
    alone = sum(len(P.best_fit_decreasing(np.array(sizes[i:i + 8]))[2]) for i in range(0, 400, 8))
    placed = P.pack(lengths, group_pieces=8).collect()
    assert sorted(r["pid"] for r in placed) == list(range(400))
    used = len({(r["grp"], r["bin"]) for r in placed})
    assert P.lower_bound(np.array(sizes)) <= used < alone
    fill = {}
    for r in placed:
        fill.setdefault((r["grp"], r["bin"]), []).append((r["offset"], sizes[r["pid"]]))
    for parts in fill.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 1024
