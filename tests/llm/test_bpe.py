import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from cases import AWKWARD, empty, with_repeats
from gildhall.llm import _util, bpe as B
from gildhall.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"
ODD = ["a  b\n\n c", "  lead", " lead", "trail  ", "x \n y", " \x1c b", "日本語 テキスト。", "emoji 👍🏽 test's they'll  don't", "a" * 700, "ab" * 900, " " * 50,
       "\t\t a\r\n b", "1234567 12 3", "__foo__  !!??", "", "foo \nbar foo\n foo", "foo foo\n bar", "foo, bar.foo,"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = B.read_ranks(f)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return B.codec(PATH, public_tokenizers.PATTERN)


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_query_against_the_library(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op1_byte_bpe"](spark, SF).collect()}
    docs = _util.documents(spark, SF).collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_awkward_rows(spark, library):
    texts = [*AWKWARD, *ODD]
    rows = B.encode_documents(with_repeats(spark, texts), PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r["doc_id"]:
            text = texts[r["doc_id"] - 1] or ""
            assert r["ids"] == library.encode_ordinary(text) and r["decoded"] == text
    assert B.encode_documents(empty(spark), PATH, public_tokenizers.PATTERN).collect() == []


def test_random_spacing(coder, library):
    rng = np.random.default_rng(0)
    for _ in range(1500):
        text = "".join(rng.choice(list(" \n\t.,'as1é中 \x1c!"), rng.integers(0, 16)))
        assert coder.encode([text])[0] == packed(library.encode_ordinary(text))


def test_transducer_restarts_and_streams(coder, library, monkeypatch):
    monkeypatch.setattr(B, "MAX_STATES", 40)
    t = B.MergeTransducer(coder.transducer.ranks)
    for text in AWKWARD[3:12]:
        for match in regex.findall(public_tokenizers.PATTERN, text):
            ids = library.encode_ordinary(match)
            assert t.encode(match.encode()) == ids == t.merged(match.encode())
            assert list(t.stream([match.encode()[:3], match.encode()[3:]])) == ids


def test_tokens_leave_after_bounded_lookahead(coder):
    t, longest = coder.transducer, max(map(len, coder.table))
    word = ("straightforwardly" * 40).encode()
    read = sent = 0

    def feed():
        nonlocal read
        for i in range(len(word)):
            read += 1
            yield word[i:i + 1]

    for token in t.stream(feed()):
        sent += len(coder.table[token])
        assert read - sent <= 2 * longest


def test_utf8_stream_at_every_split():
    data = "aé日👍🏽߿￿ z".encode() + b"\xf0\x9f\x91" + b"\xe0\x80\xc3\xed\xa0\x80\xf4\x90ok\xc3"
    whole = data.decode("utf-8", "replace")
    for i in range(len(data) + 1):
        for j in range(i, len(data) + 1):
            s = B.Utf8Stream()
            assert s.feed(data[:i]) + s.feed(data[i:j]) + s.feed(data[j:]) + s.close() == whole
