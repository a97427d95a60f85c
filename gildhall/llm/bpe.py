"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

A token sequence is the BPE encoding of its bytes exactly if every pair of
neighbours is: merging the two tokens' bytes by rank gives the two tokens
back. So encoding is a walk through a nondeterministic transducer that reads
bytes along the vocabulary's trie and may emit a token, and return to the
root, only behind a token it is compatible with. Every prefix has one such
path. The determinised state holds the paths still alive with the tokens each
has pending; what all of them share is emitted at once, so tokens come out
after a bounded lookahead. States and transitions are made when first needed.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gildhall.llm._util import id_text, map_arrow
from gildhall.llm.pretoken import PartCache, text_batches

#: States kept before the tables start anew; the result does not depend on it.
MAX_STATES = 220_000
#: Matches of the splitting pattern whose tokens are remembered; likewise.
MAX_MATCHES = 250_000


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes → rank from lines ``base64 rank``."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeTransducer:
    """The determinised transducer of one vocabulary.

    A state is the set of paths alive, each as (pending tokens, trie node). The
    last token sent out is kept beside the state, in a register: it matters
    only to the one path without pending tokens, when that completes a token.
    A transition therefore names that token and has two targets, for the
    register's token being compatible with it or not. This keeps the number of
    states near that of the trie's nodes.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                to = self.children[node].get(byte)
                if to is None:
                    to = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(None)
                node = to
            self.token_at[node] = rank
        self._restart()

    def _restart(self) -> None:
        self.pairs: dict[int, bool] = {}
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: dict[int, tuple] = {}  # state << 8 | byte
        self.ends: list[tuple[int, ...] | None] = []
        self._state((((), 0),))

    def _state(self, paths: tuple) -> int:
        at = self.ids.get(paths)
        if at is None:
            at = self.ids[paths] = len(self.states)
            self.states.append(paths)
            self.ends.append(next((pending for pending, node in paths if node == 0), None))
        return at

    def merged(self, data: bytes) -> list[int]:
        """Merging by rank, the definition; used on pairs of tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            at = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            low = min((r for r in at if r is not None), default=None)
            if low is None:
                break
            i = at.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """``left`` followed by ``right`` is how their bytes are encoded; anything may stand first (left = -1)."""
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if left < 0:
                known = True
            else:
                both = self.tokens[left] + self.tokens[right]
                known = both not in self.ranks and self.merged(both) == [left, right]
            self.pairs[pair] = known
        return known

    def _move(self, alive: list[tuple]) -> tuple[int, tuple[int, ...]] | None:
        """State of the paths alive once the tokens they share are sent out, and those tokens."""
        if not alive:
            return None
        first, shared = alive[0][0], 0
        while shared < len(first) and all(len(p) > shared and p[shared] == first[shared] for p, _ in alive):
            shared += 1
        return self._state(tuple(sorted((p[shared:], n) for p, n in alive))), first[:shared]

    def _step(self, at: int, byte: int) -> tuple:
        """Make the transition from state ``at`` on ``byte``: (token to test or None, target if it may follow, if not)."""
        alive, tested = [], None
        for pending, node in self.states[at]:
            to = self.children[node].get(byte)
            if to is None:
                continue
            token = self.token_at[to]
            if token is not None:
                if not pending:
                    tested = token
                elif self.compatible(pending[-1], token):
                    alive.append(((*pending, token), 0))
            if self.children[to]:
                alive.append((pending, to))
        if tested is None:
            made = (None, self._move(alive), None)
        else:
            made = (tested, self._move([*alive, ((tested,), 0)]), self._move(alive))
        self.next[at << 8 | byte] = made
        return made

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one match of the splitting pattern."""
        if len(self.states) > MAX_STATES or len(self.pairs) > 3 * MAX_STATES:
            self._restart()
        at, last, out, moves, pairs = 0, -1, [], self.next.get, self.pairs.get
        for byte in data:
            made = moves(at << 8 | byte)
            if made is None:
                made = self._step(at, byte)
            tested, yes, no = made
            if tested is not None:
                fits = pairs(last << 32 | tested)
                if fits is None:
                    fits = self.compatible(last, tested)
                if not fits:
                    yes = no
            at, sure = yes
            if sure:
                out += sure
                last = sure[-1]
        out += self.ends[at]
        return out

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one match that arrives in chunks, each token as soon as it is certain."""
        at, last = 0, -1
        for byte in (b for chunk in chunks for b in chunk):
            tested, yes, no = self.next.get(at << 8 | byte) or self._step(at, byte)
            at, sure = yes if tested is None or self.compatible(last, tested) else no
            if sure:
                yield from sure
                last = sure[-1]
        yield from self.ends[at]


class Utf8Stream:
    """Text from bytes that arrive in pieces; a character cut by a border waits for its rest.

    The state is the sequence begun: how many continuation bytes are due, and
    the range the next one must lie in (overlong forms and surrogates are
    never begun).
    """

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def begun(tail: bytes) -> bool:
        """``tail`` is the start of a valid sequence that is not complete."""
        lead = tail[0]
        if 0xC2 <= lead < 0xE0:
            due = 1
        elif 0xE0 <= lead < 0xF0:
            due = 2
        elif 0xF0 <= lead < 0xF5:
            due = 3
        else:
            return False
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
        for byte in tail[1:]:
            if not low <= byte <= high:
                return False
            low, high, due = 0x80, 0xBF, due - 1
        return due > 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        keep = next((k for k in (1, 2, 3) if k <= len(data) and self.begun(data[-k:])), 0)
        self.waiting = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Encoder and decoder for one vocabulary and splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = MergeTransducer(ranks)
        self.split: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.matches: dict[str, list[int]] = {}
        self.cache = PartCache(self._encode_parts, limit=450_000)
        self.table = [self.transducer.tokens[r] for r in range(len(ranks))]

    def _encode_parts(self, texts: list[str]) -> list[bytes]:
        encode, seen, out = self.transducer.encode, self.matches, []
        if len(seen) > MAX_MATCHES:
            seen.clear()
        for matches in map(self.split, texts):
            ids: list[int] = []
            for m in matches:
                known = seen.get(m)
                if known is None:
                    known = encode(m.encode())
                    if len(m) <= 32:
                        seen[m] = known
                ids += known
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.cache.joined(texts)

    def decode(self, ids: bytes, block: int = 1 << 16) -> Iterator[str]:
        """The text of ``ids``, piece by piece."""
        values, out, table = np.frombuffer(ids, dtype="<u4"), Utf8Stream(), self.table
        for at in range(0, len(values), block):
            yield out.feed(b"".join(map(table.__getitem__, values[at:at + block].tolist())))
        yield out.close()


_codecs: dict[str, Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary file and worker process."""
    key = f"{path}\n{pattern}"
    if key not in _codecs:
        with open(path, "rb") as f:
            _codecs[key] = Codec(read_ranks(f), pattern)
    return _codecs[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     keep: bool = True) -> DataFrame:
    """Encode every text by the ranks at ``path`` and decode the ids again.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` and, with ``keep``, ``ids``
    (array) and ``decoded``. A null or empty text has no tokens. Rows with a
    null id and repeated rows are encoded like any other; an empty table gives
    an empty result; other columns are ignored. One pass, no shuffle. The
    vocabulary file must be readable at ``path`` on every executor.
    """

    def run(batches):
        coder = codec(path, pattern)
        for b in batches:
            ids = b.column("doc_id")
            for at, texts in text_batches(b.column("text").to_pylist()):
                n, coded, plain, values, decoded = [], [], [], [], []
                for data in coder.encode(texts):
                    text, digest = [], hashlib.sha256()
                    for piece in coder.decode(data):
                        digest.update(piece.encode())
                        if keep:
                            text.append(piece)
                    n.append(len(data) // 4)
                    coded.append(hashlib.sha256(data).hexdigest())
                    plain.append(digest.hexdigest())
                    if keep:
                        values.append(np.frombuffer(data, dtype="<u4").astype(np.int32))
                        decoded.append("".join(text))
                columns = [ids.slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(coded), pa.array(plain)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    columns += [pa.array(values, pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(id_text(docs, id_col, text_col), run, schema + (", ids array<int>, decoded string" if keep else ""))
