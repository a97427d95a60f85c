"""Language-model scoring by subword lattices.

The pieces of an existing vocabulary span a lattice over each word: every way
to write it as pieces is a path, and the word's probability is the sum over
all paths, by forward recursion in log space. Piece probabilities start from
the vocabulary's scores and are fitted to the training words by expectation
maximisation over the same lattices.

The corpus is read once. Each task keeps a dictionary of the words of some
thirty megabytes of text; documents become counts over that dictionary, and
only dictionaries are shuffled: to sum the counts of each word, to score each
distinct word once, and to bring counts and scores back to the documents.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildhall.llm import anchors as A
from gildhall.llm._util import id_text, map_arrow, share, ship, stage, word_blocks

CHUNK_BYTES = 32 << 20
CHUNK_DOCS = 1 << 15
ROUNDS = 2
#: Weight of the vocabulary's own scores against the corpus, in pieces.
PRIOR = 1000.0
MARK = "▁"
LATTICE_SYMBOLS = 1 << 16


def _piece_hash(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return A.Rolling(A.mix(codes.astype(np.uint64) + np.uint64(1))).at(lo, hi)


@dataclass
class Vocabulary:
    """Pieces by hash, byte pieces, the end piece, and natural log probabilities by piece id."""

    keys: np.ndarray
    ids: np.ndarray
    longest: int
    byte_ids: np.ndarray
    end_id: int
    logp: np.ndarray

    @staticmethod
    def read(path: str) -> Vocabulary:
        """From a sentencepiece model; its scores are minus the rank, read as a Zipf law. Unusable pieces get weight zero."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        pieces = [m.id_to_piece(i) for i in range(n)]
        score = np.array([m.get_score(i) for i in range(n)])
        normal = np.array([not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i)) for i in range(n)]) & (score > -1e8)
        byte_ids = np.array([m.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        weight = np.where(normal, 1.0 / (2.0 - np.minimum(score, 0)), 0.0)
        rare = weight[normal].min()
        weight[byte_ids] = rare
        weight[m.eos_id()] = rare
        words = [pieces[i] for i in np.flatnonzero(normal)]
        size = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        lo = np.cumsum(size) - size
        keys = _piece_hash(codes, lo, lo + size)
        order = np.argsort(keys)
        with np.errstate(divide="ignore"):
            return Vocabulary(keys[order], np.flatnonzero(normal)[order], int(size.max()), byte_ids, m.eos_id(), np.log(weight / weight.sum()))


class Lattice:
    """All arcs of a batch of words, grouped by place: ``arc[l][i]`` is the piece over the ``l`` codes that end at place ``i``."""

    def __init__(self, words: list[bytes], v: Vocabulary):
        texts = [MARK + w.decode("utf-8", "replace") for w in words]
        self.size = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        self.v, self.codes = v, codes
        self.start = np.cumsum(self.size) - self.size
        inside = np.arange(len(codes)) - np.repeat(self.start, self.size)  # codes of the word before this one
        rolling = A.Rolling(A.mix(codes.astype(np.uint64) + np.uint64(1)))
        self.piece: list[np.ndarray] = []
        for length in range(1, min(v.longest, int(self.size.max(initial=0))) + 1):
            end = np.flatnonzero(inside >= length - 1)
            key = rolling.at(end - length + 1, end + 1)
            at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            known = v.keys[at] == key
            found = np.full(len(codes), -1, dtype=np.int64)
            found[end[known]] = v.ids[at[known]]
            self.piece.append(found)
        # a code that no piece stands for is spelt in bytes
        self.bare = np.flatnonzero(self.piece[0] < 0) if self.piece else np.zeros(0, dtype=np.int64)
        spelt = [list(chr(c).encode("utf-8", "replace")) for c in codes[self.bare].tolist()]
        self.spelt_at = np.repeat(self.bare, [len(s) for s in spelt])
        self.spelt = v.byte_ids[np.array([b for s in spelt for b in s], dtype=np.int64)] if spelt else np.zeros(0, dtype=np.int64)

    def weights(self, logp: np.ndarray) -> list[np.ndarray]:
        padded = np.append(logp, -np.inf)
        out = [padded[p] for p in self.piece]
        if len(self.bare):
            out[0][self.bare] = 0.0
            np.add.at(out[0], self.spelt_at, logp[self.spelt])
        return out

    def _steps(self):
        """(place within the word, words that reach it), words by falling length."""
        order = np.argsort(-self.size, kind="stable")
        sizes = self.size[order]
        for j in range(int(sizes[0]) if len(sizes) else 0):
            yield j, order[:np.searchsorted(-sizes, -j, side="left")]

    def forward(self, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """log of all paths' weight up to each place, of each whole word, and the arcs' weights."""
        w = self.weights(logp)
        total = np.full(len(self.codes), -np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            for j, words in self._steps():
                at = self.start[words] + j
                ways = np.stack([w[n][at] + (total[at - n - 1] if j > n else (0.0 if j == n else -np.inf)) for n in range(min(j + 1, len(w)))])
                top = ways.max(axis=0)
                base = np.where(np.isfinite(top), top, 0.0)
                total[at] = base + np.log(np.exp(ways - base).sum(axis=0))
        return total, total[self.start + self.size - 1], w

    def expected(self, logp: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all paths of all words, words weighted by ``count``."""
        total, whole, w = self.forward(logp)
        after = np.full(len(self.codes), -np.inf)  # log weight of all paths behind each place
        after[self.start + self.size - 1] = 0.0
        uses = np.zeros(len(logp))
        spelt = np.zeros(len(self.codes))
        with np.errstate(invalid="ignore", divide="ignore"):
            for j, words in reversed(list(self._steps())):
                at = self.start[words] + j
                for n in range(min(j + 1, len(w))):
                    arc = w[n][at]
                    live = np.isfinite(arc)
                    if not live.any():
                        continue
                    here, word = at[live], words[live]
                    behind = arc[live] + after[here]
                    if j > n:
                        after[here - n - 1] = np.logaddexp(after[here - n - 1], behind)
                        before = total[here - n - 1]
                    else:
                        before = 0.0
                    use = np.exp(before + behind - whole[word]) * count[word]
                    piece = self.piece[n][here]
                    np.add.at(uses, piece[piece >= 0], use[piece >= 0])
                    if n == 0:
                        spelt[here[piece < 0]] = use[piece < 0]
        np.add.at(uses, self.spelt, spelt[self.spelt_at])
        return uses


def lattices(words: list[bytes], v: Vocabulary):
    """(slice, lattice) over batches of words of like length; a long word is a batch of its own."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        room = max(1, LATTICE_SYMBOLS // (len(words[order[at]]) + 2))
        chosen = order[at:at + room]
        while len(chosen) > 1 and len(words[chosen[-1]]) > 2 * len(words[chosen[0]]) + 8:
            chosen = chosen[:max(1, len(chosen) // 2)]
        yield np.array(chosen), Lattice([words[i] for i in chosen], v)
        at += len(chosen)


def dictionaries(docs: DataFrame, held: Column) -> DataFrame:
    """Staged: for each chunk its words (``word``, ``idx``, ``n`` in training) and its documents (``idxs``, ``counts``)."""
    schema = "chunk long, word binary, idx int, n long, doc_id long, held_out boolean, n_words long, idxs binary, counts binary"

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        vocab: defaultdict = defaultdict(itertools.count().__next__)
        train: list[tuple[np.ndarray, np.ndarray]] = []
        size = rows = 0

        def close():
            n = np.zeros(len(vocab), dtype=np.int64)
            for i, c in train:
                n[i] += c
            k = len(vocab)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, task << 32 | number)), pa.array(list(vocab), pa.binary()), pa.array(np.arange(k, dtype=np.int32)), pa.array(n),
                 *(pa.nulls(k, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()))], names)

        names = ["chunk", "word", "idx", "n", "doc_id", "held_out", "n_words", "idxs", "counts"]
        for b in batches:
            out = []
            for doc, text, out_of in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("held_out").to_pylist(), strict=True):
                data = text.as_py().encode().lower()
                idx = [np.fromiter(map(vocab.__getitem__, w), dtype=np.int32, count=len(w)) for w in word_blocks(data)]
                idx = np.concatenate(idx) if idx else np.zeros(0, dtype=np.int32)
                some, counts = np.unique(idx, return_counts=True)
                counts = counts.astype(np.int32)
                if not out_of:
                    train.append((some, counts))
                out.append((task << 32 | number, doc, out_of, len(idx), some.tobytes(), counts.tobytes()))
                size += len(data)
                rows += 1
                if size >= CHUNK_BYTES or rows >= CHUNK_DOCS:
                    yield _documents(out, names)
                    yield from close()
                    out, train, size, rows = [], [], 0, 0
                    vocab, number = defaultdict(itertools.count().__next__), number + 1
            if out:
                yield _documents(out, names)
        if rows:
            yield from close()

    return stage(map_arrow(docs.withColumn("held_out", held), run, schema))


def _documents(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    chunk, doc, out_of, n, idx, counts = zip(*rows, strict=True)
    k = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.array(doc, pa.int64()),
         pa.array(out_of, pa.bool_()), pa.array(n, pa.int64()), pa.array(idx, pa.binary()), pa.array(counts, pa.binary())], names)


def fit(words: DataFrame, v: Vocabulary, n_ends: int, rounds: int = ROUNDS) -> np.ndarray:
    """Piece log probabilities after ``rounds`` of expectation maximisation over all training words (``word``, ``c``).

    A task returns one row a piece it used; what reaches the driver is one
    number a piece.
    """
    logp = v.logp
    prior = np.exp(v.logp) * PRIOR
    for _ in range(rounds):
        shared = share(words.sparkSession, (v, logp))

        def expect(batches, shared=shared):
            vocabulary, now = shared.value
            uses = np.zeros(len(now))
            for b in batches:
                c = b.column("c").to_numpy(zero_copy_only=False).astype(float)
                for at, lattice in lattices(b.column("word").to_pylist(), vocabulary):
                    uses += lattice.expected(now, c[at])
            some = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(uses[some])], ["piece", "uses"])

        found = map_arrow(words.where("c > 0").select("word", "c"), expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        uses = prior.copy()
        for r in found.collect():  # one row a piece of the vocabulary
            uses[r["piece"]] += r["uses"]
        uses[v.end_id] += n_ends
        with np.errstate(divide="ignore"):
            logp = np.log(uses / uses.sum())
    return logp


def score_documents(docs: DataFrame, model_path: str, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """log10 probability of every text under the lattice model and under add-one word counts.

    ``held`` (over ``doc_id``) marks rows that are scored but not learned from.
    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known``, ``train_tokens``, ``base_score``, ``score``. A null text is
    empty: one end token. Without any training row the pieces keep their prior
    weights and the base score of every token is log10(1). Rows with a null id
    and repeated rows are scored, and learned from, like any other. An empty
    table gives an empty result; other columns are ignored.
    """
    parts = dictionaries(id_text(docs, id_col, text_col), held)
    texts = parts.where("word IS NULL").select("chunk", "doc_id", "held_out", "n_words", "idxs", "counts")
    local = parts.where("word IS NOT NULL").select("chunk", "word", "idx", "n")
    words = stage(local.groupBy("word").agg(F.sum("n").alias("c")))
    n_ends = texts.where("NOT held_out").count()
    total = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, size = (total["n"] or 0) + n_ends, total["v"] + (n_ends > 0)

    v = Vocabulary.read(model_path)
    logp = fit(words, v, n_ends)
    shared = share(docs.sparkSession, (v, logp))

    def weigh(batches):
        vocabulary, now = shared.value
        for b in batches:
            out = np.zeros(b.num_rows)
            for at, lattice in lattices(b.column("word").to_pylist(), vocabulary):
                out[at] = lattice.forward(now)[1]
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(out / np.log(10))], ["word", "c", "lp"])

    known = map_arrow(words, weigh, "word binary, c long, lp double")
    back = local.select(F.col("chunk").alias("of_chunk"), "word", "idx").join(known, "word").select("of_chunk", "idx", "c", "lp")
    end_score, end_base = logp[v.end_id] / np.log(10), float(np.log10((n_ends + 1) / (n + size + 1)))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def gather(key, left: pa.Table, right: pa.Table) -> pa.Table:
        idx = right.column("idx").to_numpy()
        c, lp = np.zeros(len(idx), dtype=np.int64), np.zeros(len(idx))
        c[idx], lp[idx] = right.column("c").to_numpy(), right.column("lp").to_numpy()
        base = np.log10((c + 1) / (n + size + 1))
        rows = []
        for doc, out_of, n_words, some, counts in zip(*(left.column(k).to_pylist() for k in ("doc_id", "held_out", "n_words", "idxs", "counts")), strict=True):
            i, k = np.frombuffer(some, dtype=np.int32), np.frombuffer(counts, dtype=np.int32)
            rows.append((doc, out_of, n_words + 1, int(k[c[i] > 0].sum()) + (n_ends > 0), n, float(base[i] @ k) + end_base, float(lp[i] @ k) + end_score))
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([pa.array(col, t) for col, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], names)

    ship(docs.sparkSession)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(gather, schema)
