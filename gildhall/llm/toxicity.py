"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as an embedding of itself and the mean of the embeddings of its
character n-grams. Every window of ``WINDOW`` words in a row, one starting at
each word, runs through the network in both directions; attention pools the
states to one logit, and a document scores as its highest window. Trained in numpy on a bounded sample of
labelled rows: in each epoch all windows of the sample are scored, and each
document is learned from by its highest ones, negatives also by every window
that comes near the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gildhall.llm import anchors as A
from gildhall.llm._util import id_text, map_arrow
from gildhall.llm.lang_id import BYTE_CLASS

WINDOW = 6
HIDDEN, WORD_DIMS, CHAR_DIMS = 8, 8, 8
WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 14
ORDERS = (3, 4)
#: Documented bounds of the fit: rows of each label, and bytes of a text to learn from (longer ones are scored whole all the same).
TRAIN_ROWS = {1: 1000, 0: 3000}
TRAIN_BYTES = 1 << 14
SLICES = 16
REPEATED = 600
EPOCHS, STEPS, BATCH, RATE = 8, 24, 256, 0.01  # at least STEPS steps an epoch, however small the sample
SEED = 3

GROUP_BYTES = 4 << 20
SLICE = 1 << 18
BLOCK = 2048
SPACE = 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Words:
    """The words of some texts: ``word[i]`` numbers the distinct words, ``doc[i]`` the texts; n-gram buckets in the order of the distinct words."""

    def __init__(self, texts: list[bytes]):
        data = BYTE_CLASS[np.frombuffer(b" " + b" ".join(texts) + b" \0\0\0", dtype=np.uint8)]
        inside = data != SPACE
        edge = np.diff(inside.astype(np.int8))
        start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        if inside[-1]:
            end = np.r_[end, len(data)]
        value = np.empty(len(start), dtype=np.uint64)
        cut = np.unique(np.r_[np.searchsorted(start, np.arange(0, len(data), SLICE)), len(start)])
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            at = start[i]
            value[i:j] = A.Rolling(A.BYTE_VALUE[data[at:end[j - 1]]]).at(start[i:j] - at, end[i:j] - at)
        value = A.mix(value + (end - start).astype(np.uint64))
        begins = np.cumsum([1] + [len(t) + 1 for t in texts])
        self.doc = np.searchsorted(begins, start, side="right") - 1
        distinct, first, self.word = np.unique(value, return_index=True, return_inverse=True)
        self.bucket = (distinct >> np.uint64(49)).astype(np.int64)
        start, size = start[first], end[first] - start[first]
        codes, owners = [], []
        for order in ORDERS:
            n = np.maximum(size + 3 - order, 0)  # with one space on either side
            owner = np.repeat(np.arange(len(size), dtype=np.int32), n)
            at = start[owner] - 1 + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            code = np.zeros(len(at), dtype=np.uint32)
            for k in range(order):
                code |= data[at + k].astype(np.uint32) << np.uint32(8 * k)
            codes.append(((code + np.uint32(0x9E37 * order)) * np.uint32(0x9E3779B1) >> np.uint32(18)).astype(np.int32))
            owners.append(owner)
        owner = np.concatenate(owners)
        self.gram = np.concatenate(codes)[np.argsort(owner, kind="stable")]
        self.grams = np.bincount(owner, minlength=len(size))
        self.begin = np.cumsum(self.grams) - self.grams

    def spelling(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-gram buckets of the distinct words ``of``, and the position in ``of`` that each belongs to."""
        n = self.grams[of]
        owner = np.repeat(np.arange(len(of)), n)
        at = np.repeat(self.begin[of], n) + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        return self.gram[at], owner


def windows(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and length of all windows; a shorter text is one window, a text without words none."""
    n = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(n) - n
    count = np.where(n == 0, 0, np.maximum(n - WINDOW, 0) + 1)
    of = np.repeat(np.arange(n_docs), count)
    start = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    return of, first[of] + start, np.minimum(n[of], WINDOW)


@dataclass
class Network:
    p: dict[str, np.ndarray]
    prior: float = 0.0
    trained: bool = True
    state: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def new(seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        d, h = WORD_DIMS + CHAR_DIMS, HIDDEN

        def draw(*shape, scale):
            return (rng.normal(size=shape) * scale).astype(np.float32)

        p = {"word": draw(WORD_BUCKETS, WORD_DIMS, scale=0.05), "char": draw(CHAR_BUCKETS, CHAR_DIMS, scale=0.05),
             "wa": draw(2 * h, h, scale=0.4), "ba": np.zeros(h, np.float32), "va": draw(h, scale=0.4),
             "wo": draw(2 * h, scale=0.4), "bo": np.zeros(1, np.float32)}
        for side in "fb":
            p |= {f"x{side}": draw(d, 3 * h, scale=d ** -0.5), f"c{side}": np.zeros(3 * h, np.float32),
                  f"u{side}": draw(h, 2 * h, scale=h ** -0.5), f"n{side}": draw(h, h, scale=h ** -0.5)}
        return Network(p)

    def inputs(self, words: Words, of: np.ndarray | None = None) -> np.ndarray:
        """Word and mean character embedding of the distinct words ``of`` (all of them if None)."""
        if of is None:
            of = np.arange(len(words.bucket))
        gram, n = words.spelling(of)[0], words.grams[of]
        chars = np.zeros((len(of), CHAR_DIMS), dtype=np.float32)
        some = np.flatnonzero(n)
        if len(some):
            chars[some] = np.add.reduceat(self.p["char"][gram], (np.cumsum(n) - n)[some], axis=0) / n[some, None]
        return np.hstack([self.p["word"][words.bucket[of]], chars])

    def run(self, side: str, gates: np.ndarray, at: np.ndarray, length: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """States (time × windows × hidden) of one direction; ``gates`` are the projected distinct words, ``at`` time × windows."""
        h, u, un = HIDDEN, self.p["u" + side], self.p["n" + side]
        steps, n = at.shape
        out = np.empty((steps, n, h), dtype=np.float32)
        state = np.zeros((n, h), dtype=np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a = gates[at[t]]
            zr = sigmoid(a[:, :2 * h] + state @ u)
            z, r = zr[:, :h], zr[:, h:]
            cand = 2 * sigmoid(2 * (a[:, 2 * h:] + (r * state) @ un)) - 1
            new = cand + z * (state - cand)
            if length is not None:
                new = np.where((t < length)[:, None], new, state)
            if keep is not None:
                keep.append((t, state, z, r, cand))
            out[t] = state = new
        return out

    def pool(self, states: np.ndarray, length: np.ndarray | None) -> tuple[np.ndarray, tuple]:
        """Logit of each window by attention over its states."""
        p = self.p
        hid = 2 * sigmoid(2 * (states @ p["wa"] + p["ba"])) - 1
        e = hid @ p["va"]
        if length is not None:
            e = np.where(np.arange(len(states))[:, None] < length[None, :], e, -1e9)
        e = np.exp(e - e.max(axis=0))
        share = e / e.sum(axis=0)
        context = (share[:, :, None] * states).sum(axis=0)
        return context @ p["wo"] + p["bo"][0], (hid, share, context)

    def logits(self, words: Words, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Logits of windows given by their first word and length."""
        x = self.inputs(words)
        gates = {s: x @ self.p["x" + s] + self.p["c" + s] for s in "fb"}
        out = np.empty(len(first), dtype=np.float32)
        full = length == WINDOW
        for whole in (True, False):
            mine = np.flatnonzero(full == whole)
            for i in range(0, len(mine), BLOCK):
                chosen = mine[i:i + BLOCK]
                size = None if whole else length[chosen]
                place = first[chosen][None, :] + np.arange(WINDOW)[:, None]
                at = words.word[np.minimum(place, len(words.word) - 1)]
                states = np.concatenate([self.run(s, gates[s], at, size) for s in "fb"], axis=2)
                out[chosen] = self.pool(states, size)[0]
        return out

    def gradient(self, words: Words, first: np.ndarray, length: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss of the given windows."""
        p, h, n = self.p, HIDDEN, len(first)
        at = words.word[np.minimum(first[None, :] + np.arange(WINDOW)[:, None], len(words.word) - 1)]
        used, local = np.unique(at, return_inverse=True)
        local = local.reshape(at.shape)
        mine = self.inputs(words, used)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(s, mine @ p["x" + s] + p["c" + s], local, length, kept[s]) for s in "fb"], axis=2)
        logit, (hid, share, context) = self.pool(states, length)
        d = ((sigmoid(logit) - y) * weight / n).astype(np.float32)
        g = {"wo": context.T @ d, "bo": np.array([d.sum()], np.float32)}
        dcontext = d[:, None] * p["wo"]
        dstates = share[:, :, None] * dcontext
        dshare = (states * dcontext).sum(axis=2)
        de = share * (dshare - (share * dshare).sum(axis=0))
        g["va"] = np.einsum("tn,tnh->h", de, hid)
        dpre = de[:, :, None] * p["va"] * (1 - hid * hid)
        g["wa"] = np.einsum("tns,tnh->sh", states, dpre)
        g["ba"] = dpre.sum(axis=(0, 1))
        dstates = dstates + dpre @ p["wa"].T
        dx = np.zeros_like(mine)
        for s, part in (("f", dstates[:, :, :h]), ("b", dstates[:, :, h:])):
            u, un = p["u" + s], p["n" + s]
            du, dun, dgates = np.zeros_like(u), np.zeros_like(un), np.zeros((len(used), 3 * h), np.float32)
            back = np.zeros((n, h), np.float32)
            for t, state, z, r, cand in reversed(kept[s]):
                total = back + part[t]
                live = (t < length)[:, None]
                dnew = np.where(live, total, 0)
                back = np.where(live, 0, total)
                dcand = dnew * (1 - z) * (1 - cand * cand)
                dmixed = dcand @ un.T
                dzr = np.hstack([dnew * (state - cand) * z * (1 - z), dmixed * state * r * (1 - r)])
                back = back + dnew * z + dmixed * r + dzr @ u.T
                du += state.T @ dzr
                dun += (r * state).T @ dcand
                np.add.at(dgates, local[t], np.hstack([dzr, dcand]))
            g["u" + s], g["n" + s] = du, dun
            g["x" + s], g["c" + s] = mine.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ p["x" + s].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], words.bucket[used], dx[:, :WORD_DIMS])
        g["char"] = np.zeros_like(p["char"])
        gram, owner = words.spelling(used)
        np.add.at(g["char"], gram, dx[owner, WORD_DIMS:] / words.grams[used][owner, None])
        return g

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        """One Adam step."""
        self.state["n"] = n = self.state.get("n", 0) + 1
        for k, v in g.items():
            m, s = self.state.get(k, (0.0, 0.0))
            m, s = 0.9 * m + 0.1 * v, 0.99 * s + 0.01 * v * v
            self.state[k] = (m, s)
            self.p[k] -= (rate * (m / (1 - 0.9 ** n)) / (np.sqrt(s / (1 - 0.99 ** n)) + 1e-8)).astype(np.float32)


def _odds(pos: np.ndarray, every: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smoothed log odds of a document being positive given a bucket; buckets of fewer than three documents say nothing."""
    rate = (y.sum() + 1) / (len(y) + 2)
    odds = np.log((pos + rate) / (every - pos + 1 - rate)) - np.log(rate / (1 - rate))
    return np.where(every >= 3, np.clip(odds, -3, 3), 0.0).astype(np.float32)


def _evidence(words: Words, y: np.ndarray, docs: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the word buckets and of the n-gram buckets, some documents at a time."""
    seen = [np.zeros((2, WORD_BUCKETS)), np.zeros((2, CHAR_BUCKETS))]
    edge = np.searchsorted(words.doc, np.arange(0, len(y) + docs, docs))
    for i, j in zip(edge[:-1], edge[1:], strict=True):
        pair = np.unique(words.doc[i:j].astype(np.int64) * len(words.bucket) + words.word[i:j])
        doc, word = pair // max(1, len(words.bucket)), pair % max(1, len(words.bucket))
        gram, owner = words.spelling(word)
        for (pos, every), bucket, of in ((seen[0], words.bucket[word], doc), (seen[1], gram, doc[owner])):
            pair = np.unique(of * len(every) + bucket)
            of, bucket = pair // len(every), pair % len(every)
            pos += np.bincount(bucket, y[of], minlength=len(every))
            every += np.bincount(bucket, minlength=len(every))
    return tuple(_odds(*s, y) for s in seen)


def train(texts: list[bytes], y: np.ndarray, prior: float, seed: int = SEED) -> Network:
    """Fit on texts with labels 0 and 1; the first input dimensions start at the sample's log odds."""
    net, rng = Network.new(seed), np.random.default_rng(seed)
    words = Words(texts)
    net.p["word"][:, 0], net.p["char"][:, 0] = _evidence(words, y)
    of, first, length = windows(words.doc, len(texts))
    # a word said over and over is no evidence by itself: negatives of one repeated word from the negative texts
    clean = np.flatnonzero(y[words.doc] == 0)
    extra = np.unique(words.word[rng.choice(clean, REPEATED)]) if len(clean) else np.zeros(0, dtype=np.int64)
    of = np.r_[of, len(texts) + np.arange(len(extra))]
    first = np.r_[first, len(words.word) + WINDOW * np.arange(len(extra))]
    length = np.r_[length, np.full(len(extra), WINDOW)]
    words.word = np.r_[words.word, np.repeat(extra, WINDOW)]
    y, n_texts = np.r_[y, np.zeros(len(extra), dtype=y.dtype)], len(texts) + len(extra)
    positives = max(1, int(y.sum()))
    for epoch in range(EPOCHS):
        score = net.logits(words, first, length)
        order = np.lexsort((-score + (rng.gumbel(size=len(score)) if epoch == 0 else 0), of))
        n = np.bincount(of, minlength=n_texts)
        top = np.empty(len(of), dtype=np.int64)
        top[order] = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        doubtful = (score > -3) & (epoch > 1)  # every window of a negative that comes near the threshold
        chosen = np.flatnonzero(np.where(y[of] == 1, top < 1, (top < 1) | doubtful | (rng.random(len(of)) < 0.02)))
        weight = np.where(y[of[chosen]] == 1, len(chosen) / (4 * positives), 1.0)
        steps = max(STEPS, len(chosen) // BATCH)
        passes = -(-steps * BATCH // len(chosen))
        turns = np.concatenate([rng.permutation(len(chosen)) for _ in range(passes)])[:steps * BATCH]
        for i in np.array_split(turns, steps):
            c = chosen[i]
            net.step(net.gradient(words, first[c], length[c], y[of[c]], weight[i]), RATE * (1 - 0.8 * epoch / EPOCHS))
    net.state, net.prior = {}, prior
    return net


def _segments(data: bytes) -> Iterator[bytes]:
    """A long text in overlapping parts, so that every ``WINDOW`` words in a row are whole in one."""
    at = 0
    while len(data) - at > GROUP_BYTES:
        to = data.find(b" ", at + GROUP_BYTES)
        if to < 0:
            break
        yield data[at:to]
        back = to
        for _ in range(WINDOW):
            back = data.rfind(b" ", at + 1, back)
            if back < 0:
                break
        at = back + 1 if back > at else to
    yield data[at:]


def scores(net: Network, texts: list[str]) -> np.ndarray:
    """Highest window of each text, 0 to 1; a text without letters scores 0."""
    out = np.zeros(len(texts))
    held, owners, size = [], [], 0

    def flush():
        words = Words(held)
        if len(words.word):
            of, first, length = windows(words.doc, len(held))
            np.maximum.at(out, np.array(owners)[of], sigmoid(net.logits(words, first, length).astype(np.float64)))

    for i, t in enumerate(texts):
        for part in _segments(t.lower().encode()):
            held.append(part)
            owners.append(i)
            size += len(part)
            if size >= GROUP_BYTES:
                flush()
                held, owners, size = [], [], 0
    if held:
        flush()
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network:
    """Train on labelled rows where ``learn`` (over ``doc_id``) holds, picked by hash of the id within each label."""
    def first(*keys: str) -> Column:
        return F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))

    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id IS NOT NULL AND y IN (0, 1)").dropDuplicates(["doc_id"]).where(learn))
    rates = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = rates.get(1, 0) / max(1, sum(rates.values()))
    most = F.when(F.col("y") == 1, TRAIN_ROWS[1]).otherwise(TRAIN_ROWS[0])
    picked = (known.withColumn("h", F.xxhash64(F.lit("toxic"), "doc_id")).withColumn("slice", F.pmod("h", F.lit(SLICES)))
              .withColumn("rn", first("y", "slice")).where(F.col("rn") <= most)
              .withColumn("rn", first("y")).where(F.col("rn") <= most).select("doc_id", "y", "rn"))
    # at most TRAIN_ROWS rows, so this side may be broadcast
    rows = (id_text(docs, id_col, text_col).where(F.octet_length("text") <= TRAIN_BYTES)
            .join(F.broadcast(picked), "doc_id").collect())
    rows = sorted(rows, key=lambda r: (r["rn"], r["y"], r["doc_id"]))
    y = np.array([r["y"] for r in rows], dtype=np.float32)
    if not len(rows) or y.min() == y.max():
        return Network({}, prior, trained=False)
    return train([r["text"].lower().encode() for r in rows], y, prior)


def score_documents(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) for every row, from the whole text alone.

    A null text, an empty one and one without letters score 0. If the labels
    learned from hold one class or none, every text scores the share of ones
    among them. Rows with a null id and repeated rows are scored like any other;
    an empty table gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        model = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            out = scores(model, texts) if model.trained else np.full(len(texts), model.prior)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return map_arrow(id_text(docs, id_col, text_col), run, "doc_id long, score double")
