"""Frequent phrases and how strongly their words hold together, per language.

Two passes over the texts. The first deals the hashes of all phrases to hash
partitions. A partition keeps a Misra-Gries summary whose capacity exceeds its
mass (phrase occurrences) divided by the threshold. Summaries merge by adding
counts and taking the first count beyond the capacity off all of them, so what
is ever taken off one phrase stays under the threshold: every frequent phrase
survives. What was taken off is known, which leaves only phrases that can
reach the threshold. They become one bit each in a table of bounded size.

The second pass counts exactly the phrases whose bit is set, by their texts,
whether the bit was theirs or another's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gildhall.llm import anchors as A
from gildhall.llm._util import map_arrow, shuffle_partitions, stage

LONGEST, THRESHOLD = 5, 100
#: Phrase occurrences a hash partition is made for, and least and most partitions (powers of two).
SEGMENT_MASS, MIN_SEGMENT_BITS, MAX_SEGMENT_BITS = 1 << 24, 6, 16
#: Bits of the survivors' table for each summary counter, and at most 2**MAX_BITS bits (64 MB, the bound of what is broadcast).
#: Beyond that it passes more phrases to the exact counts, never fewer.
BITS_PER_COUNTER, MAX_BITS = 16, 29
#: Characters worked on at once, phrase hashes a task holds before it sends them, exact counts it holds.
GROUP_BYTES, FLUSH, HELD = 1 << 20, 1 << 21, 1 << 18

#: ASCII as it counts here: A-Z in lower case; the marks and line ends that end a piece are line feeds, a tab is a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_AHEAD = re.compile(rb"(?: *[^ \n]+){0,%d}" % (LONGEST - 1))


def text_blocks(data: bytes) -> Iterator[tuple[bytes, int]]:
    """(block, its own bytes): folded text cut before a space; a block repeats the few words that follow it."""
    at = 0
    while True:
        to = len(data)
        if to - at > GROUP_BYTES:
            space, line = data.find(b" ", at + GROUP_BYTES), data.find(b"\n", at + GROUP_BYTES)
            to = min((x for x in (space, line) if x >= 0), default=to)
        yield data[at:_AHEAD.match(data, to).end()], to - at
        at = to
        if at >= len(data):
            return


def groups(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, list[str]]]:
    """(bytes, begin of each part, bytes of it that are its own, its language) of about ``GROUP_BYTES``."""
    parts, begins, own, langs, size = [], [], [], [], 0
    for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
        for block, mine in text_blocks(text.as_buffer().to_pybytes().translate(FOLD)):
            parts.append(block)
            begins.append(size)
            own.append(mine)
            langs.append(lang)
            size += len(block) + 1
            if size >= GROUP_BYTES:
                yield b"\n".join(parts), np.array(begins), np.array(own), langs
                parts, begins, own, langs, size = [], [], [], [], 0
    if parts:
        yield b"\n".join(parts), np.array(begins), np.array(own), langs


class Phrases:
    """All phrases of a group of texts: hashes by length, and where their words lie."""

    salts: dict[str, int] = {}

    def __init__(self, text: bytes, begins: np.ndarray, own: np.ndarray, langs: list[str]):
        self.text, self.langs = text, langs
        data = np.frombuffer(text, dtype=np.uint8)
        line = data == 10
        inside = ~(line | (data == 32))
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(line, dtype=np.int32)[self.start]
        self.part = np.searchsorted(begins, self.start, side="right") - 1
        self.mine = self.start < (begins + own)[self.part]
        self.values = A.BYTE_VALUE[data]

    def words(self, which: int) -> np.ndarray:
        salt = np.array([self.salt(x, which) for x in self.langs], dtype=np.uint64)
        rolled = A.Rolling(self.values, which).at(self.start, self.end)
        return A.mix(rolled + (self.end - self.start).astype(np.uint64), which + 1) ^ salt[self.part]

    @classmethod
    def salt(cls, lang: str, which: int) -> int:
        key = f"{which}{lang}"
        if key not in cls.salts:
            if len(cls.salts) > 10_000:
                cls.salts.clear()
            cls.salts[key] = int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little")
        return cls.salts[key]

    def hashes(self, which: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first words, hashes) of the phrases of n words that begin in their part's own bytes."""
        word = self.words(which)
        first = np.flatnonzero(self.mine)
        h = A.mix(word[first], 3)
        yield 1, first, h
        for n in range(2, LONGEST + 1):
            keep = first + n - 1 < len(word)
            keep[keep] = self.piece[first[keep] + n - 1] == self.piece[first[keep]]
            first, h = first[keep], h[keep]
            h = A.mix(h + word[first + n - 1], 3 + n)
            yield n, first, h

    def phrase(self, first: int, n: int) -> bytes:
        p = self.text[self.start[first]:self.end[first + n - 1]]
        return b" ".join(p.split()) if b"  " in p else p


def by_language(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def segment_bits(docs: DataFrame) -> tuple[int, int]:
    """Hash partitions, and bits of the survivors' table, for the size of the texts (both as powers of two)."""
    mass = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6 * LONGEST
    segments = int(np.clip(np.ceil(np.log2(mass / SEGMENT_MASS + 1)), MIN_SEGMENT_BITS, MAX_SEGMENT_BITS))
    return segments, int(np.clip(np.ceil(np.log2(BITS_PER_COUNTER * mass / THRESHOLD + 1)), segments + 10, MAX_BITS))


def partitions(docs: DataFrame, segments: int) -> int:
    """Tasks to sum up hash partitions: at most four of them each, however many there are."""
    return max(shuffle_partitions(docs.sparkSession), 1 << max(segments - 2, 0))


def _coded(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Keys met once, keys met more often, and how often."""
    once = counts == 1
    return keys[once].tobytes(), keys[~once].tobytes(), counts[~once].astype(np.uint32).tobytes()


def dealt(docs: DataFrame, segments: int) -> DataFrame:
    """Each task's phrases by hash partition: rows with its mass (``turn`` 0), then rows of keys and counts."""
    names = ["segment", "turn", "mass", "once", "more", "counts"]
    low = np.uint64(32 - segments)

    def rows(segment, turn, mass, coded):
        n = len(segment)
        coded = list(zip(*coded, strict=True)) if coded else [[None] * n] * 3
        return pa.RecordBatch.from_arrays([pa.array(segment, pa.int32()), pa.array([turn] * n, pa.int32()), pa.array(mass, pa.int64()),
                                           *(pa.array(c, pa.binary()) for c in coded)], names)

    def run(batches):
        held, size, mass = [], 0, np.zeros(1 << segments, dtype=np.int64)

        def flush():
            keys, counts = np.unique(np.concatenate(held) >> low, return_counts=True)
            at = np.searchsorted(keys, np.arange((1 << segments) + 1, dtype=np.uint64) << np.uint64(32))
            np.add(mass, np.add.reduceat(np.r_[counts, 0], at[:-1]) * (at[1:] > at[:-1]), out=mass)
            some = np.flatnonzero(at[1:] > at[:-1])
            keys = keys.astype(np.uint32)
            yield rows(some, 1, [None] * len(some), [_coded(keys[at[s]:at[s + 1]], counts[at[s]:at[s + 1]]) for s in some.tolist()])

        for b in batches:
            for group in groups(b):
                for _, _, h in Phrases(*group).hashes():
                    held.append(h)
                    size += len(h)
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()
        some = np.flatnonzero(mass)
        if len(some):
            yield rows(some, 0, mass[some].tolist(), None)

    return map_arrow(docs, run, "segment int, turn int, mass long, once binary, more binary, counts binary")


class Summary:
    """Misra-Gries over dealt keys; whole lists of keys and counts are merged at once."""

    def __init__(self, mass: int, threshold: int):
        self.capacity, self.threshold = mass // threshold + 1, threshold
        self.keys, self.counts, self.taken = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), 0
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.new.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting >= max(1 << 18, 4 * self.capacity):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.new)])
        counts = np.concatenate([self.counts, *(c for _, c in self.new)])
        self.new, self.waiting = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            beyond = len(keys) - self.capacity - 1
            off = int(np.partition(counts, beyond)[beyond])
            self.taken += off
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.taken >= self.threshold]


def survivors(docs: DataFrame, segments: int, bits: int, threshold: int = THRESHOLD) -> tuple[np.ndarray, int]:
    """The bit table of all phrases that can reach ``threshold`` (2**bits bits, by their hashes' first bits), and their number."""
    slice_bits = bits - segments

    def run(batches):
        segment = mass = summary = None

        def done():
            keys = summary.survivors()
            marks = np.zeros(1 << slice_bits, dtype=bool)
            marks[keys >> np.uint32(32 - slice_bits)] = True
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([len(keys)], pa.int64()),
                                               pa.array([np.packbits(marks, bitorder="little").tobytes()])], ["segment", "n", "bits"])

        for b in batches:
            for seg, turn, m, once, more, counts in zip(*(b.column(i) for i in range(6)), strict=True):
                if seg.as_py() != segment:
                    if summary is not None:
                        yield done()
                    segment, mass, summary = seg.as_py(), 0, None
                if not turn.as_py():
                    mass += m.as_py()
                    continue
                if summary is None:
                    summary = Summary(mass, threshold)
                once, more, counts = (np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in (once, more, counts))
                summary.add(np.concatenate([once, more]), np.concatenate([np.ones(len(once), dtype=np.int64), counts.astype(np.int64)]))
        if summary is not None:
            yield done()

    parts = dealt(docs, segments).repartition(partitions(docs, segments), "segment").sortWithinPartitions("segment", "turn")
    out, n = np.zeros((1 << segments, (1 << slice_bits) // 8), dtype=np.uint8), 0
    for r in map_arrow(parts, run, "segment int, n long, bits binary").toLocalIterator():  # one slice at a time
        out[r["segment"]] = np.frombuffer(r["bits"], dtype=np.uint8)
        n += r["n"]
    return out.reshape(-1), n


class Tally:
    """Exact counts of phrases, at most ``HELD`` at a time; a phrase is told by 128 bits of hash here and by its text later."""

    def __init__(self):
        self.h = [np.zeros(0, dtype=np.uint64)] * 2
        self.counts, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int8)
        self.lang, self.phrase = np.zeros(0, dtype=object), np.zeros(0, dtype=object)

    def add(self, of: Phrases, n: int, first: np.ndarray, h: np.ndarray, h2: np.ndarray) -> None:
        order = np.argsort(h, kind="stable")
        first, h, h2 = first[order], h[order], h2[order]
        at = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])][:len(h)])
        counts = np.diff(np.r_[at, len(h)])
        first, h, h2 = first[at], h[at], h2[at]
        place = np.searchsorted(self.h[0], h)
        known = place < len(self.h[0])
        known[known] = (self.h[0][place[known]] == h[known]) & (self.h[1][place[known]] == h2[known])
        np.add.at(self.counts, place[known], counts[known])
        new = ~known
        if new.any():
            first, place = first[new], place[new]
            texts = np.empty(len(first), dtype=object)
            texts[:] = [of.phrase(f, n) for f in first.tolist()]
            langs = np.array(of.langs, dtype=object)[of.part[first]]
            for name, values in (("counts", counts[new]), ("size", np.full(len(first), n, dtype=np.int8)), ("lang", langs), ("phrase", texts)):
                setattr(self, name, np.insert(getattr(self, name), place, values))
            self.h = [np.insert(old, place, x[new]) for old, x in zip(self.h, (h, h2), strict=True)]

    def rows(self, segments: int, words: dict[str, int] | None = None) -> pa.RecordBatch:
        """One row for each hash partition: lists of languages, lengths, phrases and counts (``words``: length 0)."""
        words = words or {}
        seg = (self.h[0] >> np.uint64(64 - segments)).astype(np.int64)
        extra = np.array([Phrases.salt(x, 0) >> (64 - segments) for x in words], dtype=np.int64)
        order = np.argsort(np.r_[seg, extra], kind="stable")
        seg = np.r_[seg, extra][order]
        first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]][:len(seg)])
        offsets = pa.array(np.r_[first, len(seg)].astype(np.int32))
        lists = [pa.array(np.r_[self.lang, np.array(list(words), dtype=object)][order], pa.string()),
                 pa.array(np.r_[self.size.astype(np.int32), np.zeros(len(words), dtype=np.int32)][order]),
                 pa.array([p.decode() for p in np.r_[self.phrase, np.array([b""] * len(words), dtype=object)][order]], pa.string()),
                 pa.array(np.r_[self.counts, np.array(list(words.values()), dtype=np.int64)][order])]
        return pa.RecordBatch.from_arrays([pa.array(seg[first].astype(np.int32)), *(pa.ListArray.from_arrays(offsets, x) for x in lists)],
                                          ["segment", *COUNTED])


COUNTED = ["lang", "n", "phrase", "f"]


def summed(rows: DataFrame, threshold: int, partitions: int) -> DataFrame:
    """Exact counts from the tasks' lists, a hash partition at a time; phrases under the threshold go."""
    def run(batches):
        segment, held = None, []

        def merged():
            t = pa.concat_tables(held).group_by(COUNTED[:3]).aggregate([("f", "sum")])
            return t.select([*COUNTED[:3], "f_sum"]).rename_columns(COUNTED)

        def done():
            t = merged()
            keep = (t["n"].to_numpy() == 0) | (t["f"].to_numpy() >= threshold)
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches(max_chunksize=1 << 14)

        for b in batches:
            for i, seg in enumerate(b.column("segment").to_pylist()):
                if segment is not None and seg != segment:
                    yield from done()
                    held = []
                segment = seg
                held.append(pa.table([b.column(c)[i].values for c in COUNTED], COUNTED))
                if sum(map(len, held)) > 1 << 18 and len(held) > 8:
                    held = [merged()]
        if held:
            yield from done()

    parts = rows.repartition(partitions, "segment").sortWithinPartitions("segment")
    return map_arrow(parts, run, "lang string, n int, phrase string, f long")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``n``, ``phrase``, ``f`` of every phrase of 1 to 5 words with f >= ``threshold``, staged.

    Beside them one row a language with ``n`` 0 and all its word occurrences.
    """
    docs = by_language(docs, text_col, lang_col)
    segments, bits = segment_bits(docs)
    table, _ = survivors(docs, segments, bits, threshold)
    seen = docs.sparkSession.sparkContext.broadcast(table)
    shift = np.uint64(64 - bits)

    def count(batches):
        marks, tally, words = seen.value, Tally(), {}
        for b in batches:
            for group in groups(b):
                p = Phrases(*group)
                for part, n in zip(*np.unique(p.part[p.mine], return_counts=True), strict=True):
                    words[p.langs[part]] = words.get(p.langs[part], 0) + int(n)
                second = p.hashes(1)
                for n, first, h in p.hashes():
                    _, _, h2 = next(second)
                    cell = h >> shift
                    keep = (marks[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    if keep.any():
                        tally.add(p, n, first[keep], h[keep], h2[keep])
                if len(tally.counts) >= HELD:
                    yield tally.rows(segments)
                    tally = Tally()
        yield tally.rows(segments, words)

    rows = map_arrow(docs, count, "segment int, lang array<string>, n array<int>, phrase array<string>, f array<long>")
    found = stage(summed(rows, threshold, partitions(docs, segments)))
    seen.destroy()
    return found


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases of 2 to 5 words by how strongly their weakest cut holds.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts at the cut
    with the lowest score floor(1000 a n / (l r)), ``n`` all words of the
    language; the first of equal cuts counts. A phrase inside a longer one that
    occurs as often is left out. Null texts are empty, a null language is
    ``und``; rows repeat and ids play no part. Without a frequent phrase (an
    empty table too) the result is empty. Other columns are ignored.
    """
    found = frequent_phrases(docs, threshold, text_col, lang_col)
    totals = found.where("n = 0").select("lang", F.col("f").alias("total"))
    counts = found.where("n > 0")
    words = F.split("phrase", " ")
    candidates = counts.where("n > 1").withColumn("words", words)

    def part(lo, size):
        return F.array_join(F.slice("words", lo, size), " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n") - m + 1), lambda lo: part(lo, m))))
    covered = (candidates.where("n > 2").select("lang", F.explode(inner).alias("phrase"), "f")
               .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = stage(candidates.join(covered, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * f")
                 .select("lang", "phrase", "n", "words", F.col("f").alias("a")))
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"), "n", "words").select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))

    def exact(name):
        return f"CAST({name} AS DECIMAL(38, 0))"
    scored = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
              .withColumn("score", F.expr(f"({exact('1000')} * {exact('a')} * {exact('total')}) div ({exact('l')} * {exact('r')})")))
    weakest = (scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
               .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"),
                       F.col("cut.score").cast("long").alias("score")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
