"""Repeated fixed-length windows over all documents: prefilter, runs, classes.

Shared by the byte and the word operator. Three passes:

1. every task adds its anchors to a count-min sketch; the partition sketches
   are merged cell range by cell range, and one bit a cell (counted twice or
   more) is left;
2. anchors whose every cell has that bit are written out with their runs. The
   sketch only ever overestimates, so no repeated window is lost;
3. runs with equal descriptions are grouped to classes, exactly.

What remains open after that are windows of classes that share an anchor but
differ around it; the two operators settle those each in their own way.
"""

from __future__ import annotations

import dataclasses
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm import anchors as A
from gildhall.llm._util import id_text, map_arrow, shuffle_partitions, stage

#: Sketch: rows, and at least ``CELLS_PER_ANCHOR`` cells for each expected anchor up to 2**MAX_CELL_BITS cells a row
#: (32 MB of bits a row, the bound of what is broadcast). Beyond that it passes more anchors, never fewer.
ROWS, CELLS_PER_ANCHOR, MIN_CELL_BITS, MAX_CELL_BITS = 2, 2, 16, 28
SEGMENT_BITS = 8
FLUSH = 1 << 20
GROUP_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclasses.dataclass(frozen=True)
class Shape:
    """``m`` units to a window, anchors of ``k`` units; units are bytes or words."""

    m: int
    k: int
    words: bool

    @property
    def bytes_per_anchor(self) -> float:
        return (self.m - self.k + 2) / 2 * (6 if self.words else 1)


class Batch:
    """The units of a few documents: values, and where each unit lies in the bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, words: bool):
        self.data, self.words = data, words
        if not words:
            self.base, self.lengths = offsets[:-1], np.diff(offsets)
            return
        starts, ends, values = [], [], []
        at, stop = int(offsets[0]), int(offsets[-1])
        while at < stop:
            to = min(at + GROUP_BYTES, stop)
            while to < stop:  # on to the next white space or document, so no word is cut
                rest = SPACE[data[to:to + 4096]]
                edge = int(offsets[np.searchsorted(offsets, to)])
                if rest.any() and to + int(rest.argmax()) < edge:
                    to += int(rest.argmax())
                    break
                if edge <= to + 4096:
                    to = min(edge, stop)
                    break
                to += 4096
            piece = data[at:to]
            inside = ~SPACE[piece]
            bound = np.zeros(len(piece) + 1, dtype=bool)
            bound[offsets[(offsets >= at) & (offsets <= to)] - at] = True
            first = inside.copy()
            first[1:] &= ~inside[:-1] | bound[1:-1]
            last = inside.copy()
            last[:-1] &= ~inside[1:] | bound[1:-1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            values.append(A.mix(A.Rolling(A.BYTE_VALUE[piece]).at(s, e) + (e - s).astype(np.uint64)))
            starts.append(s + at)
            ends.append(e + at)
            at = to
        self.starts = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
        self.values = np.concatenate(values) if values else np.zeros(0, dtype=np.uint64)
        first_word = np.searchsorted(self.starts, offsets)
        self.base, self.lengths = first_word[:-1], np.diff(first_word)

    def span(self, d: int, lo: int, hi: int) -> np.ndarray:
        lo, hi = int(self.base[d]) + lo, int(self.base[d]) + hi
        return self.values[lo:hi] if self.words else A.BYTE_VALUE[self.data[lo:hi]]

    def runs(self, shape: Shape) -> Iterator[dict[str, np.ndarray]]:
        """Runs with ``doc`` (in this batch) and ``lo`` counted from the document's start."""
        for pieces in A.slices(self.lengths, shape.m):
            table = np.array(pieces)
            found = A.runs(np.concatenate([self.span(*p) for p in pieces]), np.cumsum(table[:, 2] - table[:, 1]),
                           shape.m, shape.k)
            piece = found.pop("piece")
            yield found | {"doc": table[piece, 0], "lo": found["lo"] + table[piece, 1]}

    def flank(self, d: int, lo: int, hi: int) -> bytes:
        """Bytes of the units [lo, hi); words with one space between."""
        if hi <= lo:
            return b""
        at = int(self.base[d])
        if not self.words:
            return self.data[at + lo:at + hi].tobytes()
        return b" ".join(self.data[self.starts[at + lo]:self.ends[at + hi - 1]].tobytes().split())


def text_groups(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of about ``GROUP_BYTES`` of text at a time."""
    whole = texts.cast(pa.large_string())
    if not len(whole):
        return
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset:whole.offset + len(whole) + 1]
    raw = whole.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(whole):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, side="right")) - 1)
        yield i, data, offsets[i:j + 1]
        i = j


def _cells(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    return A.mix(key, row + 1) >> np.uint64(64 - bits)


def _coded(cells: np.ndarray) -> bytes:
    """Sorted cells as compressed differences."""
    return zlib.compress(np.diff(cells, prepend=np.uint32(0)).tobytes(), 1)


def _decoded(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), dtype=np.uint32), dtype=np.uint32)


def sketch(docs: DataFrame, shape: Shape, bits: int) -> np.ndarray:
    """Merged sketch as bits: cell counted at least twice (``ROWS`` × 2**bits / 8 bytes)."""
    low = bits - SEGMENT_BITS

    def count(batches):
        held, size = [], 0

        def flush():
            keys = np.concatenate(held)
            for r in range(ROWS):
                cells, n = np.unique(_cells(keys, r, bits), return_counts=True)
                cells = np.repeat(cells, np.minimum(n, 2)).astype(np.uint32)
                seg = cells >> np.uint32(low)
                at = np.searchsorted(seg, np.arange((1 << SEGMENT_BITS) + 1))
                local = cells & np.uint32((1 << low) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(1 << SEGMENT_BITS, dtype=np.int32) + (r << SEGMENT_BITS)),
                     pa.array([_coded(local[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())],
                    ["segment", "cells"])

        for b in batches:
            for _, data, offsets in text_groups(b.column("text")):
                for run in Batch(data, offsets, shape.words).runs(shape):
                    held.append(run["key"])
                    size += len(run["key"])
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def merge(batches):
        counts: dict[int, np.ndarray] = {}
        for b in batches:
            for seg, blob in zip(b.column("segment").to_pylist(), b.column("cells"), strict=True):
                if seg not in counts:
                    counts[seg] = np.zeros(1 << low, dtype=np.uint8)
                cells = _decoded(blob.as_py())
                twice = cells[1:][cells[1:] == cells[:-1]]
                c = counts[seg]
                c[cells] = np.minimum(c[cells] + 1, 2)
                c[twice] = 2
        for seg, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([np.packbits(c >= 2, bitorder="little").tobytes()])],
                                             ["segment", "bits"])

    parts = map_arrow(docs, count, "segment int, cells binary")
    merged = map_arrow(parts.repartition(shuffle_partitions(docs.sparkSession), "segment"), merge, "segment int, bits binary")
    out = np.zeros((ROWS << SEGMENT_BITS, (1 << low) // 8), dtype=np.uint8)
    for r in merged.toLocalIterator():  # one segment at a time; all together ROWS * 2**bits / 8 bytes
        out[r["segment"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.reshape(ROWS, -1)


def cell_bits(docs: DataFrame, shape: Shape) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = CELLS_PER_ANCHOR * size / shape.bytes_per_anchor
    return int(np.clip(np.ceil(np.log2(cells + 1)), MIN_CELL_BITS, MAX_CELL_BITS))


def repeated_runs(docs: DataFrame, shape: Shape) -> DataFrame:
    """Runs under anchors that may repeat, staged: doc_id, lo, n, place, key, c, flank.

    ``flank`` holds the run's units before and after the anchor, ``c`` is the
    hash of all units of the run.
    """
    bits = cell_bits(docs, shape)
    seen = docs.sparkSession.sparkContext.broadcast(sketch(docs, shape, bits))

    def emit(batches):
        marks = seen.value
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for row, data, offsets in text_groups(b.column("text")):
                units = Batch(data, offsets, shape.words)
                for run in units.runs(shape):
                    keep = np.ones(len(run["key"]), dtype=bool)
                    for r in range(ROWS):
                        cell = _cells(run["key"], r, bits)
                        keep &= (marks[r][(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    if not keep.any():
                        continue
                    doc, lo, n, place = (run[c][keep] for c in ("doc", "lo", "n", "place"))
                    flanks = [units.flank(d, a, a + p) + b"\n" + units.flank(d, a + p + shape.k, a + w - 1 + shape.m)
                              for d, a, w, p in zip(doc.tolist(), lo.tolist(), n.tolist(), place.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[row + doc]), pa.array(lo), pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32)),
                         pa.array(run["key"][keep].view(np.int64)), pa.array(run["c2"][keep].view(np.int64)),
                         pa.array(flanks, pa.binary())], ["doc_id", "lo", "n", "place", "key", "c", "flank"])

    runs = stage(map_arrow(docs, emit, "doc_id long, lo long, n int, place int, key long, c long, flank binary"))
    seen.destroy()  # the runs are written; a worker keeps no copy of the table either
    return runs


CLASS = ["key", "place", "n", "c"]


def classes(runs: DataFrame) -> DataFrame:
    """Equal runs with ``members`` (rows), ``first_id`` (smallest id) and ``rivals``.

    ``rivals`` counts the classes under the same anchor, this one included; with
    one, nothing is left to settle. Aggregation combines map-side, so copies by
    the thousand shuffle once a task.
    """
    groups = stage(runs.groupBy(*CLASS, "flank").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first_id"),
                                                     F.min("lo").alias("lo")))
    # staged, so that Spark can split the join where one anchor has very many classes
    rivals = stage(groups.groupBy("key").agg(F.count(F.lit(1)).alias("rivals")).where("rivals > 1"))
    return groups.join(rivals, "key", "left").withColumn("rivals", F.coalesce("rivals", F.lit(1)))


def split_flank(flank: bytes, place: int, words: bool) -> tuple[bytes, bytes]:
    if words:
        left, _, right = flank.partition(b"\n")
        return left, right
    return flank[:place], flank[place + 1:]


def exact_windows(runs: DataFrame, shape: Shape, *carry: str) -> DataFrame:
    """One row per window of the given runs: ``doc_id``, ``at``, and (``key``, ``w1``, ``w2``) that equal windows share.

    The two hashes cover the window's units without the anchor, which ``key``
    stands for, and the anchor's place in it. ``carry`` names further long
    columns to repeat.
    """
    size = shape.m - shape.k

    def emit(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                doc, lo, n, place, key = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                          for c in ("doc_id", "lo", "n", "place", "key"))
                sides = [b"\n".join(split_flank(f, p, True)) if shape.words else b"".join(split_flank(f, p, False))
                         for f, p in zip(part.column("flank").to_pylist(), place.tolist(), strict=True)]
                data = np.frombuffer(b"".join(sides), dtype=np.uint8)
                units = Batch(data, np.r_[0, np.cumsum([len(s) for s in sides])], shape.words)
                values = units.values if shape.words else A.BYTE_VALUE[data]
                row = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = units.base[row] + step
                where = A.mix((place[row] - step).astype(np.uint64) + np.uint64(1))
                hashes = [A.mix(A.Rolling(values, w).at(start, start + size) ^ where).view(np.int64) for w in (0, 1)]
                more = [part.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[row] for c in carry]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[row], lo[row] + step, key[row], *hashes, *more)],
                                                 ["doc_id", "at", "key", "w1", "w2", *carry])

    rows = runs.select("doc_id", "lo", "n", "place", "key", "flank", *carry)
    schema = ", ".join(f"{c} long" for c in ("doc_id", "at", "key", "w1", "w2", *carry))
    return map_arrow(rows.repartition(shuffle_partitions(runs.sparkSession)), emit, schema)


def removed_spans(spans: DataFrame) -> DataFrame:
    """Per document, its list of (start, stop) unit spans; one document's list is bounded by its length."""
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans joined."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > stops[:-1]]
    first = np.flatnonzero(new)
    return starts[first], stops[np.r_[first[1:] - 1, len(starts) - 1]]


def with_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows that take part: a row without an id cannot be named by a span."""
    return id_text(docs, id_col, text_col).where("doc_id IS NOT NULL")


def list_pairs(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the ``i``-th list of a list<struct<start, stop>> column."""
    value = column[i]
    if not value.is_valid or not len(value):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    flat = value.values
    return (flat.field("start").to_numpy(zero_copy_only=False), flat.field("stop").to_numpy(zero_copy_only=False))
