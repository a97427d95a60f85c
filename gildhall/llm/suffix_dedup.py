"""Suffix-array deduplication: byte strings that start more than once.

Classes of equal runs (see ``repeats``) settle most windows. Where runs share
an anchor but differ around it, tasks gather whole anchor groups, deal their
contexts to shards, build each shard's Burrows-Wheeler transform, and merge
the transforms by refining their interleave: one pass over the transforms
sorts all suffixes by one symbol more. The passes also tell which neighbours
still share their prefix; after a window's length of passes, intervals of two
or more suffixes are the repeated windows. No suffix is sorted again.

Within a context the anchor counts as one symbol, so a pass for each byte
around it is enough.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import id_text, map_arrow, shuffle_partitions, stage
from gildhall.llm.repeats import (
    CLASS, Shape, classes, exact_windows, list_pairs, merged_spans, removed_spans, repeated_runs, with_id,
)

LENGTH = 200
ANCHOR = 128
SHARDS = 2
#: Symbols that a task merges at a time (whole anchor groups).
GATHER = 1 << 18
#: Anchor groups with more classes than this are settled window by window in Spark instead of in one task.
GROUP_CLASSES = 1 << 11


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``symbols`` sorted by their first ``depth`` symbols (prefix doubling)."""
    n = len(symbols)
    rank = symbols.astype(np.uint64)
    step = 1
    while True:
        ahead = np.zeros(n, dtype=np.uint64)
        ahead[:n - step] = rank[step:] + np.uint64(1)
        pair = (rank << np.uint64(32)) | ahead
        order = np.argsort(pair, kind="stable")
        sorted_ = pair[order]
        new = np.empty(n, dtype=np.uint64)
        new[order] = np.cumsum(np.r_[False, sorted_[1:] != sorted_[:-1]]).astype(np.uint64)
        rank, step = new, 2 * step
        if step >= depth or int(rank.max(initial=0)) == n - 1:
            return order


class Shard:
    """Suffix order and Burrows-Wheeler transform of strings that each end with the symbol 0."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.order = suffix_order(symbols, depth)
        self.bwt = np.roll(symbols, 1)[self.order]  # before a string's first symbol stands the last one's end


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes and, for each place, its interval of equal prefixes of ``depth`` symbols.

    A pass reads the transforms along the interleave, and deals the places
    stably by the symbol before them: suffixes sorted by h symbols become
    suffixes sorted by h + 1. Places whose symbol is 0 step over a string's
    start; the end symbols they would lead to sort first and stay in shard order.
    """
    sizes = [len(s.bwt) for s in shards]
    ends = [int((s.bwt == 0).sum()) for s in shards]
    first = np.repeat(np.arange(len(shards), dtype=np.uint8), ends)
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    interval = np.zeros(len(source), dtype=np.int32)
    symbol = np.empty(len(source), dtype=np.uint16)
    for _ in range(depth):
        for k, s in enumerate(shards):
            symbol[source == k] = s.bwt
        to = np.argsort(symbol, kind="stable")[len(first):]
        sorted_symbol, sorted_interval = symbol[to], interval[to]
        new = np.empty(len(source), dtype=bool)
        new[:len(first)] = False
        new[len(first)] = True
        new[len(first) + 1:] = (sorted_symbol[1:] != sorted_symbol[:-1]) | (sorted_interval[1:] != sorted_interval[:-1])
        source = np.r_[first, source[to]]
        interval = np.cumsum(new, dtype=np.int32)
    return source, interval


def repeated_starts(contexts: list[np.ndarray], windows: np.ndarray, depth: int, shards: int = SHARDS) -> np.ndarray:
    """For all window starts of all contexts, in order: whether another window has the same ``depth`` symbols.

    ``contexts`` are symbol arrays without the end symbol; the first
    ``windows[i]`` positions of context ``i`` start a window.
    """
    if len(contexts) < shards:
        shards = 1
    offset = np.r_[0, np.cumsum(windows)]
    out = np.zeros(offset[-1], dtype=bool)
    parts, places = [], []
    for k in range(shards):
        chosen = range(k, len(contexts), shards)
        text = np.concatenate([x for i in chosen for x in (contexts[i], np.zeros(1, dtype=np.uint16))])
        slot = np.concatenate([x for i in chosen for x in (
            np.arange(offset[i], offset[i + 1]), np.full(len(contexts[i]) + 1 - windows[i], -1))])
        parts.append(Shard(text, depth))
        places.append(slot)
    source, interval = merge(parts, depth)
    many = np.bincount(interval)[interval] > 1
    # windows only: other suffixes end before the depth and share no interval with one
    for k, part in enumerate(parts):
        slot = places[k][part.order]
        real = slot >= 0
        out[slot[real]] = many[source == k][real]
    return out


def _settle(batches, shape: Shape):
    """Repeated windows of the contexts that stand alone in their class, as (doc_id, start, stop)."""
    depth = shape.m - shape.k + 1

    def done(rows):
        contexts, windows = [], np.array([r[3] for r in rows])
        number: dict[int, int] = {}
        for key, _, _, _, place, _, flank in rows:
            anchor = number.setdefault(key, 256 + len(number) + 1)
            data = np.frombuffer(flank, dtype=np.uint8).astype(np.uint16) + 1
            data[place] = anchor  # where the flank's separator stands
            contexts.append(data)
        hit = repeated_starts(contexts, windows, depth)
        at = np.cumsum(windows) - windows
        starts, stops, ids = [], [], []
        for i, (_, doc, lo, n, _, members, _) in enumerate(rows):
            if members > 1:
                continue
            mine = hit[at[i]:at[i] + n]
            edge = np.flatnonzero(np.diff(np.r_[False, mine, False]))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                ids.append(doc)
                starts.append(lo + a)
                stops.append(lo + b - 1 + shape.m)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, starts, stops)], ["doc_id", "start", "stop"])

    held, size, last = [], 0, None
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("key", "first_id", "lo", "n", "place", "members", "flank")), strict=True):
            if row[0] != last and size >= GATHER:
                yield done(held)
                held, size = [], 0
            last = row[0]
            held.append(row)
            size += len(row[6])
    if held:
        yield done(held)


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group_classes: int = GROUP_CLASSES) -> DataFrame:
    """``doc_id``, ``start``, ``stop``: byte spans covered by strings of ``length`` bytes that start more than once."""
    shape = Shape(length, anchor, words=False)
    runs = repeated_runs(docs, shape)
    groups = stage(classes(runs).where("members > 1 OR rivals > 1"))
    whole = (runs.select(*CLASS, "doc_id", "lo").join(groups.where("members > 1").select(*CLASS), CLASS)
             .select("doc_id", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + length).alias("stop")))
    open_ = groups.where("rivals > 1")
    near = (open_.where(F.col("rivals") <= group_classes).select("key", "first_id", "lo", "n", "place", "members", "flank")
            .repartition(shuffle_partitions(docs.sparkSession), "key").sortWithinPartitions("key"))
    merged = map_arrow(near, lambda batches: _settle(batches, shape), "doc_id long, start long, stop long")
    # a group of unbounded size never goes to one task: its windows are grouped by their hashes
    far = stage(exact_windows(open_.where(F.col("rivals") > group_classes).withColumn("doc_id", F.col("first_id")), shape, "members"))
    twice = far.groupBy("key", "w1", "w2").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    single = (far.where("members = 1").join(twice, ["key", "w1", "w2"], "left_semi")
              .select("doc_id", F.col("at").alias("start"), (F.col("at") + length).alias("stop")))
    return whole.union(merged).union(single)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, keep: bool = True) -> DataFrame:
    """Every row of ``docs`` without the bytes that repeated strings cover.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` and, with ``keep``, ``kept`` (binary: a span may end
    within a character). Strings are judged on the input, and every occurrence
    goes, the first included. A null text is empty; a text shorter than
    ``length`` loses nothing. A row without an id loses nothing and removes
    nothing. Rows that repeat an id must repeat its text; they are copies like
    any other. An empty table gives an empty result; other columns are ignored.
    """
    spans = removed_spans(repeated_spans(with_id(docs, id_col, text_col), length, anchor))

    def cut(batches):
        for b in batches:
            lists, rows = b.column("spans"), []
            for i, t in enumerate(b.column("text")):
                data = t.as_py().encode()
                starts, stops = list_pairs(lists, i)
                if len(starts):
                    starts, stops = merged_spans(starts, stops)
                    edges = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(data)]
                    kept = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                else:
                    kept = data
                rows.append((len(data), len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept if keep else None))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
            out = [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep:
                out, names = [*out, pa.array(cols[4], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep else "")
    return map_arrow(id_text(docs, id_col, text_col).join(spans, "doc_id", "left"), cut, schema)
