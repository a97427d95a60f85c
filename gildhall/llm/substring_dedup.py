"""Substring deduplication: word windows that an earlier document has.

A count-min sketch over the windows' anchors, merged from the partitions'
sketches, overestimates how often windows occur; a second pass writes out and
exactly groups only windows estimated repeated. The sketch never
underestimates, so none is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import id_text, map_arrow, stage, word_blocks
from gildhall.llm.repeats import (
    CLASS, Shape, classes, exact_windows, list_pairs, merged_spans, removed_spans, repeated_runs, with_id,
)

WINDOW = 50
ANCHOR = 30


def earlier_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``start``, ``stop``: word spans covered by windows that a document with a smaller id has too."""
    shape = Shape(window, anchor, words=True)
    runs = repeated_runs(docs, shape)
    groups = classes(runs).where("members > 1 OR rivals > 1")
    told = stage(runs.select(*CLASS, "doc_id", "lo").join(
        groups.select(*CLASS, "first_id", "rivals", F.when(F.col("rivals") > 1, F.col("flank")).alias("flank")), CLASS)
        .where("doc_id > first_id OR rivals > 1"))
    # a run that an earlier document has as a whole
    later = (told.where("doc_id > first_id")
             .select("doc_id", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + window).alias("stop")))
    # the first document of a class may still share single windows with another class under its anchor
    open_ = told.where("doc_id = first_id")
    each = stage(exact_windows(open_, shape))
    first = (each.groupBy("key", "w1", "w2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
             .where("first_id < last_id"))
    single = (each.join(first.drop("last_id"), ["key", "w1", "w2"]).where("doc_id > first_id")
              .select("doc_id", F.col("at").alias("start"), (F.col("at") + window).alias("stop")))
    return later.union(single)


def kept_words(text: str, starts: np.ndarray, stops: np.ndarray) -> tuple[int, int, list[bytes]]:
    """Words, removed words and the kept words joined by one space, in pieces."""
    n = removed = 0
    pieces: list[bytes] = []
    for words in word_blocks(text.encode()):
        lo, hi = n, n + len(words)
        n = hi
        if len(starts):
            i = int(np.searchsorted(stops, lo, side="right"))
            kept, at = [], lo
            while i < len(starts) and starts[i] < hi:
                a, b = max(int(starts[i]), lo), min(int(stops[i]), hi)
                kept += words[at - lo:a - lo]
                removed += b - a
                at = b
                i += 1
            words = kept + words[at - lo:]
        if words:
            pieces.append(b" ".join(words))
    return n, removed, pieces


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR) -> DataFrame:
    """Every row of ``docs`` without the words that an earlier document's windows cover.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (kept words
    joined by one space) and ``kept_text`` (the same, but the text as it was
    where nothing goes). Windows are judged on the input.
    A null text has no words; a text of fewer than ``window`` words loses
    nothing. A row without an id has no place in the order: it loses nothing
    and removes nothing. Rows that repeat an id repeat one document and get
    equal results. An empty table gives an empty result; other columns are
    ignored.
    """
    spans = removed_spans(earlier_spans(with_id(docs, id_col, text_col), window, anchor))

    def cut(batches):
        for b in batches:
            lists = b.column("spans")
            rows = []
            for i, t in enumerate(b.column("text")):
                starts, stops = list_pairs(lists, i)
                if len(starts):
                    starts, stops = merged_spans(starts, stops)
                n, removed, pieces = kept_words(t.as_py(), starts, stops)
                kept = b" ".join(pieces)
                rows.append((n, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if removed else t.as_py()))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return map_arrow(id_text(docs, id_col, text_col).join(spans, "doc_id", "left"), cut,
                     "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
