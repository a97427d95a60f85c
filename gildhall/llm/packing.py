"""Best-fit packing with certified bounds.

Pieces are dealt to groups of bounded size and packed best-fit decreasing. A
lower bound from dual-feasible functions certifies a group whose bin count it
meets. Groups with a gap hand the documents of their unfilled bins to each
other under a new dealing and pack them again, as long as bins are saved.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import id_text, map_arrow, ship, stage, worker_cache
from gildhall.llm.pretoken import RUNS, PartCache, text_batches

CAPACITY = 1024
END_ID = 2
#: Pieces a group holds on average; a group is packed by one task.
GROUP_PIECES = 1 << 14
MAX_ROUNDS = 6

_caches: dict[str, PartCache] = worker_cache({})


def byte_ranks(model: dict) -> dict[bytes, int] | None:
    """The ids by bytes, where merging by them is merging by the list: every merge makes a new token, in their order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    vocab = model["vocab"]
    made = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in model["merges"]]
    singles = [vocab.get(c) for c in byte]
    if None in made or None in singles or sorted(set(made)) != made or max(singles) >= made[0] or model.get("ignore_merges"):
        return None
    by_id = {i: t for t, i in vocab.items()}
    return {bytes(byte[c] for c in by_id[i]): i for i in [*sorted(singles), *made]}


def tokenizer_cache(path: str) -> PartCache:
    """Per worker process: ids of text parts by the ``tokenizers`` file at ``path``, added tokens found as it finds them."""
    if path not in _caches:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)

        def encode(batch: list[str]) -> list[bytes]:
            return [struct.pack(f"<{len(e)}I", *e.ids) for e in tok.encode_batch_fast(batch, add_special_tokens=False)]

        # one call for many parts: a token that begins with a space begins a part
        space = tok.encode(" a", add_special_tokens=False).tokens[0][0]
        begins = np.array([(tok.id_to_token(i) or "").startswith(space) for i in range(tok.get_vocab_size())])

        def encode_parts(parts: list[str]) -> list[bytes]:
            out: list[bytes] = []
            for i in range(0, len(parts), 4096):
                some = parts[i:i + 4096]
                ids = np.array(tok.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
                at = np.flatnonzero(begins[ids]) * 4
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip(at.tolist(), [*at[1:].tolist(), len(data)], strict=True)]
            return out

        # a familiar run is one match of the splitting pattern, so only the merges are left to do
        ranks = byte_ranks(json.loads(tok.to_str())["model"])
        piece = ranks and tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        between: dict[str, bytes] = {}  # runs of marks, few and frequent

        def encode_run(run: str) -> bytes:
            if run.isalpha():
                return array("I", piece(run.encode())).tobytes()
            if run not in between:
                if len(between) > 10_000:
                    between.clear()
                between[run] = array("I", piece(run.encode())).tobytes()
            return between[run]

        def encode_words(words: list[str]) -> list[bytes]:
            out = []
            for w in words:
                if w.isalpha():
                    out.append(array("I", piece((" " + w).encode())).tobytes())
                else:
                    first, *rest = RUNS.findall(w)
                    out.append(b"".join([array("I", piece((" " + first).encode())).tobytes(), *map(encode_run, rest)]))
            return out

        added = tok.get_added_tokens_decoder()
        plain = all(not (t.single_word or t.lstrip or t.rstrip or t.normalized) for t in added.values())
        _caches[path] = PartCache(encode, marks=".,", encode_parts=encode_parts, encode_words=encode_words if ranks else None,
                                  added={t.content: struct.pack("<I", i) for i, t in added.items()} if plain else {},
                                  whole=() if plain else tuple(t.content for t in added.values()))
    return _caches[path]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the capacity."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Every document's pieces with a unique ``pid``, staged (token ids only with ``keep_ids``)."""
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"

    def run(batches):
        cache = tokenizer_cache(tokenizer_path)
        for b in batches:
            ids = b.column("doc_id")
            for at, texts in text_batches(b.column("text").to_pylist()):
                rows = []
                for i, coded in enumerate(cache.joined(texts)):
                    view = memoryview(coded + end)
                    doc = ids[at + i].as_py()
                    for k, (start, length) in enumerate(cut(len(view) // 4, capacity)):
                        part = view[4 * start:4 * (start + length)]
                        rows.append((doc, k, start, length, zlib.crc32(part), part.tobytes() if keep_ids else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    out = map_arrow(id_text(docs, id_col, text_col), run, schema).withColumn("pid", F.monotonically_increasing_id())
    return stage(out if keep_ids else out.drop("ids"))


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    The first leaves sizes between t and capacity - t, counts larger ones as
    full and smaller ones as nothing; the second rounds down to multiples of
    1/k. No bin's sizes add up to more than one under any of them.
    """
    if not len(lengths):
        return 0
    n = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    mass, count = np.cumsum(n * size), np.cumsum(n)
    t = np.arange(capacity // 2 + 1)
    below = np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    scaled = (mass[capacity - t] - below) + (count[-1] - count[capacity - t]) * capacity
    best = -(-int(scaled.max()) // capacity)
    for k in range(1, 101):
        whole = (k + 1) * size % capacity == 0
        value = np.where(whole, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((n * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and each bin's free space."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, opened = 0, 0  # bit f: a bin with f free
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some ^= 1 << free
        else:
            free, b = capacity, opened
            opened += 1
        bins[i], offsets[i] = b, capacity - free
        rest = free - size
        by_free[rest].append(b)
        some |= 1 << rest
    left = np.empty(opened, dtype=np.int64)
    for f, held in enumerate(by_free):
        left[held] = f
    return bins, offsets, left


def _pack(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["length"].to_numpy()
        bins, offsets, left = best_fit_decreasing(sizes, capacity)
        gap = len(left) - lower_bound(sizes, capacity)
        return pd.DataFrame({"pid": group["pid"], "length": sizes, "grp": group["grp"], "bin": bins, "offset": offsets,
                             "free": left[bins], "gap": gap})
    return run


PACKED = "pid long, length long, grp long, bin long, offset long, free long, gap long"


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()  # each bin has one piece at its start


def pack(lengths: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pid``, ``grp``, ``bin``, ``offset`` for pieces (``pid``, ``length`` <= capacity)."""
    ship(lengths.sparkSession)
    done: list[DataFrame] = []
    pool, before = lengths.select("pid", "length"), None
    for turn in range(MAX_ROUNDS):
        n = pool.count()
        if not n:
            break
        groups = max(1, -(-n // group_pieces))
        dealt = pool.select("pid", "length", (F.pmod(F.xxhash64("pid", F.lit(turn)), F.lit(groups)) + F.lit(turn << 40)).alias("grp"))
        packed = stage(dealt.groupBy("grp").applyInPandas(_pack(capacity), PACKED))
        if before is not None and _bins(packed) >= _bins(before):
            break  # nothing saved: the earlier bins stand
        open_ = packed.where("gap > 0 AND free > 0")
        done.append(packed.where("NOT (gap > 0 AND free > 0)"))
        before = open_
        if groups == 1:
            break
        pool = open_.select("pid", "length")
    if before is not None:
        done.append(before)
    out = done[0] if done else dealt_empty(lengths)
    for d in done[1:]:
        out = out.union(d)
    return out.select("pid", "grp", "bin", "offset")


def dealt_empty(lengths: DataFrame) -> DataFrame:
    return lengths.sparkSession.createDataFrame([], PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of all documents with their place in a sequence of at most ``capacity`` tokens.

    A document is its ids and ``end_id``; a null or empty text is the end id
    alone. Only documents over the capacity are cut. Returns ``doc_id``,
    ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` (and ``ids`` with ``keep_ids``). Rows with a null id and rows that
    repeat an id are packed like any other. An empty table gives an empty
    result; other columns are ignored.
    """
    cut_up = pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, keep_ids)
    full = cut_up.where(F.col("length") == capacity).withColumn("sequence_id", F.col("pid") * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    small = cut_up.where(F.col("length") < capacity)
    placed = pack(small, capacity, group_pieces)
    numbered = stage(placed.where("offset = 0").select("grp", "bin", (F.monotonically_increasing_id() * 2).alias("sequence_id")))
    small = small.join(placed.join(numbered, ["grp", "bin"]).select("pid", "sequence_id", "offset"), "pid")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if keep_ids else [])
    return full.select(*columns).union(small.select(*columns))
