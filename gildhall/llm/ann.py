"""Nearest neighbours by inner product over shifted space-filling curves.

Equal vectors are one class, placed and met once; what is found of a class is
its smallest ids. Vectors are laid on the sphere where the nearest by distance is the largest by
inner product (one more coordinate fills every candidate up to the longest
norm). Each curve projects them to a few dimensions of its own, levels each by
the quantiles of a bounded sample, shifts them, and orders them along a
Hilbert curve. Spark range-partitions and numbers every curve; a class with
queries meets the blocks of classes around its own place on each. Every meeting
is reranked by the exact inner product, the curves' findings merge, and each
query takes its class's, without itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import map_arrow, shuffle_partitions, stage
from gildhall.operators.sequence import ordinal

CURVES = 16
DIMS = 4
BITS = 8
#: Classes of a block, the unit that a task reranks.
BLOCK = 1024
#: Share of the classes around its place that a query meets on each curve, and the least number of them.
WINDOW_SHARE = 0.08
WINDOW_ROWS = 2048
#: Queries that are scored against a block at a time.
ASKS = 1024
#: Classes that a task collects before it hands them on.
HELD = 20_000
#: Bound of the sample that the quantiles are read from.
SAMPLE = 20_000
SEED = 11


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (integers below 2**bits; rows × dims * bits <= 64)."""
    axes = [c.astype(np.uint64) for c in cells.T]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(level), (one << np.uint64(level)) - one
        for i in range(len(axes)):
            set_ = (axes[i] >> bit) & one == 1
            swap = np.where(set_, np.uint64(0), (axes[0] ^ axes[i]) & low)
            first = axes[0] ^ np.where(set_, low, swap)
            if i:
                axes[i] = axes[i] ^ swap
            axes[0] = first
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((axes[-1] >> np.uint64(level)) & one == 1, flip ^ ((one << np.uint64(level)) - one), flip)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << one) | (((a ^ flip) >> np.uint64(level)) & one)
    return key


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Staged ``vec_id``, ``v`` (doubles as bytes), ``norm2``: the rows that take part, one for each id."""
    clean = (table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
             .where("vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
             .where("forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('infinity')) AND exists(x, e -> e <> 0)"))

    def pack(batches):
        for b in batches:
            lists = [np.array(x, dtype=np.float64) + 0.0 for x in b.column("x").to_pylist()]  # -0.0 becomes 0.0, so equal vectors have equal bytes
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array([x.tobytes() for x in lists], pa.binary()), pa.array([float(x @ x) for x in lists], pa.float64()),
                 pa.array([len(x) for x in lists], pa.int32())], ["vec_id", "v", "norm2", "dims"])

    return stage(map_arrow(clean.dropDuplicates(["vec_id"]), pack, "vec_id long, v binary, norm2 double, dims int"))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """Staged ``rep``, ``v``, ``norm2``, ``ask``, ``ids``: equal vectors as one row, with the ``k`` smallest ids (int64 as bytes).

    ``rep`` is the smallest id; ``ask`` tells whether any row is a query. Tasks
    class their own rows first, so a vector that a third of the rows share is
    shuffled once for each of them.
    """

    def partial(batches):
        held = {}

        def rows_of():
            ids = pa.array([np.sort(i).tolist() for i, _, _ in held.values()], pa.list_(pa.int64()))
            _, norm2, ask = zip(*held.values(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(norm2, pa.float64()), pa.array(ask, pa.bool_()), ids],
                                              ["v", "norm2", "ask", "ids"])

        for b in batches:
            for vec_id, v, norm2, ask in zip(*(b.column(c).to_pylist() for c in ("vec_id", "v", "norm2", "ask")), strict=True):
                if v not in held:
                    if len(held) >= HELD:
                        yield rows_of()
                        held.clear()
                    held[v] = ([vec_id], norm2, ask)
                    continue
                ids, _, before = held[v]
                ids.append(vec_id)
                if len(ids) >= 4 * k:
                    ids.sort()
                    del ids[k:]
                held[v] = (ids, norm2, before or ask)
        if held:
            yield rows_of()

    parts = map_arrow(rows.select("vec_id", "v", "norm2", "ask"), partial, "v binary, norm2 double, ask boolean, ids array<long>")
    whole = (parts.select("v", "norm2", "ask", F.slice("ids", 1, k).alias("ids"))
             .groupBy("v").agg(F.first("norm2").alias("norm2"), F.max("ask").alias("ask"), F.collect_list("ids").alias("ids"))
             .select("v", "norm2", "ask", F.slice(F.array_sort(F.flatten("ids")), 1, k).alias("ids")))

    def pack(batches):
        for b in batches:
            ids = b.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([i[0] for i in ids], pa.int64()), b.column("v"), b.column("norm2"), b.column("ask"),
                 pa.array([np.array(i, dtype=np.int64).tobytes() for i in ids], pa.binary())], ["rep", "v", "norm2", "ask", "ids"])

    return stage(map_arrow(whole, pack, "rep long, v binary, norm2 double, ask boolean, ids binary"))


def _matrix(column: pa.Array) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), dtype=np.float64).reshape(len(blobs), -1)


class Curves:
    """Projections, quantiles and shifts of all curves."""

    def __init__(self, sample: np.ndarray, longest2: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.longest2 = longest2
        dims = min(DIMS, sample.shape[1] + 1)
        self.turn = [np.linalg.qr(rng.normal(size=(sample.shape[1] + 1, dims)))[0] for _ in range(CURVES)]
        self.shift = rng.random((CURVES, dims))
        lifted = self.lift(sample, False)
        self.levels = [np.quantile(lifted @ t, np.linspace(0, 1, 257), axis=0) for t in self.turn]

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm2 = (x * x).sum(axis=1, keepdims=True)
        if query:
            return np.hstack([x * np.sqrt(self.longest2 / norm2), np.zeros_like(norm2)])
        return np.hstack([x, np.sqrt(np.maximum(self.longest2 - norm2, 0))])

    def keys(self, x: np.ndarray, query: bool) -> list[np.ndarray]:
        lifted, out = self.lift(x, query), []
        for turn, shift, levels in zip(self.turn, self.shift, self.levels, strict=True):
            flat = lifted @ turn
            even = np.stack([np.interp(flat[:, i], levels[:, i], np.linspace(0, 1, 257)) for i in range(flat.shape[1])], axis=1)
            cells = np.minimum((even + shift) / 2 * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
            out.append(hilbert(cells, BITS).view(np.int64))
        return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` largest scores, ties to the smaller id, in that order."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _near(scores: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Indices of all scores that may be among the ``k`` largest when each may be off by ``slack``."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - 2 * slack)


def _rerank(batches, k: int):
    """Classes sorted by (curve, block), candidates before queries: the best ``k`` ids of the block for each class that asks.

    A task holds one block's candidates and ``ASKS`` queries at most, however
    many meet the block.
    """

    def done(cand, asks):
        reps, members, x, longest = cand
        q = np.frombuffer(b"".join(a[1] for a in asks), dtype=np.float64).reshape(len(asks), -1)
        rounding = x.shape[1] * np.finfo(np.float64).eps * longest * np.sqrt((q * q).sum(axis=1))
        scores = q @ x.T
        out = []
        for i, ask in enumerate(asks):
            some = _near(scores[i], k, rounding[i])
            # summed row by row: a pair has the same score in every block, and equal products tie
            s = (x[some] * q[i]).sum(axis=1)
            top = _best(reps[some], s, k)
            top = top[np.isfinite(s[top])]
            found = [members[j] for j in some[top]]
            ids, s = np.concatenate([*found, np.array([], dtype=np.int64)]), np.repeat(s[top], [len(f) for f in found])
            order = np.lexsort((ids, -s))[:k]
            out.append((ask[0], ids[order].tobytes(), s[order].tobytes()))
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                                          ["rep", "ids", "scores"])

    def candidates(rows):
        x = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.float64).reshape(len(rows), -1)
        return np.array([r[0] for r in rows]), [np.frombuffer(r[2], dtype=np.int64) for r in rows], x, np.sqrt((x * x).sum(axis=1).max())

    rows, cand, asks, last = [], None, [], None
    for b in batches:
        for curve, block, ask, *row in zip(*(b.column(c).to_pylist() for c in ("curve", "block", "ask", "rep", "v", "ids")), strict=True):
            if (curve, block) != last:
                if asks:
                    yield done(cand, asks)
                rows, cand, asks, last = [], None, [], (curve, block)
            if not ask:
                rows.append(row)
            elif rows or cand:
                if rows:
                    cand, rows = candidates(rows), []
                asks.append(row)
                if len(asks) >= ASKS:
                    yield done(cand, asks)
                    asks = []
    if asks:
        yield done(cand, asks)


def _merge(batches, k: int):
    """Findings sorted by the class that asked: the best ``k`` of all, each candidate once, best first."""

    def done(rep, ids, scores):
        ids, scores = np.frombuffer(b"".join(ids), dtype=np.int64), np.frombuffer(b"".join(scores), dtype=np.float64)
        ids, first = np.unique(ids, return_index=True)
        scores = scores[first]
        top = _best(ids, scores, k)
        return rep, ids[top].tobytes(), scores[top].tobytes()

    def rows(found):
        cols = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                                          ["rep", "ids", "scores"])

    found, ids, scores, last = [], [], [], None
    for b in batches:
        for rep, i, s in zip(*(b.column(c).to_pylist() for c in ("rep", "ids", "scores")), strict=True):
            if last is not None and rep != last:
                found.append(done(last, ids, scores))
                ids, scores = [], []
                if len(found) >= 1024:
                    yield rows(found)
                    found = []
            last = rep
            ids.append(i)
            scores.append(s)
    if last is not None:
        found.append(done(last, ids, scores))
        yield rows(found)


def _answers(batches, k: int):
    """Each query's ``k`` best out of its class's findings, without itself."""
    names = ["query_id", "rank", "vec_id", "score"]
    for b in batches:
        out = [[], [], [], []]
        for query, i, s in zip(*(b.column(c).to_pylist() for c in ("vec_id", "ids", "scores")), strict=True):
            ids, scores = np.frombuffer(i, dtype=np.int64), np.frombuffer(s, dtype=np.float64)
            top = np.flatnonzero(ids != query)[:k]
            for o, v in zip(out, (np.full(len(top), query), np.arange(1, len(top) + 1, dtype=np.int32), ids[top], scores[top]), strict=True):
                o.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names)


NEIGHBOURS = "query_id long, rank int, vec_id long, score double"


def nearest(table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            share: float = WINDOW_SHARE) -> DataFrame:
    """The ``k`` rows found with the largest inner product for every row where ``is_query`` (a Column over ``vec_id``).

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (inner product
    of the original vectors in double precision); ties go to the smaller id, and
    a row is no neighbour of itself. A query with fewer than ``k`` candidates
    gets them all. Rows with a null id, a null, empty or zero vector, or one that
    holds a null or non-finite component, take no part, nor do vectors of
    another length than most; rows that repeat an id count once. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = table.sparkSession
    rows = vectors(table, id_col, vec_col)
    usual = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    if usual is None:
        return spark.createDataFrame([], NEIGHBOURS)
    rows = rows.where(F.col("dims") == usual["dims"]).withColumn("ask", F.coalesce(is_query, F.lit(False)))
    # a query may find itself, so its class looks for one more
    same = classes(rows, k + 1)
    size = same.agg(F.count(F.lit(1)).alias("n"), F.count_if("ask").alias("q"), F.max("norm2").alias("longest2")).first()
    fraction = min(1.0, 0.8 * SAMPLE / size["n"])
    sample = same.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < max(1, round(fraction * (1 << 20)))).select("v").limit(SAMPLE).collect()
    if not sample:
        sample = same.select("v").limit(SAMPLE).collect()
    curves = spark.sparkContext.broadcast(
        Curves(np.frombuffer(b"".join(r["v"] for r in sample), dtype=np.float64).reshape(len(sample), -1), size["longest2"]))

    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, ids = _matrix(b.column("v")), b.column("rep").to_numpy()
            chosen = b.column("ask").to_numpy(zero_copy_only=False).astype(bool)
            for ask, part, mine in ((0, x, ids), (1, x[chosen], ids[chosen])):
                if len(mine):
                    for c, key in enumerate(curves.value.keys(part, bool(ask))):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(mine), c, dtype=np.int32)), pa.array(key), pa.array(mine), pa.array(np.full(len(mine), ask, dtype=np.int32))],
                            ["curve", "key", "rep", "ask"])

    placed = map_arrow(same.select("rep", "v", "ask"), place, "curve int, key long, rep long, ask int")
    numbered = ordinal(placed, ["curve"], ["key", "rep", "ask"], name="rn")
    # the count of places on a curve fixes how many blocks a window spans
    total = size["n"] + size["q"]
    reach = int(np.ceil(max(share * total, min(WINDOW_ROWS, total)) / 2 / BLOCK))
    last = (total - 1) // BLOCK
    block = F.floor((F.col("rn") - 1) / BLOCK)
    spread = numbered.select("curve", "rep", "ask", F.when(
        F.col("ask") == 1, F.sequence(F.greatest(block - reach, F.lit(0)), F.least(block + reach, F.lit(last)))).otherwise(F.array(block)).alias("blocks"))
    met = (spread.select("curve", "rep", "ask", F.explode("blocks").alias("block"))
           .join(same.select("rep", "v", "ids"), "rep").select("curve", "block", "ask", "rep", "v", F.when(F.col("ask") == 0, F.col("ids")).alias("ids"))
           .repartition(shuffle_partitions(spark), "curve", "block").sortWithinPartitions("curve", "block", "ask", "rep"))
    found = map_arrow(met, lambda batches: _rerank(batches, k + 1), "rep long, ids binary, scores binary")
    merged = found.repartition(shuffle_partitions(spark), "rep").sortWithinPartitions("rep")
    # staged, so that Spark can split the joins below: a third of the queries may be of one class
    best = stage(map_arrow(merged, lambda batches: _merge(batches, k + 1), "rep long, ids binary, scores binary"))
    found = stage(best.join(same.select("rep", "v"), "rep").select("v", "ids", "scores"))
    answers = rows.where("ask").select("vec_id", "v").join(found, "v").select("vec_id", "ids", "scores")
    return map_arrow(answers, lambda batches: _answers(batches, k), NEIGHBOURS)
