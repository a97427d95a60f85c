"""SimHash near-duplicates by a self-join over a binary trie of fingerprints.

Any two fingerprints within three bits agree on at least one of their four
16-bit blocks, so the fingerprints are dealt four times, each time rotated to
bring one block to the top: the trie nodes at depth 16 are the shuffle keys.
A node with more than ``NODE_ROWS`` fingerprints is opened further before the
shuffle, until no child has more; each pair of its children whose prefixes
differ by at most three bits is one key. Below that, tasks walk pairs of trie nodes together, add up
differing bits and drop a pair once it exceeds the budget. A task returns a
spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import id_text, map_arrow, shuffle_partitions, stage, word_blocks
from gildhall.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42

BLOCKS, BLOCK_BITS = 4, 16
#: Most fingerprints below a trie node that one task walks; larger nodes are opened.
NODE_ROWS = 1 << 16
MAX_OPEN = 20
#: Fingerprints a task gathers before it walks them; whole nodes only.
BUFFER_ROWS = 1 << 17
#: Node pairs with at most this many fingerprint pairs are compared directly.
LEAF_PAIRS = 64
FRONTIER = 1 << 19

BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; fewer words than ``size`` make one shingle."""
    parts, carry = [], []
    for words in word_blocks(text.encode().lower()):
        words = carry + words
        if len(words) >= size:
            grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
            parts.append(np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), dtype=np.uint64))
            carry = words[len(words) - size + 1:]
        else:
            carry = words
    if not parts and carry:
        return np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], dtype=np.uint64)
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Fingerprints: a bit is set where over half of a text's hashes set it."""
    sizes = np.array([len(h) for h in hashes])
    every = np.concatenate(hashes) if len(hashes) else np.zeros(0, dtype=np.uint64)
    row = np.repeat(np.arange(len(hashes)) * 256, sizes)
    octets = every.view(np.uint8).reshape(-1, 8)
    out = np.zeros((len(hashes), 64), dtype=np.uint8)
    for k in range(8):
        counts = np.bincount(row + octets[:, k], minlength=len(hashes) * 256).reshape(-1, 256)
        out[:, 8 * k:8 * k + 8] = (counts @ BITS_OF_BYTE) * 2 > sizes[:, None]
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the 64-bit fingerprint ``fp`` of every row; a text without words has fingerprint 0."""

    def run(batches):
        for b in batches:
            prints, held, size = [], [], 0
            for t in b.column("text"):
                held.append(shingle_hashes(t.as_py()))
                size += len(held[-1])
                if len(held) >= 256 or size >= 1 << 19:
                    prints.append(majority(held))
                    held, size = [], 0
            prints.append(majority(held) if held else np.zeros(0, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate(prints).view(np.int64))],
                                             ["doc_id", "fp"])

    return map_arrow(id_text(docs, id_col, text_col), run, "doc_id long, fp long")


def _split(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """First index of each sorted range whose value has ``bit`` set."""
    a, b = lo.copy(), hi.copy()
    while True:
        open_ = a < b
        if not open_.any():
            return a
        mid = (a + b) >> 1
        set_ = (x[np.minimum(mid, len(x) - 1)] & bit) != 0
        b = np.where(open_ & set_, mid, b)
        a = np.where(open_ & ~set_, mid + 1, a)


def _join_root(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        p, q = parent[i], parent[j]
        apart = p != q
        if not apart.any():
            return parent
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def walk(x: np.ndarray, pairs: tuple[np.ndarray, ...], budget: int = MAX_BITS) -> np.ndarray:
    """Roots (smallest index reached) of the values of ``x`` linked below the given node pairs.

    A node is a range of ``x`` in which the values are sorted and share their
    bits above ``depth``. ``pairs`` is (a_lo, a_hi, b_lo, b_hi, differing bits,
    depth); a pair with equal ranges joins a node with itself.
    """
    parent = np.arange(len(x))
    todo = [pairs]
    while todo:
        al, ah, bl, bh, err, depth = todo.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            todo += [tuple(c[:half] for c in (al, ah, bl, bh, err, depth)),
                     tuple(c[half:] for c in (al, ah, bl, bh, err, depth))]
            continue
        size = (ah - al) * (bh - bl)
        leaf = (size <= LEAF_PAIRS) | (depth >= 64)
        if leaf.any():
            n, wide = size[leaf], (bh - bl)[leaf]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(wide, n)
            i, j = np.repeat(al[leaf], n) + at // wide, np.repeat(bl[leaf], n) + at % wide
            near = (i < j) & (np.bitwise_count(x[i] ^ x[j]) <= budget)
            if near.any():
                parent = _join_root(parent, i[near], j[near])
        rest = ~leaf
        if not rest.any():
            continue
        al, ah, bl, bh, err, depth = (c[rest] for c in (al, ah, bl, bh, err, depth))
        bit = np.uint64(1) << (63 - depth).astype(np.uint64)
        am, bm = _split(x, al, ah, bit), _split(x, bl, bh, bit)
        self_ = (al == bl) & (ah == bh)
        kids = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1),
                (am, ah, np.where(self_, bm, bl), bm, err + 1)]  # of a node with itself, one mixed pair is enough
        cols = [np.concatenate([k[c] for k in kids]) for c in range(5)] + [np.tile(depth + 1, 4)]
        live = (cols[0] < cols[1]) & (cols[2] < cols[3]) & (cols[4] <= budget)
        if live.any():
            todo.append(tuple(c[live] for c in cols))
    return parent


def _links(batches, budget: int):
    def done(key, depth, x, rep):
        key, depth, x, rep = (np.concatenate(c) for c in (key, depth, x, rep))
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lo, hi = cut, np.r_[cut[1:], len(key)]
        mask = (1 << MAX_OPEN) - 1
        left, right, opened = (key[cut] >> MAX_OPEN) & mask, key[cut] & mask, depth[cut].astype(np.int64)
        # the rows of a mixed pair are sorted, so its first node ends where the lowest differing prefix bit turns
        differ = (left ^ right).astype(np.int64)
        prefix = (x >> np.uint64(64 - BLOCK_BITS - MAX_OPEN)).astype(np.int64) & mask
        is_right = (prefix >> (MAX_OPEN - np.repeat(opened, hi - lo))) == np.repeat(right, hi - lo)
        mid = np.where(differ == 0, hi, hi - np.add.reduceat(is_right.astype(np.int64), lo))
        start = np.where(differ == 0, lo, mid)
        pairs = (lo, mid, start, hi, np.bitwise_count(differ).astype(np.int64), BLOCK_BITS + opened)
        live = (pairs[0] < pairs[1]) & (pairs[2] < pairs[3])
        root = walk(x, tuple(c[live] for c in pairs), budget)
        moved = np.flatnonzero(root != np.arange(len(x)))
        return pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[root[moved]])], ["a", "b"])

    held: list[list[np.ndarray]] = [[], [], [], []]
    rows = 0
    for b in batches:
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "depth", "x", "rep")]
        cols[2] = cols[2].view(np.uint64)
        if not len(cols[0]):
            continue
        if rows >= BUFFER_ROWS:
            new = np.flatnonzero(cols[0] != held[0][-1][-1])
            if len(new):  # whole nodes only
                k = new[0]
                yield done(*[[*h, c[:k]] for h, c in zip(held, cols, strict=True)])
                held, rows = [[], [], [], []], 0
                cols = [c[k:] for c in cols]
        for h, c in zip(held, cols, strict=True):
            h.append(c)
        rows += len(cols[0])
    if rows:
        yield done(*held)


def _masks(spark, budget: int) -> DataFrame:
    """For each number of opened bits, the prefix differences within the budget (bounded: MAX_OPEN and budget fix it)."""
    bits = [m for r in range(budget + 1) for m in (sum(1 << i for i in c) for c in itertools.combinations(range(MAX_OPEN), r))]
    rows = [(d, m) for d in range(1, MAX_OPEN + 1) for m in bits if m < 1 << d]
    return spark.createDataFrame(rows, "depth int, mask long")


def opened(dealt: DataFrame, node_rows: int) -> DataFrame:
    """Children (``node``, ``depth``, ``sub``) of the nodes with over ``node_rows`` of the rows ``dealt``.

    A node is opened by as few bits as leave ``node_rows`` at most below each
    child, by counts of the children and not by the node's size: where
    fingerprints share bits below the block too, one child of an even split
    would hold nearly all of them. Only where ``MAX_OPEN`` bits do not do is
    a child larger: over ``node_rows`` fingerprints then share 36 of their
    64 bits.
    """
    # at most BLOCKS * 2**BLOCK_BITS nodes can be on this side
    large = F.broadcast(dealt.groupBy("node").count().where(F.col("count") > node_rows).select("node"))
    leaves = (dealt.join(large, "node")
              .withColumn("top", F.shiftrightunsigned("x", 64 - BLOCK_BITS - MAX_OPEN).bitwiseAND(F.lit((1 << MAX_OPEN) - 1)))
              .groupBy("node", "top").agg(F.count(F.lit(1)).alias("n")))
    levels = (leaves.select("node", "top", "n", F.explode(F.sequence(F.lit(1), F.lit(MAX_OPEN))).alias("depth"))
              .groupBy("node", "depth", F.expr(f"shiftright(top, {MAX_OPEN} - depth)").alias("sub")).agg(F.sum("n").alias("n")))
    levels = stage(levels)
    enough = F.min(F.when(F.col("most") <= node_rows, F.col("depth")))
    depths = (levels.groupBy("node", "depth").agg(F.max("n").alias("most"))
              .groupBy("node").agg(F.coalesce(enough, F.lit(MAX_OPEN)).alias("depth")))
    return levels.join(depths, ["node", "depth"]).select("node", "depth", "sub")


def trie_nodes(classes: DataFrame, budget: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """``key``, ``depth``, ``x`` and ``rep``: the rows of every node pair that is walked as one.

    A node that is not opened is paired with itself; of an opened one, each
    child with itself and with the children that exist within ``budget`` bits.
    """
    turned = F.array(*[F.struct(F.lit(t).cast("long").alias("t"),
                                (F.shiftleft("fp", 16 * t).bitwiseOR(F.shiftrightunsigned("fp", 64 - 16 * t))
                                 if t else F.col("fp")).alias("x")) for t in range(BLOCKS)])
    dealt = (classes.where("rep IS NOT NULL").select("rep", F.explode(turned).alias("r"))
             .select("rep", F.col("r.t").alias("t"), F.col("r.x").alias("x"))
             .withColumn("node", F.shiftleft("t", BLOCK_BITS).bitwiseOR(F.shiftrightunsigned("x", 64 - BLOCK_BITS))))
    kids = stage(opened(dealt, node_rows))
    depths = F.broadcast(kids.select("node", "depth").distinct())  # as many rows as large nodes
    # pairs are made of children, before any row: a child has node_rows rows at most, and only pairs that exist get them
    pairs = (kids.join(F.broadcast(_masks(classes.sparkSession, budget)), "depth")
             .withColumn("other", F.col("sub").bitwiseXOR(F.col("mask")))
             .join(kids.select("node", F.col("sub").alias("other")), ["node", "other"], "left_semi"))
    small = dealt.join(depths, "node", "left_anti").select(
        F.shiftleft("node", 2 * MAX_OPEN).alias("key"), F.lit(0).alias("depth"), "x", "rep")
    top = f"(shiftrightunsigned(x, {64 - BLOCK_BITS - MAX_OPEN}) & {(1 << MAX_OPEN) - 1})"
    large = (dealt.join(depths, "node").withColumn("sub", F.expr(f"shiftright({top}, {MAX_OPEN} - depth)"))
             .join(pairs.select("node", "sub", "other"), ["node", "sub"]).select(
        F.shiftleft("node", 2 * MAX_OPEN).bitwiseOR(F.shiftleft(F.least("sub", "other"), MAX_OPEN))
        .bitwiseOR(F.greatest("sub", "other")).alias("key"), "depth", "x", "rep"))
    return small.unionByName(large)


def links(classes: DataFrame, budget: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between the ids (``rep``) of distinct fingerprints (``fp``) within ``budget`` bits.

    They span the same components as all such pairs. ``budget`` is three at
    most, since four blocks carry the pigeonhole argument.
    """
    if not 0 <= budget < BLOCKS:
        raise ValueError("the bit budget must be smaller than the number of blocks")
    spark = classes.sparkSession
    # unsigned order of x within a key
    order = F.col("x").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    nodes = trie_nodes(classes, budget, node_rows).repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", order)
    return map_arrow(nodes, lambda batches: _links(batches, budget), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    ``component_id`` is the smallest id reachable over links of at most
    ``budget`` bits, the row's own included. Rows with equal fingerprints form
    one class and are joined through it, never pair by pair. A null text counts
    as empty (fingerprint 0, linked like any other). A null id takes the
    component of its fingerprint, or null if no row with an id has the same;
    it carries no link. An empty table gives an empty result; other columns are
    ignored.
    """
    prints = stage(fingerprints(docs, id_col, text_col))
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    comp = components(links(classes, budget))
    placed = (classes.join(comp.select(F.col("v").alias("rep"), "m"), "rep", "left")
              .select("fp", F.coalesce("m", "rep").alias("component_id")))
    return (prints.join(placed, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
