"""The trie of conversation prefixes, by van Emde Boas recursion over the depth.

A sequence of turns is cut at half the depth. Equal cut prefixes get one name,
the smallest conversation that has them. The distinct prefixes, weighted by
how many conversations have them, are the upper trie's sequences; the
suffixes, each under its prefix's name, are those of the lower forests. Upper
trie and lower forests are cut again in the same Spark round, all problems of
one height together, until each is one turn high and names the nodes
themselves. Then totals are grafted upward: a problem's root takes over what
its lower forests have counted, height by height.

A sequence is never one row. Turns are rows; aligned blocks of 2, 4, 8 ...
turns are named by the SHA-256 of their halves' names, so a sequence in a
problem is one pointer to a block, however long the block is. A conversation
that holds a third of all turns is spread like any other.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import map_arrow, shuffle_partitions, stage
from gildhall.operators.sequence import ordinal

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of one conversation that meet in one join key, and ids of one text chunk.
SPAN = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``conv_id``, ``j`` (place from 0 by turn, null first), ``name`` (of role and text), ``words`` of the text.

    A null role or text counts as empty. Rows that share a turn are placed by
    name, repeated rows all stay. Rows without a conversation take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    placed = ordinal(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("name").asc()], name="j")
    return placed.select("conv_id", (F.col("j") - 1).alias("j"), "name", "words")


def lengths(sequences: DataFrame) -> DataFrame:
    """``conv_id``, ``length`` of every conversation."""
    return sequences.groupBy("conv_id").agg((F.max("j") + 1).alias("length"))


def with_shared_heads(sequences: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of their group's first one: (sequences, lengths), both staged.

    Conversation c takes the first h = crc32(c) mod ``most`` turns of c - c mod
    ``group`` (as many as there are) and keeps its own after its first h.
    """
    heads = (sequences.where(F.col("j") < most - 1).where(F.col("conv_id") % group == 0)
             .groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("j", "name", "words"))).alias("head")))
    plan = stage(lengths(sequences).withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(heads, "base", "left")
                 .withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
                 .withColumn("head", F.expr("slice(coalesce(head, array()), 1, h)"))
                 .withColumn("taken", F.size("head")))
    taken = plan.select("conv_id", F.inline("head")).select("conv_id", "j", "name", "words")
    # a conversation meets its plan span by span, so a very long one is many keys
    spans = plan.select("conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {SPAN}"))).alias("span"))
    own = (sequences.withColumn("span", F.expr(f"j div {SPAN}")).join(spans, ["conv_id", "span"]).where("j >= h")
           .select("conv_id", (F.col("j") - F.col("h") + F.col("taken")).alias("j"), "name", "words"))
    rebuilt = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).cast("long").alias("length"))
    return stage(taken.select("conv_id", F.col("j").cast("long"), "name", "words").union(own)), rebuilt


def blocks(sequences: DataFrame, height: int) -> list[DataFrame]:
    """Staged names of aligned blocks: item k has one row for each conversation's blocks of 2**k turns."""
    levels = [stage(sequences.select("conv_id", "j", "name", F.lit(1).cast("long").alias("len"), "words"))]
    for _ in range(height):
        odd = F.col("j") % 2 == 1
        up = levels[-1].groupBy("conv_id", F.expr("j div 2").alias("j")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right"),
            F.sum("len").alias("len"), F.sum(F.when(~odd, F.col("len"))).alias("left_len"))
        levels.append(stage(up.withColumn("name", F.sha2(F.concat_ws(":", "left", F.coalesce("right", F.lit(""))).cast("binary"), 256))))
    return levels


def cut(state: DataFrame, salts: int) -> DataFrame:
    """The problems of half the height: upper tries' weighted prefixes and, under their names, the lower forests'.

    ``state`` (staged): a problem's root ``parent`` at block ``j``, a sequence's
    halves ``left`` and ``right``, how many conversations have it (``n``), the
    smallest one (``rep``), and ``ends``, the name of the whole conversation
    that ends with it. Rows of one hot prefix are counted and joined in
    ``salts`` parts.
    """
    rows = state.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts)))
    key = ["j", "parent", "left"]
    parts = rows.groupBy(*key, "salt").agg(
        F.min("rep").alias("rep"), F.sum("n").alias("n"), F.first("left_len").alias("len"),
        F.max(F.when(F.col("right").isNull(), F.col("ends"))).alias("ends"), F.max(F.col("right").isNotNull()).alias("goes_on"))
    named = stage(parts.groupBy(*key).agg(
        F.min("rep").alias("rep"), F.sum("n").alias("n"), F.first("len").alias("len"), F.max("ends").alias("ends"),
        F.collect_list(F.when(F.col("goes_on"), F.col("salt"))).alias("salts")))
    upper = named.select((F.col("j") * 2).alias("j"), "parent", "rep", "n", "len", "ends")
    names = named.select(*key, F.col("rep").alias("name"), F.explode("salts").alias("salt"))
    lower = (rows.where("right IS NOT NULL").join(names, [*key, "salt"])
             .select((F.col("j") * 2 + 1).alias("j"), F.col("name").alias("parent"), "rep", "n",
                     (F.col("len") - F.col("left_len")).alias("len"), "ends"))
    return upper.union(lower)


def union(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    return rows


def total(parts: list[DataFrame]) -> DataFrame:
    """Sums of (``depth``, ``conv_id``, ``leaves``, ``saved``) rows, staged."""
    return stage(union(parts).groupBy("depth", "conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))


def graft(weights: DataFrame, links: list[DataFrame]) -> DataFrame:
    """Subtree sums of ``weights``, staged by height.

    ``links[k]`` ties every node at a depth divisible by 2**k to its ancestor
    2**k turns above (``up``, at ``depth - 2**k``). Upward: what a problem of
    height 2**k holds under its root, its upper trie's sum and those of its
    lower forests. Then, from the greatest height down, a node's subtree is
    the problem under it and the subtrees that begin where that one stops.
    """
    def lifted(sums: DataFrame, k: int, side: int) -> DataFrame:
        of = links[k].where(F.expr(f"(depth div {1 << k}) % 2") == side)
        return of.join(sums, ["depth", "conv_id"]).select(F.col("depth") - (1 << k), F.col("up"), "leaves", "saved").toDF(*weights.columns)

    height = len(links) - 1
    under = [total([links[0].join(weights, ["depth", "conv_id"]).select(F.col("depth") - 1, F.col("up"), "leaves", "saved").toDF(*weights.columns)])]
    for k in range(height):
        under.append(total([under[k].where(F.col("depth") % (2 << k) == 0), lifted(under[k], k, 1)]))
    done: list[DataFrame] = []  # sums over all turns below a node
    for k in range(height, -1, -1):
        here = F.col("depth") % (2 << k) == 1 << k
        if k == height:
            here |= F.col("depth") == 0
        parts = [under[k].where(here)]
        if done:
            parts.append(lifted(union(done), k, 0))
        done.append(total(parts))
    return total([weights, *done])


def ends(members: DataFrame) -> DataFrame:
    """``ends``, ``ends_sha256`` of the comma-joined ascending ids of each class (``ends``, ``conv_id``).

    Ids are range-partitioned, so a class of very many is cut into text chunks
    by many tasks; only the hash itself, which can't be divided, runs over a
    class's chunks in one task, a chunk at a time.
    """
    def chunks(batches):
        held, of = [], None
        for b in batches:
            out = []
            for cls, conv in zip(b.column("ends").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
                if held and (cls != of or len(held) == SPAN):
                    out.append((of, held[0], ",".join(map(str, held))))
                    held = []
                of = cls
                held.append(conv)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("ends", "first", "ids"), r, strict=True)) for r in out], schema=parts)
        if held:
            yield pa.RecordBatch.from_pylist([{"ends": of, "first": held[0], "ids": ",".join(map(str, held))}], schema=parts)

    def hashes(batches):
        state, of = None, None
        for b in batches:
            out = []
            for cls, ids in zip(b.column("ends").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if state is not None and cls == of:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((of, state.hexdigest()))
                state, of = hashlib.sha256(ids.encode()), cls
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["ends", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([of]), pa.array([state.hexdigest()])], ["ends", "ends_sha256"])

    parts = pa.schema([("ends", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
    n = shuffle_partitions(members.sparkSession)
    sorted_ids = members.repartitionByRange(n, "ends", "conv_id").sortWithinPartitions("ends", "conv_id")
    texts = map_arrow(sorted_ids, chunks, "ends string, first long, ids string")
    return map_arrow(texts.repartition(n, "ends").sortWithinPartitions("ends", "first"), hashes, "ends string, ends_sha256 string")


def prefix_trie(sequences: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """One row per distinct prefix of the sequences (``conv_id``, ``j``, ``name``, ``words``), the empty one included.

    ``sizes`` (``conv_id``, ``length``) names all members, also those without a
    turn. Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``
    (the parent's ``conv_id``; root: null), ``name`` (of the last turn; root:
    null), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` over
    the subtree, ``ends_sha256`` of the members that end here. Without members
    the result is empty. Columns other than those named are ignored.
    """
    spark = sequences.sparkSession
    sequences = sequences.select("conv_id", "j", "name", "words")
    sizes = stage(lengths(sequences) if sizes is None else sizes.select("conv_id", "length"))
    first, n_convs, longest = sizes.agg(F.min("conv_id"), F.count("*"), F.max("length")).first()
    height = max(int(longest or 0) - 1, 0).bit_length()
    levels = blocks(sequences, height)

    whole = levels[height].select("conv_id", F.col("name").alias("ends"), "len")
    classes = whole.groupBy("ends").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("len").alias("len"))
    state = classes.select(F.lit(0).cast("long").alias("j"), F.lit(first).cast("long").alias("parent"), "rep", "n", "len", "ends")
    links = []
    for k in range(height, -1, -1):
        halves = ["left", "right", "left_len"] if k else ["name", "words"]
        state = stage(state.join(levels[k].select(F.col("conv_id").alias("rep"), "j", *halves), ["rep", "j"]))
        links.append(state.where(F.col("len") == 1 << k).select(
            ((F.col("j") + 1) * (1 << k)).alias("depth"), F.col("rep").alias("conv_id"), F.col("parent").alias("up")))
        if k:
            state = cut(state, shuffle_partitions(spark))
    links.reverse()

    empty_hash = F.lit("")
    root = spark.range(1 if n_convs else 0).select(
        F.lit(first).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(None).cast("string").alias("name"), F.lit(n_convs).cast("long").alias("n_convs"), empty_hash.alias("ends"), F.lit(0).cast("long").alias("words"))
    nodes = root.union(state.select(F.col("rep"), F.col("j") + 1, "parent", "name", "n", "ends", "words"))
    kids = state.groupBy((F.col("j")).alias("depth"), F.col("parent").alias("conv_id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(kids, ["depth", "conv_id"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    sums = graft(nodes.select("depth", "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"),
                              ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), links)
    turnless = sizes.where("length = 0").select(empty_hash.alias("ends"), "conv_id")
    hashes = ends(whole.select("ends", "conv_id").union(turnless))
    return (nodes.join(sums, ["depth", "conv_id"]).join(hashes, "ends", "left")
            .select("conv_id", "depth", "parent_conv_id", "name", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))
