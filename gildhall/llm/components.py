"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import stage

MAX_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("v", "m").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """``(v, m)``: every node that is not the smallest of its component, and that smallest node.

    ``edges`` has columns ``a`` and ``b``. Each round every node hands its
    neighbours to the smallest node it knows. A minimum is an aggregate that
    combines map-side, and the join back is one that can be split, so a node
    with very many neighbours never sits in one task. Rounds are staged in the
    shared folder.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct())
    seen = _signature(now)
    if seen[0] == 0:
        return now
    for _ in range(MAX_ROUNDS):
        both = now.select(F.col("v").alias("u"), F.col("m").alias("w")).union(now.select(F.col("m"), F.col("v")))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("s"))
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), F.col("s").alias("m")).distinct()
        least = large.groupBy("v").agg(F.min("m").alias("s"))
        small = (large.join(least, "v").where("m <> s").select(F.col("m").alias("v"), F.col("s").alias("m"))
                 .union(least.select("v", F.col("s").alias("m"))).where("v <> m").distinct())
        now = stage(small)
        after = _signature(now)
        if after == seen:
            return now
        seen = after
    raise RuntimeError("components did not settle")
