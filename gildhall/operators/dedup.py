"""Keep-one family (WIN-1..WIN-5, WIN-9, WIN-10, SNP-1).

``keep_one`` is ``row_number() = 1``; Spark plans it with a partial
WindowGroupLimit *before* the shuffle, so a hot key is cut to one row per
map partition before any data moves. The order must be total — pass every
tie-breaking column — or the winner is not repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gildhall.functions._col import col_of


def _order(order: Sequence) -> list[Column]:
    return [col_of(o) for o in order]


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the first in ``order`` (e.g. ``[F.col('ts').desc(), F.col('id').desc()]``)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_keep_rn", F.row_number().over(w)).filter(F.col("_keep_rn") == 1).drop("_keep_rn")


def latest_flag(df: DataFrame, keys: Sequence[str], by: str, out: str = "is_latest") -> DataFrame:
    """Flag rows holding the partition maximum of ``by`` (WIN-9).

    Group-by + join back rather than ``max() over (partition by)``: the
    aggregate is pre-combined map-side and the join back is split by AQE
    when a key is hot, so no task ever holds a whole hot partition.
    """
    ren = {k: f"_lf_k{i}" for i, k in enumerate(keys)}
    m = df.groupBy(*[F.col(k).alias(ren[k]) for k in keys]).agg(F.max(by).alias("_lf_max"))
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(ren[k]))
        cond = e if cond is None else cond & e
    j = df.join(m, cond, "left").drop(*ren.values())
    return j.withColumn(out, F.coalesce(F.col(by) == F.col("_lf_max"), F.lit(False))).drop("_lf_max")


def latest_snapshot(df: DataFrame, grain: Sequence[str], snapshot_col: str = "snapshot_date_sk",
                    created_col: str | None = "_gold_created_at") -> DataFrame:
    """Newest snapshot row per grain (SNP-1, fix for D-6)."""
    order = [F.col(snapshot_col).desc()]
    if created_col and created_col in df.columns:
        order.append(F.col(created_col).desc())
    return keep_one(df, grain, order)
