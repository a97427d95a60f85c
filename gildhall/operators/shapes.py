"""Set operations into one shape, and grouped helpers (SET-1..3, AGG-6, AGG-14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_shapes(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column missing from a branch becomes a typed NULL (SET-1)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def subtype_union(branches: Sequence[tuple[DataFrame, str, Mapping[str, Column]]], tag: str = "subtype") -> DataFrame:
    """Several subtype branches, each projected through its own column map
    and tagged with a literal (SET-2): one generic function, one config per
    branch."""
    parts = []
    for df, label, cols in branches:
        parts.append(df.select(F.lit(label).alias(tag), *[c.alias(n) for n, c in cols.items()]))
    return union_shapes(parts)


def distinct_union(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION (distinct) (SET-3)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def id_list(df: DataFrame, keys: Sequence[str], id_col: str, out: str = "id_list", sep: str = ",") -> DataFrame:
    """Sorted, de-duplicated id list as text per group (AGG-6).

    (group, id) pairs are de-duplicated with a shuffle on the pair first, so
    a hot group reaches its final aggregate as distinct ids only; the text
    is the feature, so the cell holds the group's whole id set.
    """
    pairs = df.select(*keys, F.col(id_col)).filter(F.col(id_col).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(id_col)), lambda x: x.cast("string")), sep)
        .alias(out))


def avg_of_counts(df: DataFrame, entity: Sequence[str], part: Sequence[str], out: str = "avg_count",
                  scale: int = 2) -> DataFrame:
    """Average over entities of a per-entity row count, per ``part`` (AGG-14,
    the intent of ``AVG(COUNT(*)) OVER (PARTITION BY ..)``; fix for D-8).
    Two aggregates, both with partial aggregation."""
    per = df.groupBy(*part, *entity).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(*part).agg(
        F.round(F.sum("_n") / F.count(F.lit(1)), scale).cast(f"decimal(18,{scale})").alias(out),
        F.count(F.lit(1)).alias("n_entities"))
