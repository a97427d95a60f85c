"""Data-quality profile (CHK-1..CHK-18).

``profile`` evaluates every check of a table in one aggregate pass (partial
aggregation on the executors, one row at the end) and returns it as rows
``(check, value, ok)``. The reference scans the target once per COUNT.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Check = tuple[Column, Callable[[Column], Column] | None]


def profile(df: DataFrame, checks: Mapping[str, Check], value_type: str = "decimal(38,2)") -> DataFrame:
    """``checks`` maps a name to ``(aggregate Column, ok-predicate or None)``."""
    names = list(checks)
    row = df.agg(*[checks[n][0].cast(value_type).alias(f"_c{i}") for i, n in enumerate(names)])
    pairs = []
    for i, n in enumerate(names):
        v = F.col(f"_c{i}")
        pred = checks[n][1]
        ok = pred(v) if pred else F.lit(None).cast("boolean")
        pairs.append(F.struct(F.lit(n).alias("check"), v.alias("value"), ok.alias("ok")))
    return row.select(F.explode(F.array(*pairs)).alias("_r")).select("_r.*")


# --- check builders -------------------------------------------------------

def not_null_count(c: str) -> Column:
    return F.count(F.col(c))


def null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def true_count(c: str) -> Column:
    return F.count_if(F.col(c) == F.lit(True))


def false_count(c: str) -> Column:
    return F.count_if(F.col(c) == F.lit(False))


def eq(n) -> Callable[[Column], Column]:
    return lambda v: v == F.lit(n)


def le(n) -> Callable[[Column], Column]:
    return lambda v: v <= F.lit(n)


def ge(n) -> Callable[[Column], Column]:
    return lambda v: v >= F.lit(n)


def row_parity(source: DataFrame, target: DataFrame, name: str = "row_parity") -> DataFrame:
    """Source rows vs target rows (CHK-2): two global counts as scalar
    subqueries, one row, no join."""
    s = source.agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.select(F.count(F.lit(1))).scalar()
    return s.select(F.lit(name).alias("check"), "source_rows", t.alias("target_rows"),
                    (F.col("source_rows") == t).alias("ok"))


def dup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row (CHK-4, AGG-8)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def scd2_invariants(dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys breaking SCD2 rules (CHK-5): current rows != 1, or an end date on
    a current row."""
    g = dim.groupBy(*key).agg(
        F.count_if(F.col("is_current_flag")).alias("current_rows"),
        F.count_if(F.col("is_current_flag") & F.col("eff_end_dt").isNotNull()).alias("open_with_end"))
    return g.filter((F.col("current_rows") != 1) | (F.col("open_with_end") > 0))


def sentinel_report(df: DataFrame, sk_cols: Sequence[str], expected: Mapping[str, Column] | None = None,
                    sentinel: int = -1) -> DataFrame:
    """Sentinel keys per column, split expected / unexpected (CHK-6).

    ``expected[col]`` is a predicate saying a sentinel there is legitimate
    (e.g. the natural key was NULL). One aggregate pass for all columns.
    """
    expected = dict(expected or {})
    aggs = []
    for c in sk_cols:
        is_s = F.col(c) == F.lit(sentinel)
        exp = expected.get(c, F.lit(False))
        aggs += [F.count_if(is_s & exp).alias(f"{c}__exp"), F.count_if(is_s & ~exp).alias(f"{c}__unexp")]
    row = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("sk_column"), F.col(f"{c}__exp").alias("expected_sentinels"),
                     F.col(f"{c}__unexp").alias("unexpected_sentinels")) for c in sk_cols]
    return row.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def sum_recon(detail: DataFrame, total: DataFrame, key: Sequence[str], detail_amt: str, total_amt: str,
              tol: float = 0.01) -> DataFrame:
    """Groups whose detail sum differs from the total by more than ``tol`` (CHK-7)."""
    d = detail.groupBy(*key).agg(F.sum(detail_amt).alias("detail_sum"))
    j = total.select(*key, F.col(total_amt).alias("total_amt")).join(d, list(key), "left")
    diff = F.abs(F.col("total_amt") - F.coalesce(F.col("detail_sum"), F.lit(0)))
    return j.withColumn("diff", diff).filter(F.col("diff") > F.lit(tol))


def expected_codes(df: DataFrame, col: str, expected: Sequence[str]) -> DataFrame:
    """Expected codes that are absent (CHK-10): anti-join of the fixed list."""
    spark = df.sparkSession
    exp = spark.createDataFrame([(e,) for e in expected], f"{col} string")
    present = df.select(F.col(col).cast("string").alias(col)).distinct()
    return exp.join(present, col, "left_anti")


def preflight(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Upstream non-empty check (CHK-15): ``limit(1)`` per input, one union, one job."""
    parts = [df.limit(1).select(F.lit(name).alias("input_name")) for name, df in inputs.items()]
    present = parts[0]
    for p in parts[1:]:
        present = present.unionByName(p)
    spark = next(iter(inputs.values())).sparkSession
    names = spark.createDataFrame([(n,) for n in inputs], "input_name string")
    flags = present.distinct().withColumn("has_rows", F.lit(True))
    return names.join(flags, "input_name", "left").select(
        "input_name", F.coalesce(F.col("has_rows"), F.lit(False)).alias("has_rows"))


def _key_text(cols: Sequence[str]) -> Column:
    """The columns' values as one string that no other values share; NULL apart from every value."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")),
                                         F.lit("n")) for c in cols])


def quality_suite(df: DataFrame, unique: Mapping[str, Sequence[str]] | None = None,
                  sentinels: Mapping[str, Column] | None = None, distributions: Mapping[str, int] | None = None,
                  sentinel: int = -1) -> DataFrame:
    """Uniqueness, sentinel and distribution checks in one scan (CHK-4, CHK-6, CHK-9): ``check``, ``item``, ``n``.

    Every row becomes one tagged key for each check and all checks are counted
    by one aggregate on (check, key), combined before its shuffle, so hot keys
    and values cost nothing extra; a second one folds each uniqueness check to a
    number. ``unique`` names key lists (``item`` NULL, ``n`` keys with more than
    one row), ``sentinels`` maps key columns to when a sentinel is legitimate
    (``item`` expected or unexpected, ``n`` rows), ``distributions`` maps columns to
    how many of their most frequent values to return (ties by value, NULL as
    an item of its own). A check without anything to report has no row, but
    for uniqueness: 0, unless the table is empty.
    """
    tags = [F.struct(F.lit(f"unique:{name}").alias("check"), _key_text(cols).alias("key")) for name, cols in (unique or {}).items()]
    for c, legitimate in (sentinels or {}).items():
        what = F.when(F.coalesce(legitimate, F.lit(False)), "expected").otherwise("unexpected")
        tags.append(F.when(F.col(c) == F.lit(sentinel), F.struct(F.lit(f"sentinel:{c}").alias("check"), what.alias("key"))))
    top = {f"values:{c}": n for c, n in (distributions or {}).items()}
    tags += [F.struct(F.lit(f"values:{c}").alias("check"), F.col(c).cast("string").alias("key")) for c in distributions or {}]
    counts = (df.select(F.explode(F.array(*tags)).alias("_t")).filter(F.col("_t").isNotNull())
              .groupBy(F.col("_t.check").alias("check"), F.col("_t.key").alias("key")).agg(F.count(F.lit(1)).alias("n")))
    is_key = F.col("check").startswith("unique:")
    folded = counts.groupBy("check", F.when(~is_key, F.col("key")).alias("item")).agg(
        F.sum(F.when(is_key, (F.col("n") > 1).cast("long")).otherwise(F.col("n"))).alias("n"))
    limit = F.lit(None).cast("int")
    for check, n in top.items():
        limit = F.when(F.col("check") == check, F.lit(n)).otherwise(limit)
    most = max(top.values(), default=0)
    place = F.row_number().over(Window.partitionBy("check").orderBy(F.desc("n"), F.asc_nulls_last("item")))
    # the outer limit lets Spark keep the first rows of a check before the shuffle
    ranked = folded.withColumn("_place", place).filter(F.col("_place") <= max(most, 2))
    return ranked.filter(F.coalesce(F.col("_place") <= limit, F.lit(True))).drop("_place")
