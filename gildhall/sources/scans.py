"""Scans and generators (SRC-2..SRC-9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildhall.functions import calendar as cal


def live(df: DataFrame, flag: str = "is_deleted", also: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Live rows: the soft-delete flag is NULL or FALSE (SRC-2).

    Written as ``flag IS NULL OR flag = FALSE`` (not ``COALESCE(flag, FALSE) =
    FALSE``) so the predicate is pushed into the Parquet scan. ``also`` adds
    character flags, e.g. ``("delete_flag", "Y")`` drops rows whose flag is
    'Y' after upper/trim, keeping NULL (SRC-3).
    """
    f = F.col(flag)
    out = df.filter(f.isNull() | (f == F.lit(False)))
    for col, dead in also or ():
        c = F.col(col)
        out = out.filter(c.isNull() | (F.upper(F.trim(c)) != F.lit(dead)))
    return out


def date_spine(spark: SparkSession, start: str = "2000-01-01", end: str = "2040-12-31") -> DataFrame:
    """One row per day with calendar and fiscal attributes (SRC-4).

    2000-01-01 to 2040-12-31 gives 14,976 rows and 41 fiscal-year-end rows.
    """
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("_lo"), F.to_date(F.lit(end)).alias("_hi"))
    return date_spine_over(bounds, "_lo", "_hi")


def date_spine_over(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """Day spine between two columns of a one-row frame (e.g. ``min``/``max``
    of the fact dates), generated by ``explode(sequence())`` on an executor."""
    base = bounds.select(F.explode(F.sequence(F.to_date(F.col(lo)), F.to_date(F.col(hi)),
                                              F.expr("interval 1 day"))).alias("calendar_date"))
    return calendar_attributes(base)


def calendar_attributes(base: DataFrame, d: str = "calendar_date") -> DataFrame:
    d = F.col(d)
    return base.select(
        cal.date_sk(d).alias("date_sk"),
        d.alias("calendar_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        cal.iso_weekday(d).alias("day_of_week_num"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("calendar_month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("calendar_quarter"),
        F.year(d).alias("calendar_year"),
        cal.fiscal_year(d).alias("federal_fiscal_fy"),
        cal.fiscal_quarter(d).alias("federal_fiscal_qtr"),
        cal.fiscal_month(d).alias("federal_fiscal_month"),
        cal.is_weekend(d).alias("is_weekend_flag"),
        cal.is_fixed_holiday(d).alias("is_federal_holiday"),
        cal.is_month_end(d).alias("is_last_day_of_month"),
        cal.is_fiscal_year_end(d).alias("is_last_day_of_fy"),
    )


def period_spine(spark: SparkSession, first_cal_year: int, end_cal_year: int) -> DataFrame:
    """Monthly accrual periods from October of ``first_cal_year`` up to, not
    including, October of ``end_cal_year`` (SRC-5)."""
    bounds = spark.range(1).select(F.lit(first_cal_year).alias("_y0"), F.lit(end_cal_year).alias("_y1"))
    return period_spine_over(bounds, "_y0", "_y1")


def period_spine_over(bounds: DataFrame, first_cal_year: str, end_cal_year: str) -> DataFrame:
    """Period spine between year columns of a one-row frame; built with
    ``sequence(.., interval 1 month)`` and expressions, no driver loop."""
    start = F.make_date(F.col(first_cal_year), F.lit(10), F.lit(1))
    stop = F.make_date(F.col(end_cal_year), F.lit(9), F.lit(1))
    m = bounds.select(F.explode(F.sequence(start, stop, F.expr("interval 1 month"))).alias("period_start_dt"))
    ps = F.col("period_start_dt")
    fy, fm = cal.fiscal_year(ps), cal.fiscal_month(ps)
    return m.select(
        F.year(ps).alias("accrual_year"),
        F.month(ps).alias("accrual_month"),
        fy.alias("accrual_fy"),
        fm.alias("accrual_fy_month"),
        cal.fiscal_quarter(ps).alias("accrual_fy_quarter"),
        cal.period_label(fy, fm, F.month(ps), F.year(ps)).alias("period_label"),
        ps,
        F.last_day(ps).alias("period_end_dt"),
        (F.month(ps) == 9).alias("is_year_end_flag"),
    )


def seed(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str,
         expected: int | None = None) -> DataFrame:
    """Static literal rows (SRC-6); ``expected`` asserts the count at build time
    without a Spark job, since the rows are known to the driver."""
    if expected is not None and len(rows) != expected:
        raise ValueError(f"seed has {len(rows)} rows, expected {expected}")
    return spark.createDataFrame(list(rows), schema)


def blocked(spark: SparkSession, contract: T.StructType) -> DataFrame:
    """Empty DataFrame of the target contract for a source that is blocked (SRC-9)."""
    return spark.createDataFrame([], contract)


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.col(v)


def load_ref(sources: Mapping[str, DataFrame], config: Sequence[Mapping]) -> DataFrame:
    """Config-driven code-table load (SRC-7).

    Every config row names a source DataFrame and says which optional columns
    it has. All code tables come out as one long table
    ``(code_set, code_value, code_desc, short_desc, sort_order, is_active_flag)``,
    one union of narrow selects: one job for all code sets instead of one job
    per table. Missing optional columns become typed NULLs.
    """
    parts = []
    for cfg in config:
        df = sources[cfg["source"]]
        if cfg.get("live", True) and "is_deleted" in df.columns:
            df = live(df)
        cd = _as_col(cfg.get("code_col", "cd"))
        desc = _as_col(cfg.get("desc_col", "description"))
        short = _as_col(cfg["short_col"]) if cfg.get("short_col") is not None else F.lit(None).cast("string")
        sort = _as_col(cfg["sort_col"]).cast("int") if cfg.get("sort_col") is not None \
            else F.lit(None).cast("int")
        active = cfg.get("active")
        if active is None:
            act = F.lit(None).cast("boolean")
        elif isinstance(active, Column):
            act = active
        else:
            a = F.upper(F.trim(F.col(active)))
            act = F.when(a == "Y", True).when(a == "N", False)
        extra = [F.lit(cfg.get("source_label")).cast("string").alias("source_table")] \
            if any("source_label" in c for c in config) else []
        parts.append(df.select(
            F.lit(cfg["code_set"]).alias("code_set"),
            F.trim(cd.cast("string")).alias("code_value"),
            desc.cast("string").alias("code_desc"),
            short.alias("short_desc"),
            sort.alias("sort_order"),
            act.alias("is_active_flag"),
            *extra,
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if any(cfg.get("distinct") for cfg in config):
        out = out.distinct()
    return out


def extend_dim(dim: DataFrame, extra: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Dimension derived from another dimension, keeping its history rows (SRC-8).

    Left join on the natural key; ``extra`` must be unique on it so the row
    count of ``dim`` never changes (checked lazily by the quality profile).
    """
    return dim.join(extra, on=on, how="left")
