"""Fiscal and calendar Column functions (FN-1..FN-12).

All return Columns built from JVM-side expressions, so they stay inside
whole-stage codegen. The federal fiscal year starts on 1 October.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gildhall.functions._col import col_of

# Fixed values that must equal the reference's date dimension:
# fixed-date federal holidays as (month, day): New Year's Day, Independence Day,
# Veterans Day, Christmas Day. Floating holidays are not flagged.
FIXED_HOLIDAYS = [(1, 1), (7, 4), (11, 11), (12, 25)]

# Month abbreviations used in period labels, January first.
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def fiscal_year(d) -> Column:
    d = col_of(d)
    return (F.year(d) + F.when(F.month(d) >= 10, 1).otherwise(0)).cast("int")


def fiscal_quarter(d) -> Column:
    return ((fiscal_month(d) - 1) / 3).cast("int") + 1


def fiscal_month(d) -> Column:
    """1 = October … 12 = September."""
    d = col_of(d)
    return (((F.month(d) + 2) % 12) + 1).cast("int")


def iso_weekday(d) -> Column:
    """1 = Monday … 7 = Sunday."""
    return (F.weekday(col_of(d)) + 1).cast("int")


def is_weekend(d) -> Column:
    return F.dayofweek(col_of(d)).isin(1, 7)


def is_fixed_holiday(d) -> Column:
    d = col_of(d)
    cond = F.lit(False)
    for m, day in FIXED_HOLIDAYS:
        cond = cond | ((F.month(d) == m) & (F.dayofmonth(d) == day))
    return cond


def is_month_end(d) -> Column:
    d = col_of(d)
    return F.to_date(d) == F.last_day(d)


def is_fiscal_year_end(d) -> Column:
    d = col_of(d)
    return (F.month(d) == 9) & (F.dayofmonth(d) == 30)


def date_sk(d) -> Column:
    """yyyyMMdd smart key as INT; NULL stays NULL (FN-8)."""
    return F.date_format(col_of(d), "yyyyMMdd").cast("int")


def from_date_sk(sk) -> Column:
    """INT yyyyMMdd key back to DATE (FN-9); malformed keys give NULL."""
    return F.try_to_date(col_of(sk).cast("string"), "yyyyMMdd")


def period_label(fy, fy_month, cal_month, cal_year) -> Column:
    """``FY2025-M01 (Oct 2024)`` (FN-7)."""
    abbr = F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), col_of(cal_month).cast("int"))
    return F.format_string("FY%d-M%02d (%s %d)", col_of(fy), col_of(fy_month), abbr, col_of(cal_year))


def billing_label(year, month) -> Column:
    """``2025-M03`` (FN-12)."""
    return F.concat(col_of(year).cast("string"), F.lit("-M"),
                    F.lpad(col_of(month).cast("string"), 2, "0"))


def days_between(later, earlier) -> Column:
    """Whole days ``later - earlier`` (FN-10); ``as_of`` is passed in, never now()."""
    return F.datediff(col_of(later), col_of(earlier))
