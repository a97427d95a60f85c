"""Rule tables, flags and numeric guards (PRJ-4..PRJ-10, FN-21..FN-25)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gildhall.functions._col import col_of


def _match(c: Column, pattern) -> Column:
    """A rule pattern is a LIKE string, a list of exact codes, or a Column."""
    if isinstance(pattern, Column):
        return pattern
    if isinstance(pattern, (list, tuple, set, frozenset)):
        return c.isin(list(pattern))
    return c.like(pattern)


def rules(c, table: Sequence[tuple], default=None, normalise: bool = True) -> Column:
    """Searched CASE: first matching (pattern, value) wins (PRJ-5, PRJ-8).

    The input is upper-cased and trimmed first unless ``normalise`` is off.
    A NULL input matches nothing and gives ``default``.
    """
    c = col_of(c)
    if normalise:
        c = F.upper(F.trim(c))
    out = None
    for pattern, value in table:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(_match(c, pattern), v) if out is None else out.when(_match(c, pattern), v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def flag(c, pattern, normalise: bool = True) -> Column:
    """Boolean flag from a pattern or code list; NULL input gives FALSE (PRJ-6/7)."""
    c = col_of(c)
    if normalise:
        c = F.upper(F.trim(c))
    return F.coalesce(_match(c, pattern), F.lit(False))


def yn_flag(c, default: str | None = "N") -> Column:
    """Y/N character flag to boolean. With a default the NULL becomes that
    default; with ``default=None`` the result is three-valued."""
    c = F.upper(F.trim(col_of(c)))
    if default is not None:
        c = F.coalesce(c, F.lit(default))
    return F.when(c == "Y", True).when(c == "N", False)


def gap(name: str, dtype: str) -> Column:
    """Typed NULL column for a source that does not exist (PRJ-4)."""
    return F.lit(None).cast(dtype).alias(name)


def within(actual, plan, tol: float) -> Column:
    """|actual - plan| <= tol * |plan|; NULL when plan is NULL or 0 (FN-23)."""
    a, p = col_of(actual), col_of(plan)
    return F.when(p.isNull() | (p == 0), F.lit(None).cast("boolean")).otherwise(
        F.abs(a - p) <= F.abs(p) * F.lit(tol))


def ratio(num, den, scale: int = 2, pct: bool = False) -> Column:
    """Guarded division, NULL when the denominator is 0 or NULL (AGG-11, FN-22)."""
    n, d = col_of(num), col_of(den)
    if pct:
        n = n * F.lit(100)
    return F.round(F.try_divide(n.cast("double"), F.nullif(d, F.lit(0)).cast("double")), scale)


def is_distinct(a, b) -> Column:
    """NULL-safe inequality (FLT-6, FN-25)."""
    return ~col_of(a).eqNullSafe(col_of(b))


def any_not_null(cols: Iterable) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | col_of(c).isNotNull()
    return out


def all_zero(cols: Iterable) -> Column:
    """TRUE when every measure is 0 or NULL (FLT-4)."""
    out = F.lit(True)
    for c in cols:
        out = out & (F.coalesce(col_of(c), F.lit(0)) == 0)
    return out


def money(c) -> Column:
    """Money as DECIMAL(15,2); doubles are rounded on the cast."""
    return col_of(c).cast("decimal(15,2)")


def like_any(c, patterns, normalise: bool = True) -> Column:
    """TRUE when the (upper-trimmed) value matches any LIKE pattern; NULL input gives FALSE."""
    c = col_of(c)
    if normalise:
        c = F.upper(F.trim(c))
    out = F.lit(False)
    for p in patterns:
        out = out | c.like(p)
    return F.coalesce(out, F.lit(False))
