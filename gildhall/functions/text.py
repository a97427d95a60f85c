"""Text Column functions (FN-13..FN-20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gildhall.functions._col import col_of

# Three-letter month codes accepted by the month decoder, in
# calendar order (JAN = 1 … DEC = 12).
MONTH_CODES = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN",
               "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]


def month_number(c) -> Column:
    """Month text to number: digits cast directly ('1', '01'), else a
    three-letter code after upper/trim; anything else NULL (FN-13)."""
    c = col_of(c)
    code = F.upper(F.trim(c))
    by_code = F.array_position(F.array(*[F.lit(m) for m in MONTH_CODES]), code).cast("int")
    return (F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))
             .otherwise(F.when(by_code > 0, by_code)))


def blank_to_null(c) -> Column:
    c = col_of(c)
    return F.nullif(F.trim(c), F.lit(""))


def first_non_blank(*cols) -> Column:
    """First argument that is neither NULL nor blank (FN-19)."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def full_name(first, middle, last) -> Column:
    """Parts joined by one space, NULL/blank parts skipped (FN-14)."""
    return F.concat_ws(" ", *[blank_to_null(c) for c in (first, middle, last)])


def phone_with_ext(phone, ext) -> Column:
    """``555-0100 x12``; extension only when present (FN-15)."""
    phone, ext = col_of(phone), col_of(ext)
    return F.when(blank_to_null(ext).isNotNull(),
                  F.concat(phone, F.lit(" x"), F.trim(ext))).otherwise(phone)


def compose_code(sep: str, *parts) -> Column:
    """Composite code skipping blank parts (FN-16); all blank gives NULL."""
    joined = F.concat_ws(sep, *[blank_to_null(p) for p in parts])
    return F.nullif(joined, F.lit(""))


def suffix_after(c, pos: int) -> Column:
    """Characters after position ``pos`` (1-based), NULL when too short (FN-18)."""
    c = col_of(c)
    return F.when(F.length(c) > pos, F.substring(c, pos + 1, 1 << 30))
