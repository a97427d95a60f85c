import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from gildhall import functions as G


def _one(spark, rows, schema, *cols):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*cols).collect()]


def test_fiscal_boundaries(spark):
    rows = [(dt.date(2024, 9, 30),), (dt.date(2024, 10, 1),), (dt.date(2024, 2, 29),), (dt.date(2024, 12, 31),)]
    out = _one(spark, rows, "d date", G.fiscal_year("d"), G.fiscal_quarter("d"), G.fiscal_month("d"))
    assert out == [(2024, 4, 12), (2025, 1, 1), (2024, 2, 5), (2025, 1, 3)]


def test_calendar_flags(spark):
    rows = [(dt.date(2024, 1, 7),), (dt.date(2024, 7, 4),), (dt.date(2024, 9, 30),), (dt.date(2024, 2, 29),)]
    out = _one(spark, rows, "d date", G.iso_weekday("d"), G.is_weekend("d"), G.is_fixed_holiday("d"),
               G.is_month_end("d"), G.is_fiscal_year_end("d"))
    assert out[0] == (7, True, False, False, False)      # Sunday → 7
    assert out[1] == (4, False, True, False, False)      # Independence Day, Thursday
    assert out[2] == (1, False, False, True, True)       # 30 Sep: month end and FY end
    assert out[3] == (4, False, False, True, False)      # 29 Feb is a month end


def test_date_sk_round_trip_and_null(spark):
    rows = [(dt.date(2024, 10, 1),), (None,)]
    out = _one(spark, rows, "d date", G.date_sk("d").alias("k"), G.from_date_sk(G.date_sk("d")))
    assert out == [(20241001, dt.date(2024, 10, 1)), (None, None)]
    bad = _one(spark, [(20241399,)], "k int", G.from_date_sk("k"))
    assert bad == [(None,)]


def test_month_number_forms(spark):
    rows = [("1",), ("01",), ("JAN",), (" jan ",), ("XX",), (None,), ("12",), ("dec",)]
    out = [r[0] for r in _one(spark, rows, "m string", G.month_number("m"))]
    assert out == [1, 1, 1, 1, None, None, 12, 12]


def test_period_and_billing_labels(spark):
    out = _one(spark, [(2025, 1, 10, 2024)], "fy int, fm int, m int, y int",
               G.period_label("fy", "fm", "m", "y"), G.billing_label("y", "m"))
    assert out == [("FY2025-M01 (Oct 2024)", "2024-M10")]


def test_text_helpers(spark):
    rows = [("Ann", None, "Lee", " ", "555", "12"), ("  ", "B", "", "x", "556", None)]
    out = _one(spark, rows, "a string, b string, c string, d string, p string, e string",
               G.full_name("a", "b", "c"), G.compose_code("-", "a", "d"), G.phone_with_ext("p", "e"),
               G.first_non_blank("d", "a"))
    assert out[0] == ("Ann Lee", "Ann", "555 x12", "Ann")
    assert out[1] == ("B", "x", "556", "x")
    allblank = _one(spark, [(" ", None)], "a string, b string", G.compose_code("-", "a", "b"))
    assert allblank == [(None,)]


def test_suffix_after(spark):
    out = _one(spark, [("ABCD-123",), ("ABC",), (None,)], "c string", G.suffix_after("c", 4))
    assert [r[0] for r in out] == ["-123", None, None]


def test_rules_first_match_wins_and_null(spark):
    rows = [("f-1",), ("O-1x",), ("O-5",), (None,), ("Z",)]
    table = [("F-%", "CLOSED"), ("O-1%", "URGENT"), ("O-%", "OPEN")]
    out = [r[0] for r in _one(spark, rows, "c string", G.rules("c", table, "UNKNOWN"))]
    assert out == ["CLOSED", "URGENT", "OPEN", "UNKNOWN", "UNKNOWN"]


def test_flag_and_yn(spark):
    rows = [("y",), ("N",), (None,), ("?",)]
    out = _one(spark, rows, "c string", G.yn_flag("c"), G.yn_flag("c", default=None), G.flag("c", ["Y"]))
    assert out == [(True, True, True), (False, False, False), (False, None, False), (None, None, False)]


def test_within_tolerance(spark):
    rows = [(Decimal("110.00"), Decimal("100.00")), (Decimal("110.01"), Decimal("100.00")),
            (Decimal("5.00"), Decimal("0.00")), (Decimal("5.00"), None)]
    out = [r[0] for r in _one(spark, rows, "a decimal(15,2), p decimal(15,2)", G.within("a", "p", 0.10))]
    assert out == [True, False, None, None]


def test_ratio_guard(spark):
    out = _one(spark, [(1, 3), (1, 0), (None, 2)], "n int, d int", G.ratio("n", "d", 2, pct=True))
    assert [r[0] for r in out] == [33.33, None, None]


def test_is_distinct_null_safe(spark):
    out = _one(spark, [(1, 1), (1, None), (None, None)], "a int, b int", G.is_distinct("a", "b"))
    assert [r[0] for r in out] == [False, True, False]


def test_all_zero(spark):
    out = _one(spark, [(0, None), (0, 1)], "a int, b int", G.all_zero(["a", "b"]))
    assert [r[0] for r in out] == [True, False]


def test_money_cast(spark):
    out = _one(spark, [(1.005,)], "x double", G.money("x"))
    assert out[0][0] in (Decimal("1.00"), Decimal("1.01"))
    assert F is not None
