import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildhall.sources import blocked, conform, date_spine, live, load_ref, period_spine, read_table, seed, write


def test_live_keeps_null_and_char_flag(spark):
    df = spark.createDataFrame([(1, True, "N"), (2, False, " y"), (3, None, None), (4, None, "n")],
                               "id int, is_deleted boolean, delete_flag string")
    assert sorted(r.id for r in live(df).collect()) == [2, 3, 4]
    assert sorted(r.id for r in live(df, also=[("delete_flag", "Y")]).collect()) == [3, 4]


def test_live_pushes_into_parquet(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "flags")
    spark.createDataFrame([(1, True), (2, None)], "id int, is_deleted boolean").write.parquet(p)
    plan = live(spark.read.parquet(p))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(is_deleted)," in plan
    # the reference's COALESCE form is not pushed into the scan
    co = spark.read.parquet(p).filter(F.coalesce("is_deleted", F.lit(False)) == F.lit(False))
    assert "PushedFilters: []" in co._jdf.queryExecution().executedPlan().toString()


def test_date_spine_reference_counts(spark):
    d = date_spine(spark)
    row = d.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_last_day_of_fy").alias("fy_end"),
                F.count_if(F.col("federal_fiscal_fy").isNull()).alias("null_fy"),
                F.min("calendar_date").alias("lo"), F.max("calendar_date").alias("hi")).first()
    assert (row.n, row.fy_end, row.null_fy) == (14976, 41, 0)
    assert (row.lo, row.hi) == (dt.date(2000, 1, 1), dt.date(2040, 12, 31))
    sample = d.filter(F.col("calendar_date") == "2024-10-01").first()
    assert (sample.date_sk, sample.federal_fiscal_fy, sample.federal_fiscal_qtr, sample.federal_fiscal_month,
            sample.day_of_week, sample.day_of_week_num) == (20241001, 2025, 1, 1, "Tuesday", 2)


def test_period_spine_labels(spark):
    p = period_spine(spark, 2023, 2025).orderBy("period_start_dt").collect()
    assert len(p) == 24                                   # Oct 2023 up to, not including, Oct 2025
    assert p[0].period_label == "FY2024-M01 (Oct 2023)"
    assert p[-1].period_label == "FY2025-M12 (Sep 2025)"
    assert str(p[-1].period_end_dt) == "2025-09-30"
    assert [r.is_year_end_flag for r in p].count(True) == 2


def test_seed_asserts_count(spark):
    with pytest.raises(ValueError):
        seed(spark, [("a",)], "c string", expected=6)
    assert seed(spark, [("a",), ("b",)], "c string", expected=2).count() == 2


def test_blocked_is_empty_and_typed(spark):
    schema = T.StructType([T.StructField("x", T.LongType(), False)])
    b = blocked(spark, schema)
    assert b.count() == 0 and b.schema == schema


def test_load_ref_one_long_table(spark):
    a = spark.createDataFrame([("A", "Alpha", "Y", 2, False), ("B", "Beta", "n", 1, None), ("C", "Gone", "Y", 3, True)],
                              "cd string, description string, active_yn string, sort_order int, is_deleted boolean")
    b = spark.createDataFrame([("X", "Ex")], "cd string, description string")
    out = load_ref({"a": a, "b": b}, [dict(source="a", code_set="set_a", active="active_yn", sort_col="sort_order"),
                                      dict(source="b", code_set="set_b")])
    rows = {(r.code_set, r.code_value): r for r in out.collect()}
    assert set(rows) == {("set_a", "A"), ("set_a", "B"), ("set_b", "X")}
    assert rows[("set_a", "B")].is_active_flag is False and rows[("set_b", "X")].sort_order is None


def test_conform_casts_gaps_and_not_null(spark):
    contract = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("amt", T.DecimalType(15, 2)),
                             T.StructField("gap", T.StringType()), T.StructField("_gold_created_at", T.TimestampNTZType()),
                             T.StructField("_gold_updated_at", T.TimestampNTZType()),
                             T.StructField("_source_batch_id", T.StringType())])
    df = spark.createDataFrame([(1, 2.345)], "id int, amt double")
    out = conform(df, contract, as_of="2002-01-01", batch_id="b1")
    assert out.columns == [f.name for f in contract.fields]
    r = out.first()
    assert str(r.amt) == "2.35" and r.gap is None and r._source_batch_id == "b1"
    bad = spark.createDataFrame([(None, 1.0)], "id int, amt double")
    with pytest.raises(Exception, match="NOT NULL violated"):
        conform(bad, contract, as_of="2002-01-01", batch_id="b1").collect()


def test_write_modes(spark, tmpdir_run):
    df = spark.createDataFrame([(1, 20240101), (2, 20240101)], "id int, snapshot_date_sk int")
    p = os.path.join(tmpdir_run, "ov")
    assert write(df, p, "overwrite") == "SUCCESS"
    assert write(df.limit(1), p, "overwrite") == "SUCCESS"
    assert read_table(spark, p).count() == 1                       # pointer moved to the new version
    q = os.path.join(tmpdir_run, "ins")
    assert write(df, q, "insert_only") == "SUCCESS"
    assert write(df, q, "insert_only") == "SKIPPED_ALREADY_LOADED"
    s = os.path.join(tmpdir_run, "snap")
    write(df, s, "append_snapshot")
    write(spark.createDataFrame([(9, 20240201)], "id int, snapshot_date_sk int"), s, "append_snapshot")
    write(spark.createDataFrame([(7, 20240101)], "id int, snapshot_date_sk int"), s, "append_snapshot")
    got = sorted((r.id, r.snapshot_date_sk) for r in spark.read.parquet(s).collect())
    assert got == [(7, 20240101), (9, 20240201)]                    # rerun replaced only its partition
