"""85 code tables loaded as one long table."""

from gildhall.plans.domain.ref import REF_TABLES, blocked_code_sets, ref_code_tables


def test_ref_config_counts():
    assert len(REF_TABLES) == 85
    assert [t[0] for t in REF_TABLES if t[4]] == ["lu_multi_year_contract"]


def test_ref_code_tables(spark):
    s = {"aasbs_lu_instrument_type": spark.createDataFrame(
            [(" IAA ", "Interagency", "Y", 2, "IA", None), ("OLD", "gone", "N", 1, "O", True)],
            "cd string, description string, active_yn string, sort_order int, short_description string, is_deleted boolean"),
         "aasbs_lu_fund": spark.createDataFrame([("F1", "Fund one", "n", None)],
                                                "cd string, description string, active_yn string, is_deleted boolean"),
         "aasbs_transmit_lu_transmittal_stage": spark.createDataFrame([("S1", "Stage", None)],
                                                                       "cd string, description string, is_deleted boolean")}
    rows = {(r.code_set, r.code_value): r for r in ref_code_tables(s, {}, "d").collect()}
    assert set(rows) == {("lu_instrument_type", "IAA"), ("lu_fund", "F1"), ("lu_transmittal_stage", "S1")}
    r = rows[("lu_instrument_type", "IAA")]
    assert (r.sort_order, r.short_desc, r.is_active_flag, r.source_table) == (2, "IA", True, "aasbs.lu_instrument_type")
    assert (rows[("lu_fund", "F1")].is_active_flag, rows[("lu_fund", "F1")].sort_order) == (False, None)
    assert rows[("lu_transmittal_stage", "S1")].source_table == "aasbs_transmit.lu_transmittal_stage"
    assert len(blocked_code_sets(s)) == 85 - 3


def test_load_target_records_audit(spark, tmpdir_run):
    import os
    from gildhall.operators import high_water, run_state
    from gildhall.plans.domain.load import load_target
    df = spark.createDataFrame([(1,), (2,)], "x int")
    audit = os.path.join(tmpdir_run, "audit")
    status = load_target(df, "common.dim_x", os.path.join(tmpdir_run, "dim_x"), audit, "r1", "2024-01-01T00:00:00",
                         rows_read=2)
    assert status == "SUCCESS"
    log = spark.read.parquet(audit)
    st = run_state(log).first()
    assert (st.run_status, st.rows_written, st.rows_read) == ("SUCCESS", 2, 2)
    # the first CDC window starts where the full load ended (D-3), not 24 h back
    hw = high_water(log, "common.dim_x", "2024-02-01 00:00:00").first()
    assert str(hw.watermark_from) == "2024-01-01 00:00:00"
