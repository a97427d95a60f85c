"""psc dimensions: one-scan subtype union, billing periods with containment."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.psc import dim_billing_period, dim_clin_subtype

LI = ("id bigint, is_deleted boolean, li_deliverable_id bigint, li_sc_labor_id bigint, li_sc_fixed_fee_id bigint, "
      "li_sc_travel_id bigint, li_award_fee_id bigint, service_charge_id bigint")
SC_SUB = "id bigint, is_deleted boolean, proc_phase_cd string, project_num string, severability_type_cd string"


def test_clin_subtype(spark):
    s = {
        "aasbs_line_item": spark.createDataFrame([(1, None, 10, None, None, None, None, None),
                                                  (2, None, None, 20, None, None, 40, 5),
                                                  (3, True, 11, None, None, None, None, None)], LI),
        "aasbs_li_deliverable": spark.createDataFrame([(10, None, "R499", "FFP", "S"), (11, None, "X", "Y", "Z")],
                                                      "id bigint, is_deleted boolean, psc_cd string, contract_type_cd string, "
                                                      "severability_type_cd string"),
        "aasbs_li_sc_labor": spark.createDataFrame([(20, None, "P1", "PRJ", "NS")], SC_SUB),
        "aasbs_li_sc_fixed_fee": spark.createDataFrame([], SC_SUB),
        "aasbs_li_sc_travel": spark.createDataFrame([], SC_SUB),
        "aasbs_li_award_fee": spark.createDataFrame([(40, None)], "id bigint, is_deleted boolean"),
        "aasbs_service_charge": spark.createDataFrame([(5, "ACT9", "y", None)],
                                                      "id bigint, act_number string, is_credit_yn string, is_deleted boolean"),
        "aasbs_lu_proc_phase": spark.createDataFrame([("P1", "Phase One", None)], "cd string, description string, is_deleted boolean"),
    }
    rows = {(r.line_item_id, r.clin_subtype_cd): r for r in dim_clin_subtype(s, {}, "d").collect()}
    assert set(rows) == {(1, "DELIVERABLE"), (2, "SC_LABOR"), (2, "AWARD_FEE")}
    assert (rows[(1, "DELIVERABLE")].psc_cd, rows[(1, "DELIVERABLE")].is_credit_flag) == ("R499", None)
    lab = rows[(2, "SC_LABOR")]
    assert (lab.proc_phase_desc, lab.project_num, lab.is_credit_flag, lab.act_num) == ("Phase One", "PRJ", True, "ACT9")
    assert rows[(2, "AWARD_FEE")].act_num is None


def test_billing_period(spark):
    t = dt.datetime
    s = {
        "aasbs_service_charge_schedule": spark.createDataFrame(
            [(1, 7, t(2024, 1, 1), t(2024, 1, 31), D("100.00"), None), (2, 7, t(2024, 2, 1), t(2024, 2, 29), D("0.00"), None)],
            "id bigint, line_item_id bigint, service_start_dt timestamp_ntz, service_end_dt timestamp_ntz, "
            "scheduled_amt decimal(15,2), is_deleted boolean"),
        "aasbs_line_item_accepted": spark.createDataFrame([(70, 7, None), (71, 7, None)],
                                                          "id bigint, line_item_id bigint, is_deleted boolean"),
        "aasbs_invoice_item": spark.createDataFrame(
            [(71, t(2024, 1, 1), t(2024, 1, 31), D("80.00"), None),      # equal bounds: inside
             (71, t(2024, 1, 20), t(2024, 2, 5), D("50.00"), None),      # straddles: excluded
             (70, t(2024, 1, 5), t(2024, 1, 6), D("9.00"), None)],       # older accepted version: excluded
            "cost_line_item_accepted_id bigint, invoice_item_begin_dt timestamp_ntz, invoice_item_end_dt timestamp_ntz, "
            "invoice_item_amt decimal(15,2), is_deleted boolean"),
    }
    rows = {r.schedule_id: r for r in dim_billing_period(s, {}, "d").collect()}
    assert (rows[1].billing_period_label, rows[1].invoiced_amt, rows[1].variance_pct) == ("2024-M01", D("80.00"), D("-0.2000"))
    assert (rows[2].invoiced_amt, rows[2].variance_pct) == (D("0.00"), None)
