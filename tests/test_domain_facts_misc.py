"""Service charge schedule fact and blocked facts."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.blocked import blocked_event, fact_review_determination, fact_role_assignment
from gildhall.plans.domain.psc_facts import fact_service_charge_schedule

T = dt.datetime


def test_service_charge_schedule(spark):
    s = {"aasbs_service_charge_schedule": spark.createDataFrame(
            [(1, 7, T(2024, 1, 1), T(2024, 1, 31), D("100.00"), "OPEN", None),
             (2, 7, T(2024, 2, 1), T(2024, 2, 29), D("0.00"), "OPEN", None)],
            "id bigint, line_item_id bigint, service_start_dt timestamp_ntz, service_end_dt timestamp_ntz, "
            "scheduled_amt decimal(15,2), sc_schedule_status_cd string, is_deleted boolean"),
         "aasbs_line_item": spark.createDataFrame([(7, 55, 500, 10, 9, None)],
                                                  "id bigint, service_charge_id bigint, parent_award_mod_id bigint, "
                                                  "parent_ia_id bigint, li_sc_travel_id bigint, is_deleted boolean"),
         "aasbs_line_item_accepted": spark.createDataFrame([(70, 7, None), (71, 7, None)],
                                                           "id bigint, line_item_id bigint, is_deleted boolean"),
         "aasbs_invoice_item": spark.createDataFrame(
             [(71, 1, T(2024, 1, 2), T(2024, 1, 30), D("95.00"), None), (71, 2, T(2024, 1, 30), T(2024, 2, 2), D("7.00"), None)],
             "cost_line_item_accepted_id bigint, id bigint, invoice_item_begin_dt timestamp_ntz, "
             "invoice_item_end_dt timestamp_ntz, invoice_item_amt decimal(15,2), is_deleted boolean"),
         "aasbs_award_mod": spark.createDataFrame([(500, 1000, None)], "id bigint, award_id bigint, is_deleted boolean")}
    g = {"common.dim_line_item": spark.createDataFrame([(71, 3, True)], "line_item_accepted_id bigint, line_item_sk bigint, "
                                                                        "is_current_flag boolean"),
         "psc.dim_billing_period": spark.createDataFrame([(1, 11), (2, 12)], "schedule_id bigint, billing_period_sk bigint"),
         "common.dim_award": spark.createDataFrame([(1000, 4, True)], "award_id bigint, award_sk bigint, is_current_flag boolean"),
         "common.dim_ia": spark.createDataFrame([(10, 5, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean")}
    rows = {r.billing_period_sk: r for r in fact_service_charge_schedule(s, g, "d").collect()}
    r = rows[11]
    assert (r.line_item_sk, r.award_sk, r.ia_sk, r.invoiced_amt, r.on_schedule_flag, r.travel_voucher_count,
            r.travel_voucher_amt, r.source_service_charge_id) == (3, 4, 5, D("95.00"), True, 1, D("95.00"), 55)
    assert (rows[12].invoiced_amt, rows[12].on_schedule_flag) == (D("0.00"), None)


def test_blocked_facts(spark):
    s = {"x": spark.range(1)}
    ra = fact_role_assignment(s, {}, "d")
    rd = fact_review_determination(s, {}, "d")
    assert ra.count() == 0 and rd.count() == 0
    assert "total_obligated_amt" in ra.columns and "days_to_determination" in rd.columns
    ev = blocked_event(spark, "wpr.fact_role_assignment", "r1", "2024-01-01T00:00:00").first()
    assert ev.run_status == "BLOCKED" and "silver_aasbs_award_role" in ev.message


def test_clin_pricing_burn_order(spark):
    from gildhall.plans.domain.psc_facts import fact_clin_pricing
    SUB = "id bigint, planned_amt decimal(15,2), cost_rate_type_cd string, is_deleted boolean"
    s = {"aasbs_line_item": spark.createDataFrame([(7, None, 20, None, None, None, D("500.00"), 500, 10, None)],
                                                  "id bigint, li_deliverable_id bigint, li_sc_labor_id bigint, "
                                                  "li_sc_fixed_fee_id bigint, li_sc_travel_id bigint, li_award_fee_id bigint, "
                                                  "line_item_total_amt decimal(15,2), parent_award_mod_id bigint, "
                                                  "parent_ia_id bigint, is_deleted boolean"),
         "aasbs_line_item_accepted": spark.createDataFrame([(70, 7, None), (71, 7, None)],
                                                           "id bigint, line_item_id bigint, is_deleted boolean"),
         "aasbs_loa_ledger": spark.createDataFrame([(70, 200, 5, None), (71, 100, 9, None), (71, 200, 3, None)],
                                                   "line_item_accepted_id bigint, loa_id bigint, id bigint, is_deleted boolean"),
         "aasbs_li_sc_labor": spark.createDataFrame([(20, D("300.00"), "ACT", None)], SUB),
         "aasbs_li_sc_fixed_fee": spark.createDataFrame([], SUB), "aasbs_li_sc_travel": spark.createDataFrame([], SUB),
         "aasbs_invoice_item": spark.createDataFrame([(71, D("40.00"), None), (70, D("2.00"), None)],
                                                     "cost_line_item_accepted_id bigint, invoice_item_amt decimal(15,2), "
                                                     "is_deleted boolean"),
         "aasbs_award_mod": spark.createDataFrame([(500, 1000, None)], "id bigint, award_id bigint, is_deleted boolean")}
    g = {"common.dim_line_item": spark.createDataFrame([(71, 3, True)], "line_item_accepted_id bigint, line_item_sk bigint, "
                                                                        "is_current_flag boolean"),
         "psc.dim_clin_subtype": spark.createDataFrame([(7, 8)], "line_item_id bigint, clin_subtype_sk bigint"),
         "psc.dim_cost_rate_type": spark.createDataFrame([("ACT", 6)], "cost_rate_type_cd string, cost_rate_type_sk bigint"),
         "common.dim_award": spark.createDataFrame([(1000, 4, True)], "award_id bigint, award_sk bigint, is_current_flag boolean"),
         "common.dim_ia": spark.createDataFrame([(10, 5, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
         "common.dim_loa": spark.createDataFrame([(100, 1, True), (200, 2, True)], "loa_id bigint, loa_sk bigint, "
                                                                                   "is_current_flag boolean")}
    rows = {r.loa_sk: r for r in fact_clin_pricing(s, g, "d").collect()}
    assert {k: r.loa_burn_order for k, r in rows.items()} == {2: 1, 1: 2}   # LOA 200 burns first (ledger id 3)
    r = rows[2]
    assert (r.planned_amt, r.actual_amt, r.cost_rate_type_sk, r.clin_subtype_sk, r.line_item_sk) == \
        (D("300.00"), D("42.00"), 6, 8, 3)
