"""Award lifecycle fact: D-10 invoice/acceptance keys, D-18 IA bridge, no fan-out."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.alt_facts import fact_award_lifecycle

T = dt.datetime


def _g(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_award_lifecycle(spark):
    s = {"aasbs_line_item_accepted": _g(spark, [(300, 501, None), (301, 999, None)], "id bigint, award_mod_id bigint, is_deleted boolean"),
         "aasbs_award": _g(spark, [(1000, 100, 501, None)], "id bigint, acquisition_id bigint, latest_award_mod_id bigint, is_deleted boolean"),
         "aasbs_award_mod": _g(spark, [(500, 1000, "A0", T(2023, 1, 1), None), (501, 1000, "P01", T(2023, 6, 1), None)],
                               "id bigint, award_id bigint, mod_num string, m1p_mod_start_dt timestamp_ntz, is_deleted boolean"),
         "aasbs_award_mod_company": _g(spark, [(8, 501, None), (9, 501, None)], "id bigint, award_mod_id bigint, is_deleted boolean"),
         "aasbs_invoice_item": _g(spark, [(300, 70, None), (300, 70, None), (300, 71, None)],
                                  "cost_line_item_accepted_id bigint, invoice_id bigint, is_deleted boolean"),
         "aasbs_invoice": _g(spark, [(70, "ACCEPTED", None), (71, "SUBMITTED", None), (300, "SUBMITTED", None)],
                             "id bigint, invoice_status_cd string, is_deleted boolean"),
         "aasbs_acceptance_item": _g(spark, [(300, D("30.00"), None), (300, D("5.00"), None)],
                                     "line_item_accepted_id bigint, item_gsa_approved_amt decimal(15,2), is_deleted boolean"),
         "aasbs_accrual_expense": _g(spark, [(1, 300, T(2023, 5, 31), D("4.00"), None), (2, 300, T(2023, 6, 30), D("6.00"), None)],
                                     "id bigint, line_item_accepted_id bigint, accrual_month_end_dt timestamp_ntz, "
                                     "udo_amt decimal(15,2), is_deleted boolean"),
         "aasbs_award_ia": _g(spark, [(1000, 12, None), (1000, 11, None)], "award_id bigint, ia_id bigint, is_deleted boolean")}
    g = {"common.dim_line_item": _g(spark, [(300, 3, T(2024, 1, 31), D("100.00"), True)],
                                    "line_item_accepted_id bigint, line_item_sk bigint, li_pop_end_dt timestamp_ntz, "
                                    "obligated_ceiling_amt decimal(15,2), is_current_flag boolean"),
         "common.dim_award": _g(spark, [(501, 4, T(2023, 2, 1), True)],
                                "award_mod_id bigint, award_sk bigint, award_start_dt timestamp_ntz, is_current_flag boolean"),
         "alt.dim_acquisition": _g(spark, [(100, 5, 6, "POST_AWARD_ACTIVE", T(2023, 1, 1), True)],
                                   "acquisition_id bigint, acquisition_sk bigint, agency_sk bigint, acquisition_status_cd string, "
                                   "created_dt timestamp_ntz, is_current_flag boolean"),
         "alt.dim_solicitation": _g(spark, [(5, 21), (5, 20)], "acquisition_sk bigint, solicitation_sk bigint"),
         "alt.dim_closeout": _g(spark, [(100, 30)], "acquisition_id bigint, closeout_sk bigint"),
         "alt.dim_contractor": _g(spark, [(8, 40, True), (9, 41, True)], "award_mod_company_id bigint, contractor_sk bigint, "
                                                                        "is_current_flag boolean"),
         "common.dim_ia": _g(spark, [(11, 50, True), (300, 99, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean")}
    rows = {r.line_item_sk: r for r in fact_award_lifecycle(s, g, "2024-01-01").collect()}
    assert len(rows) == 2                                            # no fan-out from solicitations/contractors
    r = rows[3]
    assert (r.award_sk, r.acquisition_sk, r.solicitation_sk, r.contractor_sk, r.closeout_sk, r.ia_sk, r.agency_sk) == \
        (4, 5, 20, 40, 30, 50, 6)                                    # IA via bridge, not lia id (D-18)
    assert (r.total_invoices_count, r.pending_invoices_count, r.current_accepted_amt) == (2, 1, D("35.00"))  # D-10
    assert (r.current_udo_amt, r.accrual_holdback_amt, r.mods_count, r.current_proc_phase_cd) == \
        (D("65.00"), D("6.00"), 2, "POST_AWARD")
    assert (r.days_in_pre_award, r.days_to_pop_end, r.days_since_last_mod, r.award_date_sk) == (31, 30, 214, 20230201)
    o = rows[-1]
    assert (o.award_sk, o.acquisition_sk, o.ia_sk, o.current_proc_phase_cd, o.current_udo_amt) == (-1, -1, -1, "PRE_AWARD", D("0.00"))
