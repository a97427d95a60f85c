"""FPDS transaction fact: per-mod aggregates, first line PSC, no fan-out on companies."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.fre_facts import fact_fpds_transaction

T = dt.datetime


def _g(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_fpds_transaction(spark):
    s = {"aasbs_award_mod": _g(spark, [(500, 1000, "0", None, None, "DRAFT", T(2024, 1, 5), None),
                                       (501, 1000, "P01", "TERMINATION", None, "SUBMITTED", None, None)],
                               "id bigint, award_id bigint, mod_num string, m1p_sf30_mod_type_cd string, "
                               "m1p_award_mod_fpds_reason_cd string, fpds_car_status_cd string, co_signature_dt timestamp_ntz, "
                               "is_deleted boolean"),
         "aasbs_award": _g(spark, [(1000, 100, 60, "A1", None)], "id bigint, acquisition_id bigint, solicit_id bigint, "
                                                                 "lead_svc_activity_address_cd string, is_deleted boolean"),
         "aasbs_line_item_accepted": _g(spark, [(300, 500, 7, None), (301, 500, 8, None)],
                                        "id bigint, award_mod_id bigint, line_item_id bigint, is_deleted boolean"),
         "aasbs_loa_ledger": _g(spark, [(300, 100, 11, D("10.00"), None), (301, 101, 12, D("5.00"), None)],
                                "line_item_accepted_id bigint, loa_id bigint, ia_id bigint, "
                                "line_item_obligated_amt decimal(15,2), is_deleted boolean"),
         "aasbs_loa": _g(spark, [(100, 9, "F1", None), (101, 8, "F2", None)],
                         "id bigint, tracking_num bigint, agency_location_code string, is_deleted boolean"),
         "aasbs_line_item": _g(spark, [(7, "0002", 70, None), (8, "0001", 80, None)],
                               "id bigint, line_item_num string, li_deliverable_id bigint, is_deleted boolean"),
         "aasbs_li_deliverable": _g(spark, [(70, "R499", None), (80, "D302", None)], "id bigint, psc_cd string, is_deleted boolean"),
         "aasbs_award_mod_company": _g(spark, [(5, 500, None), (6, 500, None)], "id bigint, award_mod_id bigint, is_deleted boolean"),
         "aasbs_acquisition_plan": _g(spark, [(100, "FULL", T(2023, 1, 1), None)],
                                      "acquisition_id bigint, competition_type_cd string, created_dt timestamp_ntz, is_deleted boolean"),
         "aasbs_snap_award_mod_amts": _g(spark, [(500, D("1.00"), D("2.00"), D("3.00"), D("4.00"), None)],
                                         "award_mod_id bigint, base_exc_opt_amt decimal(15,2), base_all_opt_amt decimal(15,2), "
                                         "cum_funded_amt decimal(15,2), cost_to_client_total_amt decimal(15,2), is_deleted boolean"),
         "aasbs_solicit_response": _g(spark, [(1, 60, None), (2, 60, None), (3, 61, None)],
                                      "id bigint, solicit_id bigint, is_deleted boolean")}
    g = {"fre.dim_fpds_award": _g(spark, [(1000, 1)], "award_id bigint, fpds_award_sk bigint"),
         "fre.dim_fpds_agency": _g(spark, [("A1", 2), ("F1", 3)], "aac string, fpds_agency_sk bigint"),
         "fre.dim_fpds_psc": _g(spark, [("D302", 4)], "psc_cd string, psc_sk bigint"),
         "common.dim_award": _g(spark, [(1000, 5, True)], "award_id bigint, award_sk bigint, is_current_flag boolean"),
         "common.dim_ia": _g(spark, [(11, 6, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
         "common.dim_loa": _g(spark, [(100, 7, True)], "loa_id bigint, loa_sk bigint, is_current_flag boolean"),
         "fre.dim_fpds_contractor": _g(spark, [(5, 8, True), (6, 9, True)],
                                       "award_mod_company_id bigint, fpds_contractor_sk bigint, is_current_flag boolean"),
         "alt.dim_contractor": _g(spark, [(5, True, True)], "award_mod_company_id bigint, small_business_flag boolean, "
                                                            "is_current_flag boolean")}
    rows = {r.award_mod_id: r for r in fact_fpds_transaction(s, g, "d").collect()}
    assert len(rows) == 2                                            # two companies on mod 500 do not fan out
    a = rows[500]
    assert (a.fpds_award_sk, a.fpds_agency_sk, a.funding_agency_sk, a.psc_sk, a.award_sk, a.ia_sk, a.loa_sk,
            a.fpds_contractor_sk) == (1, 2, 3, 4, 5, 6, 7, 8)          # PSC of line 0001 (first child)
    assert (a.action_type_cd, a.action_obligation_amt, a.po_tracking_num, a.base_all_opts_amt, a.is_small_business_flag,
            a.competition_type_cd, a.number_of_offers, a.action_date_sk) == \
        ("A", D("15.00"), 8, D("2.00"), True, "FULL", 2, 20240105)
    b = rows[501]
    assert (b.action_type_cd, b.action_obligation_amt, b.fpds_contractor_sk, b.psc_sk, b.loa_sk) == ("D", D("0.00"), -1, None, None)
