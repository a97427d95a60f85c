"""Accrual income fact: month decode, holdback, latest transmission, reconciliation."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.air_facts import distribution_recon, fact_accrual_income

T = dt.datetime


def _g(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_accrual_income(spark):
    s = {"aasbs_accrual_income_dist": _g(spark, [(1, 10, 5, D("60.00"), D("0.5000"), "PENDING", None),
                                                 (2, 10, 5, D("40.00"), None, None, None),
                                                 (3, 11, 6, D("10.00"), None, None, None)],
                                         "id bigint, accrual_income_id bigint, tracking_num bigint, distribute_amt decimal(15,2), "
                                         "proration_pct decimal(7,4), accrual_transmission_status_cd string, is_deleted boolean"),
         "aasbs_accrual_income": _g(spark, [(10, 2024, " jan ", 300, D("100.00"), "y", "manual", 70, None),
                                            (11, 2024, "02", 300, D("12.00"), None, None, None, None)],
                                    "id bigint, accrual_year int, accrual_month string, line_item_accepted_id bigint, "
                                    "accrual_income_amt decimal(15,2), include_in_transmission_yn string, "
                                    "accrual_income_calc_comment string, accrual_expense_id bigint, is_deleted boolean"),
         "aasbs_accrual_expense": _g(spark, [(70, 1000, D("50.00"), D("30.00"), None)],
                                     "id bigint, award_id bigint, accrual_expense_amt_before_holdback decimal(15,2), "
                                     "accrual_expense_amt_with_holdback_applied decimal(15,2), is_deleted boolean"),
         "aasbs_loa": _g(spark, [(100, 5, "A1", None), (101, 5, "A2", None)],
                         "id bigint, tracking_num bigint, agency_location_code string, is_deleted boolean"),
         "aasbs_award_ia": _g(spark, [(1000, 11, None)], "award_id bigint, ia_id bigint, is_deleted boolean"),
         "aasbs_transmit_accrual_income_header": _g(spark, [(7, 1, T(2024, 1, 1), "SENT", "DT0", None),
                                                            (8, 1, T(2024, 1, 2), "ACCEPTED", "DT1", None)],
                                                    "id bigint, accrual_income_dist_id bigint, created_dt timestamp_ntz, "
                                                    "transmittal_status_cd string, document_type string, is_deleted boolean"),
         "aasbs_transmit_accrual_income_acct_line": _g(spark, [(7, D("20.00"), None), (8, D("25.00"), None)],
                                                       "accrual_income_header_id bigint, transaction_currency_amt decimal(15,2), "
                                                       "is_deleted boolean"),
         "accrual_accrual_income_line": _g(spark, [(10, 9, None)], "accrual_income_id bigint, accrual_header_id bigint, is_deleted boolean"),
         "accrual_accrual_header": _g(spark, [(9, 44, None)], "accrual_header_id bigint, accrual_batch_id bigint, is_deleted boolean"),
         "aasbs_map_aac_onefund": _g(spark, [("A1", "Y", T(2020, 1, 1), "P1", None)],
                                     "activity_address_cd string, active_yn string, created_dt timestamp_ntz, "
                                     "onefund_program_cd string, is_deleted boolean"),
         "aasbs_map_onefund_program_accrual_income_doc_type": _g(spark, [("P1", "DTM", None, None)],
                                                                 "onefund_program_cd string, accrual_income_doc_type_cd string, "
                                                                 "active_yn string, is_deleted boolean")}
    g = {"common.dim_loa": _g(spark, [(100, 1, True)], "loa_id bigint, loa_sk bigint, is_current_flag boolean"),
         "common.dim_line_item": _g(spark, [(300, 2, True)], "line_item_accepted_id bigint, line_item_sk bigint, is_current_flag boolean"),
         "air.dim_accrual_period": _g(spark, [(2024, 1, 3), (2024, 2, 4)], "accrual_year int, accrual_month int, accrual_period_sk bigint"),
         "common.dim_agency": _g(spark, [("A1", 5, True)], "activity_address_cd string, agency_sk bigint, is_current_flag boolean"),
         "air.dim_onefund_program": _g(spark, [("A1", 6)], "aac string, onefund_sk bigint"),
         "common.dim_ia": _g(spark, [(11, 7, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean")}
    f = fact_accrual_income(s, g, "d")
    rows = {r.distributed_income_amt: r for r in f.collect()}
    assert len(rows) == 3                                            # tracking number with two LOAs does not fan out
    a = rows[D("60.00")]
    assert (a.loa_sk, a.line_item_sk, a.accrual_period_sk, a.agency_sk, a.onefund_sk, a.ia_sk, a.accrual_batch_id) == \
        (1, 2, 3, 5, 6, 7, 44)
    assert (a.holdback_amt, a.net_accrued_amt, a.baar_transmitted_amt, a.baar_transmission_status_cd,
            a.accrual_doc_type_cd, a.inclusion_override_flag) == (D("10.00"), D("50.00"), D("45.00"), "ACCEPTED", "DT1", True)
    b = rows[D("40.00")]
    assert (b.holdback_amt, b.baar_transmission_status_cd, b.accrual_doc_type_cd) == (D("0.00"), None, "DTM")
    c = rows[D("10.00")]
    assert (c.accrual_period_sk, c.holdback_amt, c.loa_sk) == (4, None, -1)
    recon = sorted((r.accrual_income_id, r.sum_distributed) for r in distribution_recon(f).collect())
    assert recon == [(11, D("10.00"))]                               # 10 distributed vs 12 calculated
