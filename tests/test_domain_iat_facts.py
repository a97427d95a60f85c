"""IA amendment and review facts (LAG deltas, D-14 one funding per IA)."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.iat_facts import fact_ia_amendment, fact_ia_review

T = dt.datetime
AM = ("id bigint, ia_id bigint, piid_ext string, ia_amend_action_cd string, direct_cost_est_amt decimal(15,2), "
      "charges_est_amt decimal(15,2), end_dt timestamp_ntz, service_agency_signed_dt timestamp_ntz, "
      "request_agency_signed_dt timestamp_ntz, created_dt timestamp_ntz, is_deleted boolean")


def _gold(spark):
    g = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "common.dim_agency": g([("A1", 3, True)], "activity_address_cd string, agency_sk bigint, is_current_flag boolean"),
        "common.dim_ia": g([(10, 1, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
        "common.dim_funding": g([(7, 70, True), (8, 80, True)], "funding_id bigint, funding_sk bigint, is_current_flag boolean"),
        "common.dim_loa": g([(100, 5, True)], "loa_id bigint, loa_sk bigint, is_current_flag boolean"),
        "iat.dim_amend_action": g([("COST", 4)], "amend_action_cd string, amend_action_sk bigint"),
        "iat.dim_reviewer": g([("42", 9)], "reviewer_user_id string, reviewer_sk bigint"),
    }


def test_amendment_deltas_and_no_fanout(spark):
    s = {"aasbs_ia_amendment": spark.createDataFrame([
            (1, 10, "01", "COST", D("100.00"), D("10.00"), T(2024, 1, 31), T(2024, 1, 5), T(2024, 1, 6), T(2024, 1, 1), None),
            (2, 10, "02", "X", D("150.00"), None, T(2024, 3, 31), T(2024, 2, 5), None, T(2024, 2, 1), None),
            (3, 10, "x3", None, None, None, None, None, None, T(2024, 3, 1), None)], AM),
         "aasbs_ia": spark.createDataFrame([(10, "A1", "SVC", None)], "id bigint, activity_address_cd string, "
                                                                     "serv_agency_cd string, is_deleted boolean"),
         "aasbs_funding": spark.createDataFrame([(7, 10, 700, None), (8, 10, 800, None)],
                                                "id bigint, ia_id bigint, latest_funding_amendment_id bigint, is_deleted boolean"),
         "aasbs_funding_amendment_loa": spark.createDataFrame([(700, 100, D("5.00"), None), (700, 101, D("6.00"), None)],
                                                              "funding_amendment_id bigint, loa_id bigint, "
                                                              "loa_change_amt decimal(15,2), is_deleted boolean")}
    rows = {r.source_ia_amendment_id: r for r in fact_ia_amendment(s, _gold(spark), "d").collect()}
    assert len(rows) == 3                                            # one row per amendment (D-14)
    a1, a2, a3 = rows[1], rows[2], rows[3]
    assert (a1.cost_change_amt, a1.pop_extension_days, a1.amendment_status_cd, a1.amend_action_sk) == (None, None, "FINAL", 4)
    assert (a2.cost_change_amt, a2.pop_extension_days, a2.amendment_status_cd, a2.amend_action_sk) == \
        (D("40.00"), 60, "PENDING_REQUEST", -1)
    assert (a3.cost_change_amt, a3.amendment_num, a3.amendment_status_cd, a3.amend_date_sk) == (D("-150.00"), None, "DRAFT", 20240301)
    assert (a1.funding_sk, a1.loa_sk, a1.loa_change_amt, a1.agency_sk, a1.servicing_aac_cd) == (70, 5, D("11.00"), 3, "SVC")


def test_review(spark):
    s = {"aasbs_ia_review": spark.createDataFrame([(1, 10, "42", T(2024, 10, 2), "h", None), (2, 99, None, None, None, None)],
                                                  "id bigint, ia_id bigint, service_agency_reviewer_id string, "
                                                  "review_dt timestamp_ntz, attach_hash_id string, is_deleted boolean"),
         "aasbs_ia": spark.createDataFrame([(10, "A1", "SVC", None)], "id bigint, activity_address_cd string, "
                                                                     "serv_agency_cd string, is_deleted boolean")}
    rows = {r.source_ia_review_id: r for r in fact_ia_review(s, _gold(spark), "d").collect()}
    assert (rows[1].ia_sk, rows[1].reviewer_sk, rows[1].agency_sk, rows[1].review_fiscal_year, rows[1].has_attachment_flag) == \
        (1, 9, 3, 2025, True)
    assert (rows[2].ia_sk, rows[2].reviewer_sk, rows[2].agency_sk, rows[2].review_date_sk) == (-1, -1, -1, None)
