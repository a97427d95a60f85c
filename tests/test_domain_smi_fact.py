"""Solicitation response fact: two-path contractor lookup, current versions only."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.smi_facts import fact_solicitation_response

T = dt.datetime


def _g(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_solicitation_response(spark):
    s = {"aasbs_solicit_response": _g(spark, [(1, 50, 900, "D1", "Y", "N", T(2024, 1, 2), None),
                                              (2, 50, None, "D2", "N", "y", None, None)],
                                      "id bigint, solicit_id bigint, solicit_company_id bigint, response_company_duns string, "
                                      "winning_response_yn string, no_response_yn string, "
                                      "latest_response_update_dt timestamp_ntz, is_deleted boolean"),
         "aasbs_solicit": _g(spark, [(50, 100, None)], "id bigint, acquisition_id bigint, is_deleted boolean"),
         "aasbs_award": _g(spark, [(1000, 1, 501, None)], "id bigint, solicit_response_id bigint, latest_award_mod_id bigint, "
                                                          "is_deleted boolean"),
         "aasbs_award_ia": _g(spark, [(1000, 11, None)], "award_id bigint, ia_id bigint, is_deleted boolean"),
         "aasbs_snap_award_mod_amts": _g(spark, [(501, D("250.00"))], "award_mod_id bigint, cum_funded_amt decimal(15,2)"),
         "aasbs_award_mod": _g(spark, [(501, T(2024, 2, 1), None)], "id bigint, co_signature_dt timestamp_ntz, is_deleted boolean"),
         "aasbs_solicit_company": _g(spark, [(900, 77, None)], "id bigint, ipartner_id bigint, is_deleted boolean"),
         "aasbs_award_mod_company": _g(spark, [(5, 77, None), (6, 77, None)], "id bigint, ipartner_id bigint, is_deleted boolean"),
         "aasbs_acquisition": _g(spark, [(100, "A1", None)], "id bigint, activity_address_cd string, is_deleted boolean")}
    g = {"alt.dim_contractor": _g(spark, [(5, "D1", 1, True, True), (8, "D2", 2, False, True), (9, "D2", 3, True, True),
                                          (10, "D2", 4, False, False)],
                                  "award_mod_company_id bigint, duns_num string, contractor_sk bigint, "
                                  "small_business_flag boolean, is_current_flag boolean"),
         "alt.dim_solicitation": _g(spark, [(50, 7)], "solicit_id bigint, solicitation_sk bigint"),
         "alt.dim_acquisition": _g(spark, [(100, 8, True), (100, 99, False)],
                                   "acquisition_id bigint, acquisition_sk bigint, is_current_flag boolean"),
         "smi.dim_posting_type": _g(spark, [(50, 6)], "solicit_id bigint, posting_type_sk bigint"),
         "smi.dim_piid": _g(spark, [(1000, 5)], "piid_id bigint, piid_sk bigint"),
         "common.dim_agency": _g(spark, [("A1", 4, True)], "activity_address_cd string, agency_sk bigint, is_current_flag boolean"),
         "common.dim_ia": _g(spark, [(11, 3, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean")}
    rows = {r.source_response_id: r for r in fact_solicitation_response(s, g, "d").collect()}
    assert len(rows) == 2
    a = rows[1]
    assert (a.contractor_sk, a.is_small_business_flag, a.acquisition_sk, a.ia_sk, a.piid_sk, a.award_total_amt,
            a.response_status_cd, a.award_date_sk) == (1, True, 8, 3, 5, D("250.00"), "AWARDED", 20240201)
    b = rows[2]
    assert (b.contractor_sk, b.is_small_business_flag, b.response_status_cd, b.award_total_amt, b.piid_sk) == \
        (2, False, "NO_RESPONSE", None, None)                      # DUNS path, current rows only
