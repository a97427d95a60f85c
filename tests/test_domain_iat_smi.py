"""iat and smi dimensions."""

import datetime as dt

from gildhall.plans.domain.iat_smi import dim_fin_code_history, dim_piid, dim_posting_type, dim_reviewer


def test_reviewer_and_fin_history(spark):
    reviews = spark.createDataFrame([("7", None), ("7", None), ("8", None), (None, None)],
                                    "service_agency_reviewer_id string, is_deleted boolean")
    users = spark.createDataFrame([(7, "Ann", None, "Lee", "ACTIVE", None, None)],
                                  "id bigint, first_name string, middle_initial string, last_name string, "
                                  "reg_status string, inactive_date timestamp_ntz, is_deleted boolean")
    rows = {r.reviewer_user_id: r for r in dim_reviewer({"aasbs_ia_review": reviews, "assist_users": users}, {}, "d").collect()}
    assert (rows["7"].reviewer_name, rows["7"].is_active_flag) == ("Ann Lee", True)
    assert (rows["8"].reviewer_name, rows["8"].is_active_flag) == (None, None)
    log = spark.createDataFrame([(1, "F1", "b1", dt.datetime(2020, 1, 1), 5, None), (2, "F1", "b1", None, 5, None),
                                 (3, "F2", "b2", None, 6, None)],
                                "id bigint, fin string, fin_base_10 string, created_dt timestamp_ntz, "
                                "created_by_user_id bigint, is_deleted boolean")
    h = {r.fin_log_id: (r.is_current_flag, r.award_sk) for r in dim_fin_code_history({"aasbs_award_fin_log": log}, {}, "d").collect()}
    assert h == {1: (False, -1), 2: (True, -1), 3: (True, -1)}


def test_posting_type_and_piid(spark):
    s = {
        "aasbs_solicit": spark.createDataFrame([(1, None), (2, None), (3, None), (4, None)], "id bigint, is_deleted boolean"),
        "aasbs_solicit_amendment": spark.createDataFrame([(10, 1, None), (20, 2, None), (30, 3, None)],
                                                         "id bigint, solicit_id bigint, is_deleted boolean"),
        "aasbs_solicit_posting_direct": spark.createDataFrame(
            [(100, 10, "SOLE", "EXT", None, None), (200, 20, "JA", None, None, None)],
            "id bigint, solicit_amendment_id bigint, reason_for_direct_cd string, external_source_ref string, "
            "open_dt timestamp_ntz, is_deleted boolean"),
        "aasbs_solicit_posting_connect": spark.createDataFrame([(300, 30, 9, None, None)],
                                                               "id bigint, solicit_amendment_id bigint, "
                                                               "pm_responsible_user_id bigint, open_dt timestamp_ntz, "
                                                               "is_deleted boolean"),
    }
    pt = {r.solicit_id: r.posting_type_cd for r in dim_posting_type(s, {}, "d").collect()}
    assert pt == {1: "DIRECT_CONNECT", 2: "DIRECT", 3: "OPEN", 4: "INFORMAL"}
    aw = spark.createDataFrame([(1, "47QA0123F0042", 5, None), (2, "SHORT", None, None), (3, "47QA01XXF0042", None, None)],
                               "id bigint, award_piid string, latest_award_mod_id bigint, is_deleted boolean")
    mods = spark.createDataFrame([(5, "P0001", None)], "id bigint, award_piid_ext string, is_deleted boolean")
    rows = {r.piid_id: r for r in dim_piid({"aasbs_award": aw, "aasbs_award_mod": mods}, {}, "d").collect()}
    r = rows[1]
    assert (r.aac, r.piid_fiscal_year, r.instrument_type_cd, r.sequence_num, r.piid_ext) == ("47QA01", 2023, "F", "0042", "P0001")
    assert (rows[2].aac, rows[2].piid_fiscal_year) == (None, None)
    assert (rows[3].aac, rows[3].piid_fiscal_year) == ("47QA01", None)
