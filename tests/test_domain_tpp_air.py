"""tpp and air dimensions (D-19 open-ended suspension)."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.tpp_air import (
    dim_aac_envelope, dim_agreement, dim_onefund_program, dim_receiving_report, dim_transmittal_type,
)

T = dt.datetime
CODE = "cd string, description string, is_deleted boolean"


def test_transmittal_and_envelope(spark):
    s = {"aasbs_transmit_lu_transmittal_type": spark.createDataFrame([("BAAR", "Billing", "F1", None)],
                                                                     "cd string, description string, flatfile_cd string, is_deleted boolean"),
         "aasbs_transmit_transmittal_spec_version": spark.createDataFrame([("BAAR", 2, None), ("BAAR", 5, None)],
                                                                          "transmittal_type_cd string, specification_version int, is_deleted boolean"),
         "aasbs_transmit_aac_envelope": spark.createDataFrame([("A1", T(2023, 1, 1), 1, None, "OLD", "BAAR", 7),
                                                               ("A1", T(2024, 1, 1), 2, None, "NEW", "BAAR", 7)],
                                                              "activity_address_cd string, created_dt timestamp_ntz, id bigint, "
                                                              "is_deleted boolean, transmittal_status_cd string, "
                                                              "transmittal_type_cd string, transmittal_poc_id bigint"),
         "aasbs_transmit_transmittal_poc": spark.createDataFrame([(7, "Pat", "p@x", None)],
                                                                 "id bigint, poc_name string, poc_email string, is_deleted boolean"),
         "aasbs_transmit_billing_summary": spark.createDataFrame([("A1", T(2024, 2, 1), None)],
                                                                 "activity_address_cd string, generated_dt timestamp_ntz, is_deleted boolean"),
         "aasbs_transmit_transmittal_suspension": spark.createDataFrame(
             [("BAAR", T(2023, 1, 1), T(2023, 2, 1), None), ("BAAR", T(2023, 6, 1), None, None)],
             "transmittal_type_cd string, suspend_start_dt timestamp_ntz, suspend_end_dt timestamp_ntz, is_deleted boolean")}
    tt = dim_transmittal_type(s, {}, "d").first()
    assert (tt.spec_version, tt.flat_file_code) == (5, "F1")
    e = dim_aac_envelope(s, {}, "2024-03-01").collect()
    assert len(e) == 1
    r = e[0]
    assert (r.envelope_status_cd, r.poc_name, r.last_transmission_dt, r.is_suspended_flag, r.suspension_end_dt) == \
        ("NEW", "Pat", T(2024, 2, 1), True, None)                    # open-ended suspension kept (D-19)


def test_agreement_rr_onefund(spark):
    s = {"agreement_agreement": spark.createDataFrame([(1, "AG-1", "FUNDED", "2024-01", D("100.00"), None)],
                                                      "agreement_id bigint, agreement_num string, funding_status string, "
                                                      "acct_period string, maximum_agreement_amt decimal(15,2), is_deleted boolean"),
         "agreement_agreement_line": spark.createDataFrame([(1, None), (1, None)], "agreement_id bigint, is_deleted boolean"),
         "agreement_agreement_log": spark.createDataFrame([(1, "accepted", T(2024, 1, 2), None), (1, "REJECTED", T(2024, 2, 2), None)],
                                                          "agreement_id bigint, transmission_status string, "
                                                          "response_date timestamp_ntz, is_deleted boolean"),
         "aasbs_transmit_rr_summary": spark.createDataFrame([(5, "INV5", None, D("9.00"), 2, None)],
                                                            "id bigint, pegasys_invoice_number string, accepted_dt timestamp_ntz, "
                                                            "max_approved_amt decimal(15,2), number_of_detail_lines int, is_deleted boolean"),
         "aasbs_transmit_rr_detail": spark.createDataFrame([(5, D("1.50"), None), (5, None, None)],
                                                           "rr_summary_id bigint, total_mdl_amount decimal(15,2), is_deleted boolean"),
         "aasbs_map_aac_onefund": spark.createDataFrame([("A1", "N", T(2020, 1, 1), "F0", "ACT", "P0", "OC", None),
                                                         ("A1", "Y", T(2022, 1, 1), "F1", "ACT", "P1", "OC", None)],
                                                        "activity_address_cd string, active_yn string, created_dt timestamp_ntz, "
                                                        "fund_cd string, onefund_activity_cd string, onefund_program_cd string, "
                                                        "object_class_cd string, is_deleted boolean"),
         "aasbs_map_onefund_program_accrual_income_doc_type": spark.createDataFrame(
             [("P1", "DT1", None, None)], "onefund_program_cd string, accrual_income_doc_type_cd string, active_yn string, "
                                          "is_deleted boolean"),
         "aasbs_lu_onefund_program": spark.createDataFrame([("P1", "Program One", None)], CODE),
         "aasbs_lu_onefund_activity": spark.createDataFrame([], CODE),
         "aasbs_lu_accrual_income_doc_type": spark.createDataFrame([("DT1", "Doc type", None)], CODE)}
    ag = dim_agreement(s, {}, "d").first()
    assert (ag.line_count, ag.last_transmitted_dt) == (2, T(2024, 1, 2))
    rr = dim_receiving_report(s, {}, "d").first()
    assert rr.mdl_amt == D("1.50")
    of = dim_onefund_program(s, {}, "d").collect()
    assert len(of) == 1
    assert (of[0].onefund_fund_cd, of[0].baar_doc_type_cd, of[0].baar_doc_type_desc, of[0].program_desc,
            of[0].activity_desc) == ("F1", "DT1", "Doc type", "Program One", None)
