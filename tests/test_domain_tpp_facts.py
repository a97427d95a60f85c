"""tpp facts: multi-hop IA, one row per summary/invoice, multi-line report before reduction (D-11)."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.tpp_facts import fact_payment_reconciliation, fact_transmission_event, invoice_line_report

T = dt.datetime


def _g(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_transmission_event(spark):
    s = {"aasbs_transmit_billing_summary": _g(spark, [(1, 10, "AGR-1", "A1", D("100.00"), T(2024, 1, 5), "SENT", 77, None),
                                                      (2, 10, "AGR-9", "ZZ", None, None, "ERROR", 78, None)],
                                              "id bigint, transmittal_id bigint, agreement_num string, activity_address_cd string, "
                                              "billing_amount decimal(15,2), generated_dt timestamp_ntz, "
                                              "transmittal_status_cd string, billing_record_id bigint, is_deleted boolean"),
         "aasbs_transmit_transmittal": _g(spark, [(10, "BAAR", T(2024, 1, 6), 3, None)],
                                          "id bigint, transmittal_type_cd string, sent_dt timestamp_ntz, release_count int, "
                                          "is_deleted boolean"),
         "aasbs_loa": _g(spark, [(100, "AGR-1", None), (101, "AGR-1", None)], "id bigint, agreement_number string, is_deleted boolean"),
         "aasbs_loa_ledger": _g(spark, [(100, 12, None), (101, 11, None), (101, 11, None)],
                                "loa_id bigint, ia_id bigint, is_deleted boolean"),
         "aasbs_transmit_transmit_error": _g(spark, [(2, "billing_summary", 3, "bad", "E1", None), (2, "BILLING", 1, "worse", "E2", None)],
                                             "source_record_id bigint, source_table_name_cd string, retry_cnt int, "
                                             "error_description string, transmittal_type_cd string, is_deleted boolean"),
         "billing_billing_response_info": _g(spark, [(77, "y", None), (77, "N", None)],
                                             "billing_record_id bigint, accepted_status string, is_deleted boolean"),
         "agreement_agreement": _g(spark, [(5, "AGR-1", None)], "agreement_id bigint, agreement_num string, is_deleted boolean")}
    g = {"tpp.dim_transmittal_type": _g(spark, [("BAAR", 1)], "transmittal_type_cd string, transmittal_type_sk bigint"),
         "tpp.dim_aac_envelope": _g(spark, [("A1", 2)], "aac string, aac_envelope_sk bigint"),
         "tpp.dim_agreement": _g(spark, [(5, 3)], "agreement_id bigint, agreement_sk bigint"),
         "common.dim_ia": _g(spark, [(11, 4, True), (12, 5, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
         "common.dim_agency": _g(spark, [("A1", 6, True)], "activity_address_cd string, agency_sk bigint, is_current_flag boolean")}
    rows = {r.source_billing_summary_id: r for r in fact_transmission_event(s, g, "d").collect()}
    assert len(rows) == 2
    r = rows[1]
    assert (r.transmittal_type_sk, r.aac_envelope_sk, r.agreement_sk, r.ia_sk, r.agency_sk, r.batch_record_count,
            r.confirmed_amt, r.variance_amt, r.event_date_sk) == (1, 2, 3, 4, 6, 3, D("100.00"), D("0.00"), 20240105)
    e = rows[2]
    assert (e.retry_count, e.error_description, e.ia_sk, e.confirmed_amt, e.transmitted_amt) == (1, "worse", -1, None, D("0.00"))


def test_payment_reconciliation_and_multi_line(spark):
    s = {"aasbs_transmit_inv_summary": _g(spark, [(1, 50, "PO-1", "A1", "PEG1", D("90.00"), T(2024, 2, 1), None)],
                                          "id bigint, invoice_id bigint, purchase_order_number string, activity_address_cd string, "
                                          "pegasys_doc_num string, total_invoice_amount decimal(15,2), invoice_dt timestamp_ntz, "
                                          "is_deleted boolean"),
         "aasbs_invoice_item": _g(spark, [(50, 301, None), (50, 300, None), (51, 300, None)],
                                  "invoice_id bigint, cost_line_item_accepted_id bigint, is_deleted boolean"),
         "aasbs_invoice": _g(spark, [(50, None), (51, None)], "id bigint, is_deleted boolean"),
         "aasbs_transmit_rr_summary": _g(spark, [(8, 50, D("70.00"), None), (9, 50, D("80.00"), None)],
                                         "id bigint, invoice_id bigint, max_approved_amt decimal(15,2), is_deleted boolean"),
         "aasbs_transmit_po_summary": _g(spark, [(20, "PO-1", 500, None), (21, "PO-1", 501, None)],
                                         "id bigint, purchase_order_number string, award_mod_id bigint, is_deleted boolean"),
         "aasbs_transmit_po_line": _g(spark, [(20, D("60.00"), None), (21, D("40.00"), None)],
                                      "po_summary_id bigint, total_line_amt decimal(15,2), is_deleted boolean"),
         "aasbs_award_mod": _g(spark, [(500, 1000, None)], "id bigint, award_id bigint, is_deleted boolean"),
         "aasbs_award_ia": _g(spark, [(1000, 12, None), (1000, 11, None)], "award_id bigint, ia_id bigint, is_deleted boolean")}
    g = {"common.dim_line_item": _g(spark, [(300, 7, True)], "line_item_accepted_id bigint, line_item_sk bigint, is_current_flag boolean"),
         "tpp.dim_receiving_report": _g(spark, [(8, 9)], "rr_summary_id bigint, receiving_report_sk bigint"),
         "common.dim_ia": _g(spark, [(11, 4, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
         "common.dim_agency": _g(spark, [("A1", 6, True)], "activity_address_cd string, agency_sk bigint, is_current_flag boolean")}
    rows = fact_payment_reconciliation(s, g, "d").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.line_item_sk, r.rr_sk, r.ia_sk, r.agency_sk, r.po_amt, r.rr_amt, r.po_to_rr_variance_amt) == \
        (7, 9, 4, 6, D("100.00"), D("80.00"), D("20.00"))
    multi = [(x.invoice_id, x.n_lines) for x in invoice_line_report(s).collect()]
    assert multi == [(50, 2)]                                        # counted before the pick-one (D-11)
