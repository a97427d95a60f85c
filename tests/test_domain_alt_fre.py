"""alt and fre dimensions, with the D-12/D-17/D-18/D-20 corrections."""

import datetime as dt
from decimal import Decimal as D

from gildhall.plans.domain.alt_fre import (
    dim_acquisition, dim_closeout, dim_contractor, dim_fpds_agency, dim_fpds_award, dim_fpds_contractor,
    dim_fpds_psc, dim_solicitation,
)

T = dt.datetime
CODE = "cd string, description string, is_deleted boolean"
AMC = ("_ingested_at timestamp_ntz, award_mod_id bigint, business_type_cd string, company_duns string, "
       "company_uei string, id bigint, ipartner_id bigint, is_deleted boolean, solicit_company_name string")
IP = ("city string, country string, creation_date timestamp_ntz, ipartner_cage_code string, ipartner_id bigint, "
      "ipartner_parent_name string, ipartner_parent_uei string, state string, zip string")
PLAN = ("acquisition_id bigint, ap_cor_delegation_cd string, ap_emergency_acq_cd string, ap_intel_community_cd string, "
        "ap_supply_chain_risk_cd string, ap_surveillance_spec_cd string, commercial_type_cd string, "
        "competition_type_cd string, contract_type_cd string, created_dt timestamp_ntz, expedited_type_cd string, "
        "idv_referenced_class_cd string, idv_who_can_use_cd string, is_deleted boolean, processing_speed_cd string")


def test_contractor_keeps_latest_row(spark):
    s = {"aasbs_award_mod_company": spark.createDataFrame([
            (T(2024, 1, 1), 1, "SMALL_BUSINESS", "d1", "U-OLD", 5, 9, None, "Old"),
            (T(2024, 2, 1), 1, "WOMEN_OWNED_SMALL_BUSINESS", "d1", "U-NEW", 5, 9, None, "New")], AMC),
         "table_master_industry_partners": spark.createDataFrame(
            [("Reston", "US", T(2020, 1, 1), "CAGE1", 9, "Parent", "PU", "VA", "20190")], IP)}
    rows = dim_contractor(s, {}, "2024-03-01").collect()
    assert len(rows) == 1                                           # duplicates gone (D-12)
    r = rows[0]
    assert (r.uei, r.small_business_flag, r.woman_owned_flag, r.hubzone_flag, r.cage_code, r.state_cd) == \
        ("U-NEW", True, True, False, "CAGE1", "VA")
    fc = dim_fpds_contractor(s, {"alt.dim_contractor": dim_contractor(s, {}, "2024-03-01")}, "d").collect()
    assert len(fc) == 1 and fc[0].bus_type_cd == "WOMEN_OWNED_SMALL_BUSINESS"


def test_acquisition_and_solicitation(spark):
    s = {"aasbs_acquisition": spark.createDataFrame([("OPEN", "NEW", "AAC1", 100, None, "PT")],
                                                    "acquisition_status_cd string, acquisition_type_cd string, "
                                                    "activity_address_cd string, id bigint, is_deleted boolean, "
                                                    "performance_type_cd string"),
         "aasbs_acquisition_plan": spark.createDataFrame([
             (100, None, None, None, None, None, None, "FULL", "FFP", T(2023, 1, 1), None, None, None, None, "STD"),
             (100, None, None, None, None, None, None, "SOLE", "T&M", T(2023, 6, 1), None, None, None, None, "FAST")], PLAN),
         "aasbs_lu_acquisition_status": spark.createDataFrame([("OPEN", "Open", None)], CODE),
         "aasbs_lu_acquisition_type": spark.createDataFrame([], CODE),
         "aasbs_lu_competition_type": spark.createDataFrame([("SOLE", "Sole source", None)], CODE),
         "aasbs_award": spark.createDataFrame([(1000, 100, None)], "id bigint, acquisition_id bigint, is_deleted boolean"),
         "aasbs_award_ia": spark.createDataFrame([(1000, 11, None), (1000, 10, None)],
                                                 "award_id bigint, ia_id bigint, is_deleted boolean"),
         "aasbs_solicit": spark.createDataFrame([(100, 3, 50, None, "AAC1", "ACT", "desc"), (999, 1, 51, None, None, "X", None)],
                                                "acquisition_id bigint, at_award_bid_cnt int, id bigint, is_deleted boolean, "
                                                "sol_response_aac_visibility_cd string, sol_status_cd string, "
                                                "solicit_description string"),
         "aasbs_solicit_amendment": spark.createDataFrame([(None, T(2023, 1, 1), 1, None, "OPEN", 50),
                                                           (T(2023, 3, 1), T(2023, 2, 1), 2, None, "UNKNOWN", 50)],
                                                          "close_dt timestamp_ntz, created_dt timestamp_ntz, id bigint, "
                                                          "is_deleted boolean, sol_posting_type_cd string, solicit_id bigint"),
         "aasbs_solicit_response": spark.createDataFrame([(1, None, "N", 50), (2, None, "Y", 50)],
                                                         "id bigint, is_deleted boolean, winning_response_yn string, "
                                                         "solicit_id bigint"),
         "aasbs_lu_sol_posting_type": spark.createDataFrame([("OPEN", "Open posting", None)], CODE)}
    gold = {"common.dim_ia": spark.createDataFrame([(10, 1, True), (11, 2, True)], "ia_id bigint, ia_sk bigint, is_current_flag boolean"),
            "common.dim_agency": spark.createDataFrame([("AAC1", 7, True)], "activity_address_cd string, agency_sk bigint, "
                                                                           "is_current_flag boolean")}
    a = dim_acquisition(s, gold, "2024-01-01").collect()
    assert len(a) == 1                                               # latest plan only
    r = a[0]
    assert (r.competition_type_desc, r.processing_speed_cd, r.ia_sk, r.agency_sk, r.acquisition_status_desc) == \
        ("Sole source", "FAST", 1, 7, "Open")                        # IA via bridge (D-18)
    gold["alt.dim_acquisition"] = dim_acquisition(s, gold, "2024-01-01")
    sol = {x.solicit_id: x for x in dim_solicitation(s, gold, "2024-01-01").collect()}
    assert set(sol) == {50, 51}                                      # no row dropped (D-17)
    x = sol[50]
    assert (x.total_amendments, x.total_responses, x.winning_response_id, x.sol_posting_type_cd,
            x.sol_posting_type_desc, x.acquisition_sk, x.agency_sk) == (2, 2, 2, "UNKNOWN", "UNKNOWN", 1, 7)
    assert (sol[51].total_amendments, sol[51].acquisition_sk) == (0, -1)


def test_closeout_psc_agency_award(spark):
    s = {"aasbs_acquisition_closeout": spark.createDataFrame([(100, None, "n", None, 1, None, "P1", D("5.00"))],
                                                             "acquisition_id bigint, co_checked_certified_dt timestamp_ntz, "
                                                             "contract_funds_reconciled_yn string, fma_certified_dt timestamp_ntz, "
                                                             "id bigint, is_deleted boolean, prohibition_cd string, "
                                                             "ytd_total_vendor_invoiced_amt decimal(15,2)"),
         "aasbs_acquisition_closeout_checklist": spark.createDataFrame([(1, "yes", None), (1, "no", None), (1, None, None),
                                                                        (1, "Done", None)],
                                                                       "acquisition_closeout_id bigint, checklist_value_cd string, "
                                                                       "is_deleted boolean"),
         "aasbs_lus_psc": spark.createDataFrame([(None, "L1", "L2", "P", "R499", " ", "Support", "SERVICE")],
                                                "is_deleted boolean, level_1_category_name string, level_2_category_name string, "
                                                "parent_psc_code string, psc_code string, psc_full_name string, "
                                                "psc_name string, psc_type string"),
         "aasbs_lu_activity_address_code": spark.createDataFrame([("47QA01", "Office", "GSA", None)],
                                                                 "cd string, description string, "
                                                                 "fpds_ng_agency_identifier string, is_deleted boolean"),
         "aasbs_lu_agency": spark.createDataFrame([("GSA", "47", "General Services", None)],
                                                  "cd string, cd_2char string, description string, is_deleted boolean"),
         "aasbs_lu_bureau": spark.createDataFrame([("47", "B1", "Bureau", None, None)],
                                                  "agency_cd string, cd string, description string, is_deleted boolean, "
                                                  "updated_dt timestamp_ntz"),
         "table_master_lu_federal_agency": spark.createDataFrame([], "agency_code string, agency_description string, "
                                                                     "bureau_description string, is_deleted boolean"),
         "aasbs_transmit_transmittal": spark.createDataFrame([(1, None, T(2024, 1, 5)), (2, None, T(2024, 2, 5))],
                                                             "id bigint, is_deleted boolean, sent_dt timestamp_ntz"),
         "aasbs_transmit_po_summary": spark.createDataFrame([("AW-1", 1, None), ("AW-1", 2, None)],
                                                            "contract_number string, transmittal_id bigint, is_deleted boolean"),
         "aasbs_award": spark.createDataFrame([(1000, "AW-1", 100, 5, None, "B", "C", "PB")],
                                              "id bigint, award_piid string, acquisition_id bigint, latest_award_mod_id bigint, "
                                              "is_deleted boolean, bundled_contract_cd string, consolidated_contract_cd string, "
                                              "perf_based_svc_contract_cd string"),
         "aasbs_award_mod": spark.createDataFrame([(5, "DRAFT", None)], "id bigint, fpds_car_status_cd string, is_deleted boolean"),
         "aasbs_acquisition_plan": spark.createDataFrame([], PLAN)}
    c = dim_closeout(s, {}, "d").first()
    assert (c.checklist_total_items, c.checklist_complete_items, c.checklist_completion_pct, c.has_open_udo_flag,
            c.has_open_invoice_flag) == (4, 2, D("50.00"), True, True)
    p = dim_fpds_psc(s, {}, "d").first()
    assert (p.psc_description, p.service_category, p.supply_category) == ("Support", "L2", None)
    ag = dim_fpds_agency(s, {}, "d").first()
    assert (ag.agency_code, ag.agency_name, ag.bureau_code) == ("47", "General Services", "B1")   # not 'TEST' (D-20)
    aw = dim_fpds_award(s, {}, "d").first()
    assert (aw.fpds_car_status_cd, aw.last_submitted_dt, aw.performance_type_cd) == ("DRAFT", T(2024, 2, 5), "PB")
