"""Code tables (SRC-7): 85 ``lu_*`` tables of one shape, loaded as ONE long
table partitioned by ``code_set`` in one job (the reference runs about five
small jobs per table, sequentially).

Each entry says which optional columns its Silver table has; a missing
column becomes a typed NULL. Blocked entries (no Silver source yet) are
skipped and reported by ``blocked_code_sets``. Readers select one code set
with a filter on ``code_set`` (partition pruning when written partitioned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.sources import load_ref

# Fixed values: (gold table, silver table, has sort_order, has short_description, blocked, source schema),
# in the reference's three groups: acquisition & contract, financial & operational, collaboration & transmittal.
REF_TABLES = [
    ("lu_acquisition_status", "aasbs_lu_acquisition_status", False, False, False, "aasbs"),
    ("lu_acquisition_type", "aasbs_lu_acquisition_type", False, False, False, "aasbs"),
    ("lu_acquisition_mod_status", "aasbs_lu_acquisition_mod_status", False, False, False, "aasbs"),
    ("lu_competition_type", "aasbs_lu_competition_type", False, False, False, "aasbs"),
    ("lu_commercial_type", "aasbs_lu_commercial_type", False, False, False, "aasbs"),
    ("lu_performance_type", "aasbs_lu_performance_type", False, False, False, "aasbs"),
    ("lu_processing_speed", "aasbs_lu_processing_speed", False, False, False, "aasbs"),
    ("lu_expedited_type", "aasbs_lu_expedited_type", False, False, False, "aasbs"),
    ("lu_emergency_acq", "aasbs_lu_emergency_acq", True, False, False, "aasbs"),
    ("lu_supply_chain_risk", "aasbs_lu_supply_chain_risk", True, False, False, "aasbs"),
    ("lu_surveillance_spec", "aasbs_lu_surveillance_spec", True, False, False, "aasbs"),
    ("lu_intel_community", "aasbs_lu_intel_community", True, False, False, "aasbs"),
    ("lu_consolidated_contract", "aasbs_lu_consolidated_contract", True, False, False, "aasbs"),
    ("lu_bundled_contract", "aasbs_lu_bundled_contract", True, False, False, "aasbs"),
    ("lu_reason_for_direct", "aasbs_lu_reason_for_direct", True, False, False, "aasbs"),
    ("lu_small_business_admin", "aasbs_lu_small_business_admin", True, False, False, "aasbs"),
    ("lu_multi_year_contract", None, False, False, True, "aasbs"),
    ("lu_award_mod_fpds_reason", "aasbs_lu_award_mod_fpds_reason", True, False, False, "aasbs"),
    ("lu_sf30_mod_type", "aasbs_lu_sf30_mod_type", True, False, False, "aasbs"),
    ("lu_fpds_car_status", "aasbs_lu_fpds_car_status", True, False, False, "aasbs"),
    ("lu_contract_type", "aasbs_lu_contract_type", False, False, False, "aasbs"),
    ("lu_vehicle_type", "aasbs_lu_vehicle_type", False, False, False, "aasbs"),
    ("lu_instrument_type", "aasbs_lu_instrument_type", True, True, False, "aasbs"),
    ("lu_idv_type_of_idc", "aasbs_lu_idv_type_of_idc", False, False, False, "aasbs"),
    ("lu_idv_referenced_class", "aasbs_lu_idv_referenced_class", False, False, False, "aasbs"),
    ("lu_idv_who_can_use", "aasbs_lu_idv_who_can_use", False, False, False, "aasbs"),
    ("lu_continuity_type", "aasbs_lu_continuity_type", False, False, False, "aasbs"),
    ("lu_award_validation", "aasbs_lu_award_validation", True, False, False, "aasbs"),
    ("lu_sol_status", "aasbs_lu_sol_status", True, False, False, "aasbs"),
    ("lu_sol_amend_status", "aasbs_lu_sol_amend_status", True, False, False, "aasbs"),
    ("lu_sol_posting_type", "aasbs_lu_sol_posting_type", True, False, False, "aasbs"),
    ("lu_sol_response_aac_visibility", "aasbs_lu_sol_response_aac_visibility", True, False, False, "aasbs"),
    ("lu_sol_response_cli_visibility", "aasbs_lu_sol_response_cli_visibility", True, False, False, "aasbs"),
    ("lu_fund", "aasbs_lu_fund", False, False, False, "aasbs"),
    ("lu_fund_status", "aasbs_lu_fund_status", False, False, False, "aasbs"),
    ("lu_fund_type", "aasbs_lu_fund_type", False, False, False, "aasbs"),
    ("lu_fund_category", "aasbs_lu_fund_category", False, False, False, "aasbs"),
    ("lu_billing_type", "aasbs_lu_billing_type", False, False, False, "aasbs"),
    ("lu_fund_amend_status", "aasbs_lu_fund_amend_status", False, False, False, "aasbs"),
    ("lu_funds_usage", "aasbs_lu_funds_usage", False, False, False, "aasbs"),
    ("lu_transaction_type", "aasbs_lu_transaction_type", False, False, False, "aasbs"),
    ("lu_loa_status", "aasbs_lu_loa_status", False, False, False, "aasbs"),
    ("lu_loa_change_reason", "aasbs_lu_loa_change_reason", True, False, False, "aasbs"),
    ("lu_ia_status", "aasbs_lu_ia_status", True, False, False, "aasbs"),
    ("lu_ia_amend_action", "aasbs_lu_ia_amend_action", False, False, False, "aasbs"),
    ("lu_line_item_type", "aasbs_lu_line_item_type", False, False, False, "aasbs"),
    ("lu_severability_type", "aasbs_lu_severability_type", False, False, False, "aasbs"),
    ("lu_unit_of_measure", "aasbs_lu_unit_of_measure", True, False, False, "aasbs"),
    ("lu_fob_type", "aasbs_lu_fob_type", True, False, False, "aasbs"),
    ("lu_cost_rate_type", "aasbs_lu_cost_rate_type", True, False, False, "aasbs"),
    ("lu_proc_phase", "aasbs_lu_proc_phase", True, True, False, "aasbs"),
    ("lu_accrual_income_doc_type", "aasbs_lu_accrual_income_doc_type", False, False, False, "aasbs"),
    ("lu_onefund_program", "aasbs_lu_onefund_program", False, False, False, "aasbs"),
    ("lu_onefund_activity", "aasbs_lu_onefund_activity", False, False, False, "aasbs"),
    ("lu_agency", "aasbs_lu_agency", True, False, False, "aasbs"),
    ("lu_activity_address_code", "aasbs_lu_activity_address_code", True, False, False, "aasbs"),
    ("lu_agreement_type", "aasbs_lu_agreement_type", False, False, False, "aasbs"),
    ("lu_region", "aasbs_lu_region", False, False, False, "aasbs"),
    ("lu_state", "aasbs_lu_state", False, False, False, "aasbs"),
    ("lu_country", "aasbs_lu_country", False, False, False, "aasbs"),
    ("lu_address_type", "aasbs_lu_address_type", False, False, False, "aasbs"),
    ("lu_office_type", "aasbs_lu_office_type", False, False, False, "aasbs"),
    ("lu_group_contact_type", "aasbs_lu_group_contact_type", False, False, False, "aasbs"),
    ("lu_transfer", "aasbs_lu_transfer", True, False, False, "aasbs"),
    ("lu_program", "aasbs_lu_program", False, False, False, "aasbs"),
    ("lu_collab_type", "aasbs_lu_collab_type", False, False, False, "aasbs"),
    ("lu_collab_status", "aasbs_lu_collab_status", False, False, False, "aasbs"),
    ("lu_central_comment_type", "aasbs_lu_central_comment_type", False, False, False, "aasbs"),
    ("lu_event_type", "aasbs_lu_event_type", False, False, False, "aasbs"),
    ("lu_review_type", "aasbs_lu_review_type", True, False, False, "aasbs"),
    ("lu_review_finding", "aasbs_lu_review_finding", True, False, False, "aasbs"),
    ("lu_reviewer_type", "aasbs_lu_reviewer_type", True, False, False, "aasbs"),
    ("lu_responsible_role", "aasbs_lu_responsible_role", False, False, False, "aasbs"),
    ("lu_cor_delegation", "aasbs_lu_cor_delegation", True, False, False, "aasbs"),
    ("lu_closeout_prohibition", "aasbs_lu_closeout_prohibition", False, False, False, "aasbs"),
    ("lu_checklist_type", "aasbs_lu_checklist_type", False, False, False, "aasbs"),
    ("lu_checklist_item", "aasbs_lu_checklist_item", True, False, False, "aasbs"),
    ("lu_checklist_value", "aasbs_lu_checklist_value", True, False, False, "aasbs"),
    ("lu_subsystem", "aasbs_lu_subsystem", False, False, False, "aasbs"),
    ("lu_table_name", "aasbs_lu_table_name", False, False, False, "aasbs"),
    ("lu_email_status", "aasbs_lu_email_status", False, False, False, "aasbs"),
    ("lu_transmittal_record_type", "aasbs_transmit_lu_transmittal_record_type", True, False, False, "aasbs_transmit"),
    ("lu_transmittal_stage", "aasbs_transmit_lu_transmittal_stage", False, False, False, "aasbs_transmit"),
    ("lu_transmittal_status", "aasbs_transmit_lu_transmittal_status", True, False, False, "aasbs_transmit"),
    ("lu_transmittal_type", "aasbs_transmit_lu_transmittal_type", True, False, False, "aasbs_transmit"),
]


def ref_config(silver) -> list[dict]:
    """One ``load_ref`` entry per available code table."""
    out = []
    for gold_tbl, silver_tbl, has_sort, has_short, is_blocked, schema in REF_TABLES:
        if is_blocked or silver_tbl not in silver:
            continue
        cols = silver[silver_tbl].columns
        out.append(dict(source=silver_tbl, code_set=gold_tbl, code_col="cd", desc_col="description",
                        sort_col="sort_order" if has_sort and "sort_order" in cols else None,
                        short_col="short_description" if has_short and "short_description" in cols else None,
                        active="active_yn" if "active_yn" in cols else None,
                        source_label=f"{schema}.{gold_tbl}"))
    return out


def ref_code_tables(silver, gold, as_of: str) -> DataFrame:
    """All available code tables as one long table (one job)."""
    out = load_ref(silver, ref_config(silver))
    return out.withColumns({"effective_dt": F.lit(None).cast("date"), "expiry_dt": F.lit(None).cast("date")})


def blocked_code_sets(silver) -> list[str]:
    """Code sets not loaded: blocked, or their Silver table is absent."""
    return [g for g, s, _, _, b, _ in REF_TABLES if b or s not in silver]
