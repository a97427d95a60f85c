"""Domain reporting views over small Gold fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildhall.plans.views import VIEWS

DIM_ATTRS = {
    "common.dim_agency": "agency_sk agency_name bureau_name activity_address_cd",
    "common.dim_ia": "ia_sk ia_num ia_type_desc instrument_type_desc ia_status_desc ia_end_dt",
    "common.dim_line_item": "line_item_sk line_item_id clin_num slin_num line_item_type_desc psc_cd li_pop_start_dt li_pop_end_dt",
    "common.dim_loa": "loa_sk fund_cd treasury_account_symbol object_class_cd tracking_num",
    "common.dim_award": "award_sk award_piid contract_type_desc award_end_dt award_status_cd",
    "common.dim_date": "date_sk calendar_date federal_fiscal_fy federal_fiscal_qtr",
    "alt.dim_acquisition": "acquisition_sk acquisition_status_desc competition_type_desc processing_speed_cd acquisition_type_desc",
    "alt.dim_closeout": "closeout_sk co_cert_dt fma_cert_dt client_cert_dt checklist_completion_pct has_open_udo_flag "
                        "has_open_invoice_flag closeout_prohibition_cds closeout_complete_dt",
    "alt.dim_solicitation": "solicitation_sk solicit_num sol_status_desc",
    "fre.dim_fpds_award": "fpds_award_sk piid fpds_car_status_cd",
    "fre.dim_fpds_contractor": "fpds_contractor_sk uei company_name sba_program_cd",
    "fre.dim_fpds_agency": "fpds_agency_sk agency_name aac bureau_name",
    "fre.dim_fpds_psc": "psc_sk psc_cd psc_description psc_category",
    "air.dim_accrual_period": "accrual_period_sk period_label accrual_fy accrual_fy_quarter accrual_fy_month",
    "air.dim_onefund_program": "onefund_sk baar_doc_type_cd baar_doc_type_desc",
    "tpp.dim_transmittal_type": "transmittal_type_sk transmittal_type_cd transmittal_type_desc",
    "tpp.dim_aac_envelope": "aac_envelope_sk aac",
    "psc.dim_clin_subtype": "clin_subtype_sk line_item_id clin_subtype_cd",
    "psc.dim_billing_period": "billing_period_sk billing_period_label period_start_dt period_end_dt",
    "psc.dim_cost_rate_type": "cost_rate_type_sk cost_rate_type_desc",
    "wpr.dim_user": "user_sk full_name email org_name region_cd",
    "wpr.dim_responsible_role": "responsible_role_sk responsible_role_desc responsible_role_cd requires_delegation_flag",
    "wpr.dim_org_hierarchy": "org_sk region_cd org_name org_level",
    "iat.dim_amend_action": "amend_action_sk changes_scope_flag changes_cost_flag changes_period_flag",
    "cat.dim_review_type": "review_type_sk review_type_desc is_mandatory_flag",
    "cat.dim_finding": "finding_sk is_blocking_flag",
    "cat.dim_event_type": "event_type_sk lifecycle_phase_cd event_type_desc",
}
KEYS = "line_item_sk loa_sk funding_sk award_sk ia_sk agency_sk"
FACTS = {
    "oet.fact_obligation_expenditure": KEYS + " snapshot_date_sk fiscal_year fiscal_quarter fiscal_month obligated_amt "
                                       "accepted_amt billed_amt udo_amt accrued_amt service_charge_amt _gold_created_at",
    "alt.fact_award_lifecycle": KEYS + " acquisition_sk closeout_sk award_date_sk current_obligated_amt current_udo_amt "
                                "pending_invoices_count days_to_pop_end days_in_pre_award",
    "fre.fact_fpds_transaction": "fpds_award_sk fpds_contractor_sk fpds_agency_sk psc_sk action_date_sk award_mod_id mod_num "
                                 "car_status_cd action_obligation_amt action_type_cd car_submitted_dt car_accepted_dt "
                                 "base_all_opts_amt is_small_business_flag competition_type_cd reason_not_competed_cd",
    "air.fact_accrual_income": KEYS + " accrual_period_sk onefund_sk net_accrued_amt baar_accepted_amt baar_rejected_amt "
                               "baar_transmitted_amt baar_transmission_status_cd holdback_amt inclusion_override_flag "
                               "inclusion_override_reason _gold_updated_at",
    "tpp.fact_payment_reconciliation": KEYS + " invoice_date_sk invoice_amt is_prompt_payment_compliant "
                                       "invoice_to_payment_days billing_amt payment_amt invoice_to_billing_variance_amt "
                                       "po_to_rr_variance_amt",
    "tpp.fact_transmission_event": "agency_sk transmittal_type_sk aac_envelope_sk event_date_sk transmittal_status_cd "
                                   "transmitted_dt error_code error_description retry_count transmitted_amt",
    "psc.fact_service_charge_schedule": KEYS + " billing_period_sk scheduled_amt invoiced_amt accepted_amt on_schedule_flag "
                                        "travel_voucher_amt",
    "psc.fact_clin_pricing": KEYS + " clin_subtype_sk cost_rate_type_sk planned_amt planned_hours planned_rate actual_amt "
                             "actual_hours award_fee_amt award_fee_surcharge_rate",
    "smi.fact_solicitation_response": KEYS + " acquisition_sk solicitation_sk sol_response_sk response_date_sk "
                                      "is_small_business_flag award_total_amt bid_total_amt is_winner_flag",
    "wpr.fact_role_assignment": KEYS + " user_sk responsible_role_sk org_sk assignment_status_cd has_delegation_flag "
                                "delegation_letter_ref awards_assigned_count total_obligated_amt active_clin_count",
    "iat.fact_ia_amendment": KEYS + " amend_action_sk amend_date_sk ia_amendment_sk cost_change_amt pop_extension_days "
                             "source_ia_amendment_id amendment_num servicing_aac_cd validation_override_flag "
                             "validation_override_reason",
    "iat.fact_ia_review": KEYS + " review_date_sk ia_review_sk days_overdue review_completed_flag",
    "cat.fact_review_determination": KEYS + " review_type_sk finding_sk review_date_sk review_determination_sk "
                                     "days_to_determination is_blocking_finding_flag",
    "cat.fact_lifecycle_event": KEYS + " event_type_sk event_date_sk event_timestamp event_user_id event_description "
                                "collab_type_cd collab_status_cd email_status_cd",
}
INT_COLS = {"fiscal_year", "fiscal_quarter", "fiscal_month", "accrual_fy", "accrual_fy_quarter", "accrual_fy_month",
            "federal_fiscal_fy", "federal_fiscal_qtr", "org_level", "retry_count", "date_sk"}


def _type(col: str) -> T.DataType:
    if col.endswith("_date_sk") or col in INT_COLS:
        return T.IntegerType()
    if col.endswith(("_sk", "_id")):
        return T.LongType()
    if col.endswith(("_count", "_days")) or col.startswith("days_"):
        return T.IntegerType()
    if col.endswith(("_amt", "_pct", "_rate", "_hours")):
        return T.DecimalType(15, 2)
    if col.endswith(("_flag", "_compliant")):
        return T.BooleanType()
    if col.endswith(("_dt", "_timestamp", "_at")):
        return T.TimestampNTZType()
    if col == "calendar_date":
        return T.DateType()
    return T.StringType()


def _value(col: str, t: T.DataType):
    if col == "date_sk" or col.endswith("_date_sk"):
        return 20240115
    if isinstance(t, T.LongType):
        return 1
    if isinstance(t, T.IntegerType):
        return 2024 if "fy" in col or "year" in col else 3
    if isinstance(t, T.DecimalType):
        return Decimal("10.00")
    if isinstance(t, T.BooleanType):
        return True
    if isinstance(t, T.TimestampNTZType):
        return dt.datetime(2024, 1, 15, 6, 0)
    if isinstance(t, T.DateType):
        return dt.date(2024, 1, 15)
    return {"car_status_cd": "DRAFT", "transmittal_status_cd": "ERROR", "assignment_status_cd": "Active",
            "responsible_role_cd": "COR", "clin_subtype_cd": "SC_LABOR", "award_status_cd": "ACTIVE"}.get(col, f"{col}-1")


def _frame(spark, cols: str, current: bool, overrides=None, rows=1):
    names = cols.split()
    if current:
        names.append("is_current_flag")
    schema = T.StructType([T.StructField(n, T.BooleanType() if n == "is_current_flag" else _type(n)) for n in names])
    base = [_value(n, f.dataType) if n != "is_current_flag" else True for n, f in zip(names, schema.fields)]
    data = []
    for i in range(rows):
        row = list(base)
        for k, v in (overrides or {}).items():
            row[names.index(k)] = v[i] if isinstance(v, list) else v
        data.append(tuple(row))
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def gold(spark):
    g = {name: _frame(spark, cols, current=name.startswith(("common.", "alt.dim_acq", "fre.dim_fpds_contractor", "wpr.dim_user")))
         for name, cols in DIM_ATTRS.items()}
    g.update({name: _frame(spark, cols, current=False) for name, cols in FACTS.items()})
    return g


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view_runs(spark, gold, name):
    g = dict(gold)
    if name == "psc.v_award_fee_performance":
        g["psc.dim_clin_subtype"] = _frame(spark, DIM_ATTRS["psc.dim_clin_subtype"], False,
                                           overrides={"clin_subtype_cd": "AWARD_FEE"})
    out = VIEWS[name](g)
    assert out.count() >= 1, name


def test_view_count():
    assert len(VIEWS) == 26


def test_cfo_summary_keeps_latest_snapshot_only(spark, gold):
    """Two appended snapshots of one grain are not double counted (D-6)."""
    g = dict(gold)
    g["oet.fact_obligation_expenditure"] = _frame(spark, FACTS["oet.fact_obligation_expenditure"], False, rows=2, overrides={
        "snapshot_date_sk": [20240131, 20240229], "obligated_amt": [Decimal("5.00"), Decimal("7.00")]})
    r = VIEWS["oet.v_cfo_obligation_summary"](g).first()
    assert r.total_obligated == Decimal("7.00")


def test_revenue_vs_expense_no_fanout(spark, gold):
    """Two income rows on one expense grain count the expense once (D-9)."""
    g = dict(gold)
    g["air.fact_accrual_income"] = _frame(spark, FACTS["air.fact_accrual_income"], False, rows=2)
    g["air.dim_accrual_period"] = _frame(spark, DIM_ATTRS["air.dim_accrual_period"], False,
                                         overrides={"accrual_fy": 2024, "accrual_fy_month": 3})
    g["oet.fact_obligation_expenditure"] = _frame(spark, FACTS["oet.fact_obligation_expenditure"], False,
                                                  overrides={"fiscal_year": 2024, "fiscal_month": 3,
                                                             "accrued_amt": Decimal("4.00")})
    r = VIEWS["air.v_revenue_vs_expense"](g).first()
    assert (r.total_income_accrued, r.total_expense_accrued) == (Decimal("20.00"), Decimal("4.00"))


def test_competition_avg_responses(spark, gold):
    """Average responses per solicitation (D-8): 3 responses over 2 solicitations."""
    g = dict(gold)
    g["smi.fact_solicitation_response"] = _frame(spark, FACTS["smi.fact_solicitation_response"], False, rows=3,
                                                 overrides={"solicitation_sk": [1, 1, 2], "sol_response_sk": [1, 2, 3]})
    r = VIEWS["smi.v_competition_analytics"](g).first()
    assert (r.solicitation_count, float(r.avg_responses_per_sol)) == (2, 1.5)


def test_transmit_error_hours_from_seconds(spark, gold):
    """Hours since the error, not days (D-22): 06:00 → next day 00:00 is 18 h."""
    r = VIEWS["tpp.v_transmit_error_log"](gold, as_of="2024-01-16 00:00:00").first()
    assert r.hours_since_error == 18


def test_bid_distribution_median(spark, gold):
    g = dict(gold)
    g["smi.fact_solicitation_response"] = _frame(spark, FACTS["smi.fact_solicitation_response"], False, rows=4, overrides={
        "sol_response_sk": [1, 2, 3, 4], "bid_total_amt": [Decimal("1.00"), Decimal("2.00"), Decimal("3.00"), Decimal("10.00")],
        "is_winner_flag": [False, True, False, False]})
    r = VIEWS["smi.v_bid_price_distribution"](g).first()
    assert (r.total_responses, float(r.median_bid), r.winning_bid, r.winning_vs_low_spread) == \
        (4, 2.5, Decimal("2.00"), Decimal("1.00"))
    assert F is not None
