"""Reporting views by their own functions, over Gold built from the whole test
tables; the oracle builds the same Gold in SQL (``q_domain``)."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from gildhall.operators import assign_sk
from gildhall.plans import views as V
from gildhall.plans.q_domain import (
    _AM_SQL, _CR_SQL, _DIMS_WITH, _EV_SQL, ACQ_SQL, AMEND_SQL, BILLING_SQL, CLIN_SQL, CONTRACTOR_SQL, FACT_SQL, FY,
    LIFECYCLE_SQL, POSTING_SQL, REVIEW_SQL, SCS_FACT_SQL, SILVER_DIM_SQL, SMI_FACT_SQL, SOL_SQL, WPR_SMI_SQL,
    _award_lifecycle_sql, _gold, _materialized,
)
from gildhall.plans.q_payments import _AIR_WITH, _PAY_WITH, PERIODS, payments_gold
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF
from gildhall.sources import date_spine

#: Days of the test tables; the date dimension itself starts in 2000.
DAYS = ("1992-01-01", "2002-12-31")
ALT_WITH = f"{_DIMS_WITH}, {ACQ_SQL}, {SOL_SQL}, {CONTRACTOR_SQL}, {_award_lifecycle_sql()}"


def _with_days(t):
    """Gold over derived Silver, its date dimension over the days of the test tables."""
    return _days_over(t, _gold(t))


def _days_over(t, gold):
    return ChainMap({"common.dim_date": date_spine(t["orders"].sparkSession, *DAYS)}, gold)


def _keyed(gold, fact: str, key: str, sk: str):
    """``gold`` with ``fact`` numbered by its source key, as its load numbers it."""
    return gold.new_child({fact: assign_sk(gold[fact], [key], name=sk)})


def _sums(df, names):
    return df.select(*[F.col(c).cast("decimal(38,2)").alias(c) if c in names else F.col(c) for c in df.columns])


def _day(c: str) -> str:
    """The day of a date key, as the join on the date dimension finds it."""
    return f"CAST(strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE)"


def _in_days(c: str) -> str:
    return f"{_day(c)} BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}'"


@query("q_oet_v_udo_aging", _materialized(f"""{_DIMS_WITH}
SELECT ag.agency_name, ia.ia_num, li.clin_num, li.li_pop_end_dt, aw.award_piid, f.fiscal_year,
       CAST(date_diff('day', CAST(li.li_pop_end_dt AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_past_pop,
       CASE WHEN li.li_pop_end_dt IS NULL THEN 'No PoP'
            WHEN DATE '{AS_OF}' <= CAST(li.li_pop_end_dt AS DATE) THEN 'Within PoP'
            WHEN date_diff('day', CAST(li.li_pop_end_dt AS DATE), DATE '{AS_OF}') <= 180 THEN '0-180 Days Past PoP'
            WHEN date_diff('day', CAST(li.li_pop_end_dt AS DATE), DATE '{AS_OF}') <= 365 THEN '181-365 Days Past PoP'
            ELSE 'Over 1 Year Past PoP' END AS udo_aging_bucket,
       CAST(SUM(f.udo_amt) AS DECIMAL(38,2)) AS udo_amt, CAST(SUM(f.obligated_amt) AS DECIMAL(38,2)) AS obligated_amt,
       CAST(SUM(f.accepted_amt) AS DECIMAL(38,2)) AS accepted_amt
FROM fact f
JOIN d_line_item li ON li.line_item_sk = f.line_item_sk
JOIN d_award aw ON aw.award_sk = f.award_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
WHERE f.udo_amt <> 0 GROUP BY ALL"""))
def q_oet_v_udo_aging(t):
    """Undelivered orders by age past the period of performance: latest snapshot, star join, buckets."""
    return _sums(V.v_udo_aging(_gold(t), AS_OF), ("udo_amt", "obligated_amt", "accepted_amt"))


@query("q_oet_v_clin_expenditure_detail", _materialized(f"""{_DIMS_WITH}
SELECT f.*, li.clin_num, li.slin_num, li.line_item_type_desc, li.psc_cd, li.li_pop_start_dt, li.li_pop_end_dt,
       loa.tracking_num, loa.treasury_account_symbol, loa.fund_cd, loa.object_class_cd, aw.award_piid,
       aw.contract_type_desc, ia.ia_num, ia.instrument_type_desc, ag.agency_name, ag.bureau_name, ag.activity_address_cd,
       CASE WHEN {_in_days('f.snapshot_date_sk')} THEN {_day('f.snapshot_date_sk')} END AS snapshot_date,
       CASE WHEN {_in_days('f.snapshot_date_sk')} THEN {FY(_day('f.snapshot_date_sk'))} END AS federal_fiscal_fy,
       CASE WHEN {_in_days('f.snapshot_date_sk')}
            THEN CAST(((month({_day('f.snapshot_date_sk')}) + 2) % 12) // 3 + 1 AS INTEGER) END AS federal_fiscal_qtr
FROM fact f
JOIN d_line_item li ON li.line_item_sk = f.line_item_sk
JOIN d_loa loa ON loa.loa_sk = f.loa_sk
JOIN d_award aw ON aw.award_sk = f.award_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk"""))
def q_oet_v_clin_expenditure_detail(t):
    """Line-level expenditure with line, LOA, award, IA, agency and snapshot date attributes."""
    return V.v_clin_expenditure_detail(_with_days(t))


@query("q_alt_v_co_active_awards", _materialized(f"""{ALT_WITH}
SELECT aw.award_piid, aw.contract_type_desc, aw.award_end_dt, ag.agency_name, ia.ia_num, ia.ia_type_desc,
       acq.acquisition_status_desc, acq.competition_type_desc, acq.processing_speed_cd,
       COUNT(DISTINCT f.line_item_sk) AS clin_count,
       CAST(SUM(f.current_obligated_amt) AS DECIMAL(38,2)) AS total_obligated,
       CAST(SUM(f.current_udo_amt) AS DECIMAL(38,2)) AS total_udo,
       CAST(SUM(f.pending_invoices_count) AS BIGINT) AS pending_invoices, MIN(f.days_to_pop_end) AS min_days_to_pop_end
FROM award_lifecycle f
JOIN d_award aw ON aw.award_sk = f.award_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
JOIN d_acquisition acq ON acq.acquisition_sk = f.acquisition_sk
WHERE aw.award_status_cd NOT IN ('CLOSED', 'CANCELLED') GROUP BY ALL"""))
def q_alt_v_co_active_awards(t):
    """Open awards by award, agency, IA and acquisition, with lines, money and invoices."""
    return _sums(V.v_co_active_awards(_gold(t)), ("total_obligated", "total_udo"))


@query("q_alt_v_acquisition_cycle_time", _materialized(f"""{ALT_WITH}
SELECT acq.acquisition_type_desc, acq.competition_type_desc, acq.processing_speed_cd, ag.agency_name,
       {FY(_day('f.award_date_sk'))} AS award_fy, COUNT(DISTINCT f.acquisition_sk) AS acquisition_count,
       AVG(f.days_in_pre_award) AS avg_days_pre_award, MIN(f.days_in_pre_award) AS min_days_pre_award,
       MAX(f.days_in_pre_award) AS max_days_pre_award, quantile_cont(f.days_in_pre_award, 0.5) AS median_days_pre_award,
       quantile_cont(f.days_in_pre_award, 0.9) AS p90_days_pre_award
FROM award_lifecycle f
JOIN d_acquisition acq ON acq.acquisition_sk = f.acquisition_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
WHERE f.days_in_pre_award IS NOT NULL AND {_in_days('f.award_date_sk')} GROUP BY ALL"""))
def q_alt_v_acquisition_cycle_time(t):
    """Days before award by acquisition type, competition, speed, agency and fiscal year, with exact percentiles."""
    return V.v_acquisition_cycle_time(_with_days(t))


@query("q_alt_v_closeout_status", _materialized(f"""{ALT_WITH}
SELECT ag.agency_name, ia.ia_num, aw.award_piid, cl.co_cert_dt, cl.fma_cert_dt, cl.client_cert_dt,
       cl.checklist_completion_pct, cl.has_open_udo_flag, cl.has_open_invoice_flag, cl.closeout_prohibition_cds,
       f.current_udo_amt, f.days_to_pop_end,
       CASE WHEN cl.closeout_complete_dt IS NOT NULL THEN 'Complete'
            WHEN cl.has_open_udo_flag OR cl.has_open_invoice_flag THEN 'Blocked'
            WHEN cl.checklist_completion_pct >= 100 THEN 'Pending Cert' ELSE 'In Progress' END AS closeout_status_bucket
FROM award_lifecycle f
JOIN d_closeout cl ON cl.closeout_sk = f.closeout_sk
JOIN d_award aw ON aw.award_sk = f.award_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk"""))
def q_alt_v_closeout_status(t):
    """Closeouts of awards with their certificates, checklist and what blocks them."""
    return V.v_closeout_status(_gold(t))


@query("q_iat_v_fin_code_history", _materialized(f"""WITH {SILVER_DIM_SQL}, {FACT_SQL}, {AMEND_SQL}
SELECT ia.ia_num, ag.agency_name, f.source_ia_amendment_id, f.amendment_num, {_day('f.amend_date_sk')} AS amendment_dt,
       f.servicing_aac_cd, f.validation_override_flag, f.validation_override_reason, ia.ia_status_desc
FROM amend f
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
WHERE {_in_days('f.amend_date_sk')}"""))
def q_iat_v_fin_code_history(t):
    """Amendments of every IA with agency, date and overrides."""
    return V.v_fin_code_history(_with_days(t))


@query("q_smi_v_competition_analytics", _materialized(f"""{_DIMS_WITH}, {ACQ_SQL}, {SOL_SQL}, {CONTRACTOR_SQL}, {POSTING_SQL},
{WPR_SMI_SQL}, {SMI_FACT_SQL}
SELECT ag.agency_name, ia.ia_num, acq.acquisition_type_desc, acq.competition_type_desc,
       {FY(_day('f.response_date_sk'))} AS solicitation_fy, COUNT(DISTINCT f.solicitation_sk) AS solicitation_count,
       round(CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT f.solicitation_sk), 2) AS avg_responses_per_sol,
       CAST(COUNT(*) FILTER (WHERE f.is_small_business_flag) AS BIGINT) AS sb_responses,
       round(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE f.is_small_business_flag) / COUNT(*), 2) AS sb_response_pct,
       CAST(SUM(f.award_total_amt) AS DECIMAL(38,2)) AS total_awarded
FROM smi_fact f
JOIN d_acquisition acq ON acq.acquisition_sk = f.acquisition_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
WHERE {_in_days('f.response_date_sk')} GROUP BY ALL"""))
def q_smi_v_competition_analytics(t):
    """Responses for each solicitation (D-8), small-business share and awards by agency, IA, acquisition and year."""
    gold = _keyed(_with_days(t), "smi.fact_solicitation_response", "source_response_id", "sol_response_sk")
    return _sums(V.v_competition_analytics(gold), ("total_awarded",))


@query("q_iat_v_ia_annual_review_status", _materialized(f"""WITH {SILVER_DIM_SQL}, {FACT_SQL}, {AMEND_SQL}, {REVIEW_SQL}
SELECT ia.ia_num, ia.ia_status_desc, ia.ia_end_dt, ag.agency_name, {FY(_day('r.review_date_sk'))} AS review_fy,
       COUNT(*) AS reviews_completed,
       CAST(COUNT(*) FILTER (WHERE r.days_overdue > 0) AS BIGINT) AS overdue_reviews, MAX(r.days_overdue) AS max_days_overdue,
       MIN(CASE WHEN NOT r.review_completed_flag THEN r.days_overdue END) AS current_days_overdue
FROM review_fact r
JOIN g_ia ia ON ia.ia_sk = r.ia_sk
JOIN g_agency ag ON ag.agency_sk = r.agency_sk
WHERE {_in_days('r.review_date_sk')} GROUP BY ALL"""))
def q_iat_v_ia_annual_review_status(t):
    """Reviews of every IA by fiscal year, with those overdue."""
    return V.v_ia_annual_review_status(_keyed(_with_days(t), "iat.fact_ia_review", "source_ia_review_id", "ia_review_sk"))


@query("q_cat_v_event_timeline", f"""{_DIMS_WITH}, {LIFECYCLE_SQL}, d_event AS ({_EV_SQL})
SELECT et.lifecycle_phase_cd, et.event_type_desc, ia.ia_num, aw.award_piid, ag.agency_name,
       {_day('f.event_date_sk')} AS event_date, f.event_timestamp, f.event_user_id, f.event_description, f.collab_type_cd,
       f.collab_status_cd, f.email_status_cd
FROM (SELECT * FROM chron_rows UNION ALL SELECT * FROM collab_rows) f
JOIN d_event et ON et.event_type_sk = f.event_type_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
LEFT JOIN g_ia ia ON ia.ia_sk = f.ia_sk
LEFT JOIN d_award aw ON aw.award_sk = f.award_sk
WHERE {_day('f.event_date_sk')} BETWEEN DATE '2000-01-01' AND DATE '2040-12-31'""")
def q_cat_v_event_timeline(t):
    """Events and collaborations with phase, agency and date; IA and award where there is one."""
    return V.v_event_timeline(_gold(t))


# accrual periods as the period dimension numbers them, and the star of the income views
PERIOD_SQL = f"""a_period AS (
  SELECT ROW_NUMBER() OVER (ORDER BY ps) AS sk, {FY('ps')} AS accrual_fy, CAST(((month(ps) + 2) % 12) + 1 AS INTEGER) AS accrual_fy_month,
         CAST(((month(ps) + 2) % 12) // 3 + 1 AS INTEGER) AS accrual_fy_quarter,
         printf('FY%d-M%02d (%s %d)', {FY('ps')}, ((month(ps) + 2) % 12) + 1, strftime(ps, '%b'), year(ps)) AS period_label
  FROM (SELECT unnest(generate_series(DATE '{PERIODS[0]}-10-01', DATE '{PERIODS[1]}-09-01', INTERVAL 1 MONTH)) AS ps)),
a_star AS (
  SELECT ai.*, ap.* EXCLUDE (sk), ia.ia_num, ag.agency_name
  FROM a_income ai
  JOIN a_period ap ON ap.sk = ai.accrual_period_sk
  JOIN g_ia ia ON ia.ia_sk = ai.ia_sk
  JOIN g_agency ag ON ag.agency_sk = ai.agency_sk)"""
_NO_SUM = "CAST(NULL AS DECIMAL(38,2))"


def _money(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(38,2))"


@query("q_air_v_revenue_vs_expense", _materialized(f"""{_AIR_WITH}, {PERIOD_SQL},
inc AS (SELECT period_label, accrual_fy, accrual_fy_quarter, accrual_fy_month, agency_name, ia_num, line_item_sk, loa_sk,
               SUM(net_accrued_amt) AS inc FROM a_star GROUP BY ALL),
expense AS (SELECT line_item_sk, loa_sk, fiscal_year, fiscal_month, SUM(accrued_amt) AS amt FROM fact GROUP BY ALL)
SELECT period_label, accrual_fy, accrual_fy_quarter, agency_name, ia_num, {_money('inc')} AS total_income_accrued,
       {_money('e.amt')} AS total_expense_accrued, CAST(SUM(inc) - COALESCE(SUM(e.amt), 0) AS DECIMAL(38,2)) AS net_revenue_margin,
       {_NO_SUM} AS baar_accepted, {_NO_SUM} AS baar_rejected
FROM inc LEFT JOIN expense e ON e.line_item_sk = inc.line_item_sk AND e.loa_sk = inc.loa_sk
 AND e.fiscal_year = inc.accrual_fy AND e.fiscal_month = inc.accrual_fy_month
GROUP BY ALL"""))
def q_air_v_revenue_vs_expense(t):
    """Income against expense, both aggregated to line, LOA and fiscal month before they meet (D-9)."""
    return _sums(V.v_revenue_vs_expense(payments_gold(t)), (
        "total_income_accrued", "total_expense_accrued", "net_revenue_margin", "baar_accepted", "baar_rejected"))


@query("q_air_v_baar_transmission_status", _materialized(f"""{_AIR_WITH}, {PERIOD_SQL}
SELECT s.period_label, s.accrual_fy, s.agency_name, s.ia_num, o.baar_doc_type_cd, o.baar_doc_type_desc, COUNT(*) AS record_count,
       {_money('s.net_accrued_amt')} AS total_accrued, {_money('s.baar_transmitted_amt')} AS total_transmitted,
       {_NO_SUM} AS total_accepted, {_NO_SUM} AS total_rejected,
       {_money("CASE WHEN s.baar_transmission_status_cd = 'PENDING' THEN s.net_accrued_amt ELSE 0 END")} AS pending_transmission
FROM a_star s JOIN a_onefund o ON o.onefund_sk = s.onefund_sk GROUP BY ALL"""))
def q_air_v_baar_transmission_status(t):
    """Income accrued, transmitted and still pending by period, agency, IA and document type."""
    return _sums(V.v_baar_transmission_status(payments_gold(t)), (
        "total_accrued", "total_transmitted", "total_accepted", "total_rejected", "pending_transmission"))


@query("q_air_v_accrual_holdback_overrides", _materialized(f"""{_AIR_WITH}, {PERIOD_SQL}
SELECT s.period_label, s.agency_name, s.ia_num, li.clin_num, li.line_item_type_desc, s.net_accrued_amt, s.holdback_amt,
       s.inclusion_override_flag, s.inclusion_override_reason, TIMESTAMP '{AS_OF}' AS override_recorded_at
FROM a_star s JOIN d_line_item li ON li.line_item_sk = s.line_item_sk
WHERE s.inclusion_override_flag OR s.holdback_amt <> 0"""))
def q_air_v_accrual_holdback_overrides(t):
    """Incomes held back or included by hand, stamped as their load stamps them."""
    gold = payments_gold(t)
    stamped = gold["air.fact_accrual_income"].withColumn("_gold_updated_at", F.lit(AS_OF).cast("timestamp_ntz"))
    return V.v_accrual_holdback_overrides(ChainMap({"air.fact_accrual_income": stamped}, gold))


_INVOICES = f"""FROM y_payment f
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
WHERE {_in_days('f.invoice_date_sk')} GROUP BY ALL"""
_INVOICE_KEYS = f"""ag.agency_name, ia.ia_num, {FY(_day('f.invoice_date_sk'))} AS federal_fiscal_fy,
       CAST(((month({_day('f.invoice_date_sk')}) + 2) % 12) // 3 + 1 AS INTEGER) AS federal_fiscal_qtr"""


@query("q_tpp_v_prompt_payment_sla", _materialized(f"""{_PAY_WITH}
SELECT {_INVOICE_KEYS}, COUNT(*) AS invoice_count, {_money('f.invoice_amt')} AS total_invoiced,
       CAST(0 AS DECIMAL(38,2)) AS compliant_amt, CAST(0 AS DECIMAL(38,2)) AS late_amt, CAST(NULL AS DOUBLE) AS avg_payment_days,
       CAST(NULL AS INTEGER) AS max_payment_days, CAST(0 AS DOUBLE) AS compliance_pct
{_INVOICES}"""))
def q_tpp_v_prompt_payment_sla(t):
    """Invoices by agency, IA and fiscal quarter; no payment date is known, so none complies and none is late."""
    return _sums(V.v_prompt_payment_sla(_days_over(t, payments_gold(t))), ("total_invoiced", "compliant_amt", "late_amt"))


@query("q_tpp_v_billing_vs_transmitted", _materialized(f"""{_PAY_WITH}
SELECT {_INVOICE_KEYS}, {_NO_SUM} AS total_billed_baar, {_money('f.invoice_amt')} AS total_invoiced, {_NO_SUM} AS total_paid,
       {_NO_SUM} AS total_variance, {_money('f.po_to_rr_variance_amt')} AS total_po_rr_variance
{_INVOICES}"""))
def q_tpp_v_billing_vs_transmitted(t):
    """Invoiced sums and what purchase orders and receiving reports differ by, by IA, agency and quarter."""
    return _sums(V.v_billing_vs_transmitted(_days_over(t, payments_gold(t))), (
        "total_billed_baar", "total_invoiced", "total_paid", "total_variance", "total_po_rr_variance"))


@query("q_tpp_v_transmit_error_log", _materialized(f"""{_PAY_WITH}
SELECT ty.cd AS transmittal_type_cd, 'Type ' || ty.cd AS transmittal_type_desc, en.aac, ag.agency_name, f.transmitted_dt,
       f.error_code, f.error_description, f.retry_count, f.transmitted_amt, {_day('f.event_date_sk')} AS transmission_date,
       CAST(floor(epoch(TIMESTAMP '2002-01-01 00:00:00' - f.transmitted_dt) / 3600) AS BIGINT) AS hours_since_error
FROM y_event f
JOIN y_type ty ON ty.transmittal_type_sk = f.transmittal_type_sk
JOIN y_envelope en ON en.aac_envelope_sk = f.aac_envelope_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
WHERE f.transmittal_status_cd = 'ERROR' AND {_in_days('f.event_date_sk')}"""))
def q_tpp_v_transmit_error_log(t):
    """Failed transmissions with type, envelope, agency and the hours since (D-22)."""
    return V.v_transmit_error_log(_days_over(t, payments_gold(t)))


# an average of cents rounded half up at six places, in whole numbers
_CENTS, _N = "CAST(SUM(f.cost_change_amt) * 100 AS HUGEINT)", "COUNT(f.cost_change_amt)"


@query("q_iat_v_ia_amendment_velocity", _materialized(f"""WITH {SILVER_DIM_SQL}, {FACT_SQL}, {AMEND_SQL}, d_action AS ({_AM_SQL})
SELECT ia.ia_num, ag.agency_name, {FY(_day('f.amend_date_sk'))} AS federal_fiscal_fy, COUNT(*) AS amendment_count,
       {_money('f.cost_change_amt')} AS total_cost_change,
       CAST(COUNT(*) FILTER (WHERE da.changes_scope_flag) AS BIGINT) AS scope_changes,
       CAST(COUNT(*) FILTER (WHERE da.changes_cost_flag) AS BIGINT) AS cost_changes,
       CAST(COUNT(*) FILTER (WHERE da.changes_period_flag) AS BIGINT) AS period_extensions,
       CAST(SUM(f.pop_extension_days) AS BIGINT) AS total_pop_extension_days,
       CASE WHEN {_N} > 0 THEN CAST(sign({_CENTS}) * ((abs({_CENTS}) * 20000 + {_N}) // (2 * {_N})) AS DOUBLE) / 1000000 END AS avg_cost_change
FROM amend f
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_agency ag ON ag.agency_sk = f.agency_sk
JOIN d_action da ON da.amend_action_sk = f.amend_action_sk
WHERE {_in_days('f.amend_date_sk')} GROUP BY ALL"""))
def q_iat_v_ia_amendment_velocity(t):
    """Amendments by IA, agency and fiscal year, with what they changed."""
    gold = _keyed(_with_days(t), "iat.fact_ia_amendment", "source_ia_amendment_id", "ia_amendment_sk")
    return _sums(V.v_ia_amendment_velocity(gold), ("total_cost_change",)) \
        .withColumn("avg_cost_change", F.col("avg_cost_change").cast("double"))


_PSC_WITH = f"{_DIMS_WITH}, {BILLING_SQL}, {SCS_FACT_SQL}, {CLIN_SQL}, d_rate AS ({_CR_SQL})"
_PSC_JOINS = """JOIN d_line_item li ON li.line_item_sk = f.line_item_sk
JOIN d_award aw ON aw.award_sk = f.award_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk"""


@query("q_psc_v_billing_schedule_health", _materialized(f"""{_PSC_WITH}
SELECT ia.ia_num, aw.award_piid, li.clin_num, cs.clin_subtype_cd, bp.billing_period_label, bp.period_start_dt, bp.period_end_dt,
       f.scheduled_amt, f.invoiced_amt, f.accepted_amt, f.invoiced_amt - f.scheduled_amt AS schedule_variance, f.on_schedule_flag,
       f.travel_voucher_amt
FROM scs_fact f {_PSC_JOINS}
JOIN clin_subtype cs ON cs.line_item_id = li.line_item_id
JOIN billing bp ON bp.billing_period_sk = f.billing_period_sk"""))
def q_psc_v_billing_schedule_health(t):
    """Schedules by line, subtype and billing period, with what was invoiced against them."""
    return V.v_billing_schedule_health(_gold(t))


@query("q_psc_v_labor_planned_vs_actual", _materialized(f"""{_PSC_WITH}
SELECT ia.ia_num, aw.award_piid, li.clin_num, r.cost_rate_type_desc, f.planned_amt, f.planned_hours, f.planned_rate, f.actual_amt,
       f.actual_hours, f.actual_amt - f.planned_amt AS amount_variance, f.actual_hours - f.planned_hours AS hours_variance,
       round(CAST(100 AS DOUBLE) * CAST(f.actual_amt AS DOUBLE) / CAST(NULLIF(f.planned_amt, 0) AS DOUBLE), 2) AS pct_of_plan
FROM clin_fact f {_PSC_JOINS}
JOIN clin_subtype cs ON cs.clin_subtype_sk = f.clin_subtype_sk
JOIN d_rate r ON r.cost_rate_type_sk = f.cost_rate_type_sk
WHERE cs.clin_subtype_cd = 'SC_LABOR'"""))
def q_psc_v_labor_planned_vs_actual(t):
    """Labour lines with plan, actuals and their difference."""
    return V.v_labor_planned_vs_actual(_gold(t))
