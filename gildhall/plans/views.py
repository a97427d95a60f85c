"""Domain reporting views over Gold tables.

Every view is ``fn(gold, as_of=...) -> DataFrame`` where ``gold`` maps a
Gold table name (``"oet.fact_obligation_expenditure"``,
``"common.dim_agency"`` …) to a DataFrame. A view is a star join — the fact
joined to dimensions filtered to their current version first — followed
by the view's aggregate. ``as_of`` replaces CURRENT_DATE/CURRENT_TIMESTAMP
so a view is repeatable. Ordering is left to the caller (presentation),
except where noted.

Corrections of the reference's view SQL (SURVEY §2.15):
  D-6  snapshot facts are reduced to the latest snapshot per grain first;
  D-8  ``AVG(COUNT()) OVER`` becomes responses / distinct solicitations;
  D-9  income and expense are aggregated to the join grain before joining;
  D-22 ``hours_since_error`` is computed from seconds, not days.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildhall.operators.dedup import latest_snapshot
from gildhall.operators.sequence import exact_percentile

Gold = Mapping[str, DataFrame]

OET_GRAIN = ["line_item_sk", "loa_sk", "funding_sk", "ia_sk", "fiscal_year", "fiscal_month"]

VIEWS: dict[str, Callable[..., DataFrame]] = {}


def view(name: str):
    def deco(fn):
        VIEWS[name] = fn
        return fn
    return deco


def dim(gold: Gold, name: str, alias: str, current: bool = True) -> DataFrame:
    d = gold[name]
    if current and "is_current_flag" in d.columns:
        d = d.filter(F.col("is_current_flag"))
    return d.alias(alias)


def star(fact: DataFrame, joins: Sequence[tuple], alias: str = "f") -> DataFrame:
    """``joins``: ``(dim_df_aliased, dim_alias, fact_key, dim_key[, how])``.
    ``fact_key`` may be ``other_alias.col`` to chain from a joined dimension."""
    out = fact.alias(alias)
    for j in joins:
        d, da, fk, dk = j[:4]
        how = j[4] if len(j) > 4 else "inner"
        left = F.col(fk) if "." in fk else F.col(f"{alias}.{fk}")
        out = out.join(d, left == F.col(f"{da}.{dk}"), how)
    return out


def c(name: str, alias: str | None = None) -> Column:
    return F.col(name).alias(alias or name.split(".")[-1])


def group_all(df: DataFrame, keys: Sequence[Column], measures: Sequence[Column]) -> DataFrame:
    """GROUP BY ALL: every non-aggregate output column is a key."""
    return df.groupBy(*keys).agg(*measures)


def when_sum(cond: Column, val: Column) -> Column:
    return F.sum(F.when(cond, val).otherwise(F.lit(0)))


def _with_percentiles(df: DataFrame, keys: Sequence[str], value: str, pcts: Mapping[str, float],
                      aggregates: DataFrame) -> DataFrame:
    """Join exact percentiles (rank lookup, no per-group buffer) to the
    other aggregates of the same keys, NULL keys matching."""
    p = exact_percentile(df, keys, value, pcts)
    ren = {k: f"_pk_{i}" for i, k in enumerate(keys)}
    p = p.select(*[F.col(k).alias(ren[k]) for k in keys], *pcts.keys())
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(ren[k]))
        cond = e if cond is None else cond & e
    return aggregates.join(p, cond, "left").drop(*ren.values())


def _oet_fact(gold: Gold) -> DataFrame:
    return latest_snapshot(gold["oet.fact_obligation_expenditure"], OET_GRAIN)


# --- oet -------------------------------------------------------------------

@view("oet.v_cfo_obligation_summary")
def v_cfo_obligation_summary(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(_oet_fact(gold), [
        (dim(gold, "common.dim_agency", "a"), "a", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_line_item", "li"), "li", "line_item_sk", "line_item_sk"),
        (dim(gold, "common.dim_loa", "loa"), "loa", "loa_sk", "loa_sk")])
    keys = [c("a.agency_name"), c("a.bureau_name"), c("f.fiscal_year"), c("f.fiscal_quarter"), c("ia.ia_num"),
            c("ia.ia_type_desc"), c("li.clin_num"), c("li.line_item_type_desc"), c("li.psc_cd"), c("loa.fund_cd"),
            c("loa.treasury_account_symbol"), c("loa.object_class_cd")]
    m = [F.sum(f"f.{x}").alias(f"total_{y}") for x, y in [
        ("obligated_amt", "obligated"), ("accepted_amt", "accepted"), ("billed_amt", "billed"), ("udo_amt", "udo"),
        ("accrued_amt", "accrued"), ("service_charge_amt", "service_charge")]]
    return group_all(j, keys, m)


@view("oet.v_clin_expenditure_detail")
def v_clin_expenditure_detail(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(_oet_fact(gold), [
        (dim(gold, "common.dim_line_item", "li"), "li", "line_item_sk", "line_item_sk"),
        (dim(gold, "common.dim_loa", "loa"), "loa", "loa_sk", "loa_sk"),
        (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "snapshot_date_sk", "date_sk", "left")])
    return j.select("f.*", *[c(x) for x in (
        "li.clin_num", "li.slin_num", "li.line_item_type_desc", "li.psc_cd", "li.li_pop_start_dt", "li.li_pop_end_dt",
        "loa.tracking_num", "loa.treasury_account_symbol", "loa.fund_cd", "loa.object_class_cd",
        "aw.award_piid", "aw.contract_type_desc", "ia.ia_num", "ia.instrument_type_desc",
        "ag.agency_name", "ag.bureau_name", "ag.activity_address_cd")],
        c("d.calendar_date", "snapshot_date"), c("d.federal_fiscal_fy"), c("d.federal_fiscal_qtr"))


@view("oet.v_udo_aging")
def v_udo_aging(gold: Gold, as_of: str = "2002-01-01") -> DataFrame:
    f = _oet_fact(gold).filter(F.col("udo_amt") != 0)
    j = star(f, [
        (dim(gold, "common.dim_line_item", "li"), "li", "line_item_sk", "line_item_sk"),
        (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk")])
    today = F.to_date(F.lit(as_of))
    pop_end = F.to_date(F.col("li.li_pop_end_dt"))
    days = F.datediff(today, pop_end)
    bucket = (F.when(pop_end.isNull(), "No PoP").when(today <= pop_end, "Within PoP")
               .when(days <= 180, "0-180 Days Past PoP").when(days <= 365, "181-365 Days Past PoP")
               .otherwise("Over 1 Year Past PoP"))
    keys = [c("ag.agency_name"), c("ia.ia_num"), c("li.clin_num"), c("li.li_pop_end_dt"), c("aw.award_piid"),
            c("f.fiscal_year"), days.alias("days_past_pop"), bucket.alias("udo_aging_bucket")]
    return group_all(j, keys, [F.sum("f.udo_amt").alias("udo_amt"), F.sum("f.obligated_amt").alias("obligated_amt"),
                               F.sum("f.accepted_amt").alias("accepted_amt")])


# --- alt -------------------------------------------------------------------

def _alt_star(gold: Gold, extra: Sequence[tuple] = ()) -> DataFrame:
    return star(gold["alt.fact_award_lifecycle"], [
        (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"), *extra])


@view("alt.v_co_active_awards")
def v_co_active_awards(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _alt_star(gold, [(dim(gold, "alt.dim_acquisition", "acq"), "acq", "acquisition_sk", "acquisition_sk")])
    j = j.filter(~F.col("aw.award_status_cd").isin("CLOSED", "CANCELLED"))
    keys = [c("aw.award_piid"), c("aw.contract_type_desc"), c("aw.award_end_dt"), c("ag.agency_name"), c("ia.ia_num"),
            c("ia.ia_type_desc"), c("acq.acquisition_status_desc"), c("acq.competition_type_desc"),
            c("acq.processing_speed_cd")]
    return group_all(j, keys, [
        F.count_distinct("f.line_item_sk").alias("clin_count"), F.sum("f.current_obligated_amt").alias("total_obligated"),
        F.sum("f.current_udo_amt").alias("total_udo"), F.sum("f.pending_invoices_count").alias("pending_invoices"),
        F.min("f.days_to_pop_end").alias("min_days_to_pop_end")])


@view("alt.v_acquisition_cycle_time")
def v_acquisition_cycle_time(gold: Gold, as_of: str | None = None) -> DataFrame:
    f = gold["alt.fact_award_lifecycle"].filter(F.col("days_in_pre_award").isNotNull())
    j = star(f, [(dim(gold, "alt.dim_acquisition", "acq"), "acq", "acquisition_sk", "acquisition_sk"),
                 (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
                 (dim(gold, "common.dim_date", "d", current=False), "d", "award_date_sk", "date_sk")])
    flat = j.select(c("acq.acquisition_type_desc"), c("acq.competition_type_desc"), c("acq.processing_speed_cd"),
                    c("ag.agency_name"), c("d.federal_fiscal_fy", "award_fy"), c("f.acquisition_sk"),
                    c("f.days_in_pre_award"))
    keys = ["acquisition_type_desc", "competition_type_desc", "processing_speed_cd", "agency_name", "award_fy"]
    agg = flat.groupBy(*keys).agg(
        F.count_distinct("acquisition_sk").alias("acquisition_count"),
        F.avg("days_in_pre_award").alias("avg_days_pre_award"),
        F.min("days_in_pre_award").alias("min_days_pre_award"), F.max("days_in_pre_award").alias("max_days_pre_award"))
    return _with_percentiles(flat, keys, "days_in_pre_award",
                             {"median_days_pre_award": 0.5, "p90_days_pre_award": 0.9}, agg)


@view("alt.v_closeout_status")
def v_closeout_status(gold: Gold, as_of: str | None = None) -> DataFrame:
    f = gold["alt.fact_award_lifecycle"].filter(F.col("closeout_sk").isNotNull())
    j = star(f, [(dim(gold, "alt.dim_closeout", "cl", current=False), "cl", "closeout_sk", "closeout_sk"),
                 (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk"),
                 (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
                 (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk")])
    bucket = (F.when(F.col("cl.closeout_complete_dt").isNotNull(), "Complete")
               .when(F.col("cl.has_open_udo_flag") | F.col("cl.has_open_invoice_flag"), "Blocked")
               .when(F.col("cl.checklist_completion_pct") >= 100, "Pending Cert").otherwise("In Progress"))
    return j.select(c("ag.agency_name"), c("ia.ia_num"), c("aw.award_piid"), c("cl.co_cert_dt"), c("cl.fma_cert_dt"),
                    c("cl.client_cert_dt"), c("cl.checklist_completion_pct"), c("cl.has_open_udo_flag"),
                    c("cl.has_open_invoice_flag"), c("cl.closeout_prohibition_cds"), c("f.current_udo_amt"),
                    c("f.days_to_pop_end"), bucket.alias("closeout_status_bucket"))


# --- fre -------------------------------------------------------------------

@view("fre.v_fpds_submission_queue")
def v_fpds_submission_queue(gold: Gold, as_of: str = "2002-01-01") -> DataFrame:
    f = gold["fre.fact_fpds_transaction"].filter(F.col("car_status_cd").isin("DRAFT", "SUBMITTED", "ERROR"))
    j = star(f, [(dim(gold, "fre.dim_fpds_award", "fa", current=False), "fa", "fpds_award_sk", "fpds_award_sk"),
                 (dim(gold, "fre.dim_fpds_contractor", "fc"), "fc", "fpds_contractor_sk", "fpds_contractor_sk"),
                 (dim(gold, "fre.dim_fpds_agency", "fag", current=False), "fag", "fpds_agency_sk", "fpds_agency_sk"),
                 (dim(gold, "common.dim_date", "d", current=False), "d", "action_date_sk", "date_sk", "left")])
    return j.select(c("f.award_mod_id"), c("f.mod_num"), c("f.car_status_cd"), c("fa.piid"), c("fa.fpds_car_status_cd"),
                    c("fc.uei"), c("fc.company_name"), c("fag.agency_name"), c("fag.aac"),
                    c("f.action_obligation_amt"), c("f.action_type_cd"), c("d.calendar_date", "action_date"),
                    c("f.car_submitted_dt"), c("f.car_accepted_dt"),
                    F.datediff(F.to_date(F.lit(as_of)), F.col("f.car_submitted_dt")).alias("days_since_submission"))


@view("fre.v_fpds_obligation_by_agency")
def v_fpds_obligation_by_agency(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(gold["fre.fact_fpds_transaction"], [
        (dim(gold, "fre.dim_fpds_agency", "fag", current=False), "fag", "fpds_agency_sk", "fpds_agency_sk"),
        (dim(gold, "fre.dim_fpds_contractor", "fc"), "fc", "fpds_contractor_sk", "fpds_contractor_sk"),
        (dim(gold, "fre.dim_fpds_psc", "psc", current=False), "psc", "psc_sk", "psc_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "action_date_sk", "date_sk")])
    keys = [c("fag.agency_name"), c("fag.bureau_name"), c("d.federal_fiscal_fy"), c("d.federal_fiscal_qtr"),
            c("psc.psc_cd"), c("psc.psc_description"), c("psc.psc_category"), c("fc.sba_program_cd"),
            c("f.competition_type_cd"), c("f.reason_not_competed_cd")]
    amt = F.col("f.action_obligation_amt")
    return group_all(j, keys, [F.count(F.lit(1)).alias("transaction_count"), F.sum(amt).alias("total_obligations"),
                               F.sum("f.base_all_opts_amt").alias("total_potential_value"),
                               when_sum(F.col("f.is_small_business_flag"), amt).alias("sb_obligations")])


# --- air -------------------------------------------------------------------

def _air_star(gold: Gold, extra: Sequence[tuple] = ()) -> DataFrame:
    return star(gold["air.fact_accrual_income"], [
        (dim(gold, "air.dim_accrual_period", "ap", current=False), "ap", "accrual_period_sk", "accrual_period_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"), *extra], alias="ai")


@view("air.v_revenue_vs_expense")
def v_revenue_vs_expense(gold: Gold, as_of: str | None = None) -> DataFrame:
    """Income and expense both aggregated to the join grain first (fix for D-9)."""
    j = _air_star(gold)
    keys = ["period_label", "accrual_fy", "accrual_fy_quarter", "agency_name", "ia_num"]
    grain = ["line_item_sk", "loa_sk", "accrual_fy", "accrual_fy_month"]
    inc = j.select(c("ap.period_label"), c("ap.accrual_fy"), c("ap.accrual_fy_quarter"), c("ap.accrual_fy_month"),
                   c("ag.agency_name"), c("ia.ia_num"), c("ai.line_item_sk"), c("ai.loa_sk"), c("ai.net_accrued_amt"),
                   c("ai.baar_accepted_amt"), c("ai.baar_rejected_amt"))
    inc = inc.groupBy(*keys, *[g for g in grain if g not in keys]).agg(
        F.sum("net_accrued_amt").alias("inc"), F.sum("baar_accepted_amt").alias("acc"),
        F.sum("baar_rejected_amt").alias("rej"))
    exp = _oet_fact(gold).groupBy(F.col("line_item_sk"), F.col("loa_sk"), F.col("fiscal_year").alias("accrual_fy"),
                                  F.col("fiscal_month").alias("accrual_fy_month")).agg(F.sum("accrued_amt").alias("exp"))
    both = inc.join(exp, grain, "left")
    return both.groupBy(*keys).agg(
        F.sum("inc").alias("total_income_accrued"), F.sum("exp").alias("total_expense_accrued"),
        (F.sum("inc") - F.coalesce(F.sum("exp"), F.lit(0))).alias("net_revenue_margin"),
        F.sum("acc").alias("baar_accepted"), F.sum("rej").alias("baar_rejected"))


@view("air.v_baar_transmission_status")
def v_baar_transmission_status(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _air_star(gold, [(dim(gold, "air.dim_onefund_program", "on2", current=False), "on2", "onefund_sk", "onefund_sk")])
    keys = [c("ap.period_label"), c("ap.accrual_fy"), c("ag.agency_name"), c("ia.ia_num"), c("on2.baar_doc_type_cd"),
            c("on2.baar_doc_type_desc")]
    net = F.col("ai.net_accrued_amt")
    return group_all(j, keys, [
        F.count(F.lit(1)).alias("record_count"), F.sum(net).alias("total_accrued"),
        F.sum("ai.baar_transmitted_amt").alias("total_transmitted"), F.sum("ai.baar_accepted_amt").alias("total_accepted"),
        F.sum("ai.baar_rejected_amt").alias("total_rejected"),
        when_sum(F.col("ai.baar_transmission_status_cd") == "PENDING", net).alias("pending_transmission")])


@view("air.v_accrual_holdback_overrides")
def v_accrual_holdback_overrides(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _air_star(gold, [(dim(gold, "common.dim_line_item", "li"), "li", "line_item_sk", "line_item_sk")])
    j = j.filter((F.col("ai.inclusion_override_flag") == F.lit(True)) | (F.col("ai.holdback_amt") != 0))
    return j.select(c("ap.period_label"), c("ag.agency_name"), c("ia.ia_num"), c("li.clin_num"),
                    c("li.line_item_type_desc"), c("ai.net_accrued_amt"), c("ai.holdback_amt"),
                    c("ai.inclusion_override_flag"), c("ai.inclusion_override_reason"),
                    c("ai._gold_updated_at", "override_recorded_at"))


# --- tpp -------------------------------------------------------------------

def _tpp_recon(gold: Gold) -> DataFrame:
    return star(gold["tpp.fact_payment_reconciliation"], [
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "invoice_date_sk", "date_sk")])


@view("tpp.v_prompt_payment_sla")
def v_prompt_payment_sla(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _tpp_recon(gold)
    ok = F.col("f.is_prompt_payment_compliant")
    amt = F.col("f.invoice_amt")
    keys = [c("ag.agency_name"), c("ia.ia_num"), c("d.federal_fiscal_fy"), c("d.federal_fiscal_qtr")]
    return group_all(j, keys, [
        F.count(F.lit(1)).alias("invoice_count"), F.sum(amt).alias("total_invoiced"),
        when_sum(ok, amt).alias("compliant_amt"), when_sum(~ok, amt).alias("late_amt"),
        F.avg("f.invoice_to_payment_days").alias("avg_payment_days"),
        F.max("f.invoice_to_payment_days").alias("max_payment_days"),
        F.round(F.lit(100.0) * when_sum(ok, F.lit(1)) / F.count(F.lit(1)), 2).alias("compliance_pct")])


@view("tpp.v_transmit_error_log")
def v_transmit_error_log(gold: Gold, as_of: str = "2002-01-01 00:00:00") -> DataFrame:
    """Errors with hours since the error from seconds (fix for D-22)."""
    f = gold["tpp.fact_transmission_event"].filter(F.col("transmittal_status_cd") == "ERROR")
    j = star(f, [(dim(gold, "tpp.dim_transmittal_type", "tt", current=False), "tt", "transmittal_type_sk", "transmittal_type_sk"),
                 (dim(gold, "tpp.dim_aac_envelope", "ae", current=False), "ae", "aac_envelope_sk", "aac_envelope_sk"),
                 (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
                 (dim(gold, "common.dim_date", "d", current=False), "d", "event_date_sk", "date_sk")])
    secs = (F.unix_timestamp(F.lit(as_of).cast("timestamp"))
            - F.unix_timestamp(F.col("f.transmitted_dt").cast("timestamp")))
    return j.select(c("tt.transmittal_type_cd"), c("tt.transmittal_type_desc"), c("ae.aac"), c("ag.agency_name"),
                    c("f.transmitted_dt"), c("f.error_code"), c("f.error_description"), c("f.retry_count"),
                    c("f.transmitted_amt"), c("d.calendar_date", "transmission_date"),
                    F.floor(secs / 3600).cast("long").alias("hours_since_error"))


@view("tpp.v_billing_vs_transmitted")
def v_billing_vs_transmitted(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _tpp_recon(gold)
    keys = [c("ia.ia_num"), c("ag.agency_name"), c("d.federal_fiscal_fy"), c("d.federal_fiscal_qtr")]
    return group_all(j, keys, [
        F.sum("f.billing_amt").alias("total_billed_baar"), F.sum("f.invoice_amt").alias("total_invoiced"),
        F.sum("f.payment_amt").alias("total_paid"), F.sum("f.invoice_to_billing_variance_amt").alias("total_variance"),
        F.sum("f.po_to_rr_variance_amt").alias("total_po_rr_variance")])


# --- psc -------------------------------------------------------------------

def _psc_base(gold: Gold, fact: str) -> list[tuple]:
    return [(dim(gold, "common.dim_line_item", "li"), "li", "line_item_sk", "line_item_sk"),
            (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk"),
            (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk")]


@view("psc.v_billing_schedule_health")
def v_billing_schedule_health(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(gold["psc.fact_service_charge_schedule"], _psc_base(gold, "s") + [
        (dim(gold, "psc.dim_clin_subtype", "cs", current=False), "cs", "li.line_item_id", "line_item_id"),
        (dim(gold, "psc.dim_billing_period", "bp", current=False), "bp", "billing_period_sk", "billing_period_sk")])
    return j.select(c("ia.ia_num"), c("aw.award_piid"), c("li.clin_num"), c("cs.clin_subtype_cd"),
                    c("bp.billing_period_label"), c("bp.period_start_dt"), c("bp.period_end_dt"), c("f.scheduled_amt"),
                    c("f.invoiced_amt"), c("f.accepted_amt"),
                    (F.col("f.invoiced_amt") - F.col("f.scheduled_amt")).alias("schedule_variance"),
                    c("f.on_schedule_flag"), c("f.travel_voucher_amt"))


def _pricing(gold: Gold, subtype: str, extra: Sequence[tuple] = ()) -> DataFrame:
    j = star(gold["psc.fact_clin_pricing"], _psc_base(gold, "p") + [
        (dim(gold, "psc.dim_clin_subtype", "cs", current=False), "cs", "clin_subtype_sk", "clin_subtype_sk"), *extra])
    return j.filter(F.col("cs.clin_subtype_cd") == subtype)


@view("psc.v_labor_planned_vs_actual")
def v_labor_planned_vs_actual(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _pricing(gold, "SC_LABOR", [(dim(gold, "psc.dim_cost_rate_type", "crt", current=False), "crt",
                                     "cost_rate_type_sk", "cost_rate_type_sk")])
    pa, aa = F.col("f.planned_amt"), F.col("f.actual_amt")
    return j.select(c("ia.ia_num"), c("aw.award_piid"), c("li.clin_num"), c("crt.cost_rate_type_desc"),
                    c("f.planned_amt"), c("f.planned_hours"), c("f.planned_rate"), c("f.actual_amt"), c("f.actual_hours"),
                    (aa - pa).alias("amount_variance"), (F.col("f.actual_hours") - F.col("f.planned_hours")).alias("hours_variance"),
                    F.round(F.try_divide(F.lit(100.0) * aa, F.nullif(pa, F.lit(0))), 2).alias("pct_of_plan"))


@view("psc.v_award_fee_performance")
def v_award_fee_performance(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _pricing(gold, "AWARD_FEE")
    return j.select(c("ia.ia_num"), c("aw.award_piid"), c("li.clin_num"), c("f.planned_amt", "total_award_fee_pool"),
                    c("f.award_fee_amt", "earned_award_fee"), c("f.award_fee_surcharge_rate"),
                    c("f.actual_amt", "total_tracked_amt"),
                    F.round(F.try_divide(F.lit(100.0) * F.col("f.award_fee_amt"), F.nullif(F.col("f.planned_amt"), F.lit(0))), 2)
                    .alias("pct_fee_earned"))


# --- smi -------------------------------------------------------------------

@view("smi.v_competition_analytics")
def v_competition_analytics(gold: Gold, as_of: str | None = None) -> DataFrame:
    """Average responses per solicitation as responses / distinct
    solicitations in the group (fix for D-8, AGG-14)."""
    j = star(gold["smi.fact_solicitation_response"], [
        (dim(gold, "alt.dim_acquisition", "acq"), "acq", "acquisition_sk", "acquisition_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "response_date_sk", "date_sk")])
    sb = F.col("f.is_small_business_flag")
    keys = [c("ag.agency_name"), c("ia.ia_num"), c("acq.acquisition_type_desc"), c("acq.competition_type_desc"),
            c("d.federal_fiscal_fy", "solicitation_fy")]
    n_sol = F.count_distinct("f.solicitation_sk")
    return group_all(j, keys, [
        n_sol.alias("solicitation_count"),
        F.round(F.count("f.sol_response_sk") / n_sol, 2).alias("avg_responses_per_sol"),
        when_sum(sb, F.lit(1)).alias("sb_responses"),
        F.round(F.try_divide(F.lit(100.0) * when_sum(sb, F.lit(1)), F.nullif(F.count(F.lit(1)), F.lit(0))), 2)
        .alias("sb_response_pct"),
        F.sum("f.award_total_amt").alias("total_awarded")])


@view("smi.v_bid_price_distribution")
def v_bid_price_distribution(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(gold["smi.fact_solicitation_response"], [
        (dim(gold, "alt.dim_solicitation", "sol", current=False), "sol", "solicitation_sk", "solicitation_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk")])
    flat = j.select(c("sol.solicit_num"), c("sol.sol_status_desc"), c("ag.agency_name"), c("ia.ia_num"),
                    c("f.sol_response_sk"), c("f.bid_total_amt"), c("f.is_winner_flag"))
    keys = ["solicit_num", "sol_status_desc", "agency_name", "ia_num"]
    win = F.max(F.when(F.col("is_winner_flag"), F.col("bid_total_amt")))
    agg = flat.groupBy(*keys).agg(
        F.count("sol_response_sk").alias("total_responses"), F.min("bid_total_amt").alias("min_bid"),
        F.max("bid_total_amt").alias("max_bid"), F.avg("bid_total_amt").alias("avg_bid"), win.alias("winning_bid"),
        (win - F.min("bid_total_amt")).alias("winning_vs_low_spread"))
    return _with_percentiles(flat, keys, "bid_total_amt", {"median_bid": 0.5}, agg)


# --- wpr -------------------------------------------------------------------

@view("wpr.v_cor_delegation_compliance")
def v_cor_delegation_compliance(gold: Gold, as_of: str | None = None) -> DataFrame:
    f = gold["wpr.fact_role_assignment"].filter(F.col("assignment_status_cd") == "Active")
    j = star(f, [(dim(gold, "wpr.dim_user", "u"), "u", "user_sk", "user_sk"),
                 (dim(gold, "wpr.dim_responsible_role", "rr", current=False), "rr", "responsible_role_sk", "responsible_role_sk"),
                 (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
                 (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk")])
    j = j.filter(F.col("rr.responsible_role_cd") == "COR")
    gap = F.coalesce(F.col("rr.requires_delegation_flag") & ~F.col("f.has_delegation_flag"), F.lit(False))
    return j.select(c("u.full_name"), c("u.email"), c("u.org_name"), c("u.region_cd"), c("ag.agency_name"),
                    c("ia.ia_num"), c("rr.responsible_role_desc"), c("f.has_delegation_flag"),
                    c("f.delegation_letter_ref"), c("f.awards_assigned_count"), c("f.total_obligated_amt"),
                    gap.alias("delegation_gap_flag"))


@view("wpr.v_workload_by_region")
def v_workload_by_region(gold: Gold, as_of: str | None = None) -> DataFrame:
    f = gold["wpr.fact_role_assignment"].filter(F.col("assignment_status_cd") == "Active")
    j = star(f, [(dim(gold, "wpr.dim_org_hierarchy", "org", current=False), "org", "org_sk", "org_sk"),
                 (dim(gold, "wpr.dim_responsible_role", "rr", current=False), "rr", "responsible_role_sk", "responsible_role_sk")])
    keys = [c("org.region_cd"), c("org.org_name"), c("org.org_level"), c("rr.responsible_role_desc")]
    return group_all(j, keys, [
        F.count_distinct("f.user_sk").alias("staff_count"), F.sum("f.awards_assigned_count").alias("total_awards"),
        F.avg("f.awards_assigned_count").alias("avg_awards_per_person"),
        F.sum("f.active_clin_count").alias("total_active_clins"), F.sum("f.total_obligated_amt").alias("total_obligated")])


# --- iat -------------------------------------------------------------------

def _iat_amend(gold: Gold, extra: Sequence[tuple] = ()) -> DataFrame:
    return star(gold["iat.fact_ia_amendment"], [
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"), *extra,
        (dim(gold, "common.dim_date", "d", current=False), "d", "amend_date_sk", "date_sk")])


@view("iat.v_ia_amendment_velocity")
def v_ia_amendment_velocity(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _iat_amend(gold, [(dim(gold, "iat.dim_amend_action", "da", current=False), "da", "amend_action_sk", "amend_action_sk")])
    keys = [c("ia.ia_num"), c("ag.agency_name"), c("d.federal_fiscal_fy")]
    return group_all(j, keys, [
        F.count("f.ia_amendment_sk").alias("amendment_count"), F.sum("f.cost_change_amt").alias("total_cost_change"),
        when_sum(F.col("da.changes_scope_flag"), F.lit(1)).alias("scope_changes"),
        when_sum(F.col("da.changes_cost_flag"), F.lit(1)).alias("cost_changes"),
        when_sum(F.col("da.changes_period_flag"), F.lit(1)).alias("period_extensions"),
        F.sum("f.pop_extension_days").alias("total_pop_extension_days"),
        F.avg("f.cost_change_amt").alias("avg_cost_change")])


@view("iat.v_ia_annual_review_status")
def v_ia_annual_review_status(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(gold["iat.fact_ia_review"], [
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "review_date_sk", "date_sk")], alias="r")
    keys = [c("ia.ia_num"), c("ia.ia_status_desc"), c("ia.ia_end_dt"), c("ag.agency_name"),
            c("d.federal_fiscal_fy", "review_fy")]
    od = F.col("r.days_overdue")
    return group_all(j, keys, [
        F.count("r.ia_review_sk").alias("reviews_completed"), when_sum(od > 0, F.lit(1)).alias("overdue_reviews"),
        F.max(od).alias("max_days_overdue"),
        F.min(F.when(~F.col("r.review_completed_flag"), od)).alias("current_days_overdue")])


@view("iat.v_fin_code_history")
def v_fin_code_history(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = _iat_amend(gold)
    return j.select(c("ia.ia_num"), c("ag.agency_name"), c("f.source_ia_amendment_id"), c("f.amendment_num"),
                    c("d.calendar_date", "amendment_dt"), c("f.servicing_aac_cd"), c("f.validation_override_flag"),
                    c("f.validation_override_reason"), c("ia.ia_status_desc"))


# --- cat -------------------------------------------------------------------

@view("cat.v_pre_award_review_compliance")
def v_pre_award_review_compliance(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(gold["cat.fact_review_determination"], [
        (dim(gold, "cat.dim_review_type", "rt", current=False), "rt", "review_type_sk", "review_type_sk"),
        (dim(gold, "cat.dim_finding", "fi", current=False), "fi", "finding_sk", "finding_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk"),
        (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "review_date_sk", "date_sk")])
    keys = [c("ag.agency_name"), c("ia.ia_num"), c("aw.award_piid"), c("rt.review_type_desc"), c("rt.is_mandatory_flag"),
            c("d.federal_fiscal_fy")]
    return group_all(j, keys, [
        F.count("f.review_determination_sk").alias("total_reviews"),
        F.avg("f.days_to_determination").alias("avg_days_to_determination"),
        when_sum(F.col("fi.is_blocking_flag"), F.lit(1)).alias("blocking_findings"),
        when_sum(F.col("f.is_blocking_finding_flag"), F.lit(1)).alias("awards_blocked")])


@view("cat.v_event_timeline")
def v_event_timeline(gold: Gold, as_of: str | None = None) -> DataFrame:
    j = star(gold["cat.fact_lifecycle_event"], [
        (dim(gold, "cat.dim_event_type", "et", current=False), "et", "event_type_sk", "event_type_sk"),
        (dim(gold, "common.dim_agency", "ag"), "ag", "agency_sk", "agency_sk"),
        (dim(gold, "common.dim_date", "d", current=False), "d", "event_date_sk", "date_sk"),
        (dim(gold, "common.dim_ia", "ia"), "ia", "ia_sk", "ia_sk", "left"),
        (dim(gold, "common.dim_award", "aw"), "aw", "award_sk", "award_sk", "left")])
    return j.select(c("et.lifecycle_phase_cd"), c("et.event_type_desc"), c("ia.ia_num"), c("aw.award_piid"),
                    c("ag.agency_name"), c("d.calendar_date", "event_date"), c("f.event_timestamp"),
                    c("f.event_user_id"), c("f.event_description"), c("f.collab_type_cd"), c("f.collab_status_cd"),
                    c("f.email_status_cd"))
