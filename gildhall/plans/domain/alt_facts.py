"""Award lifecycle fact (alt): one row per accepted line.

Corrections (SURVEY §2.15):
  D-10 invoice counts come through the invoice items of the accepted line
       (``cost_line_item_accepted_id``) and accepted amounts from the
       acceptance items of the line, not by treating invoice ids as line ids;
  D-18 the IA is the award's IA through the bridge (smallest), not a lookup
       by the accepted-line id;
  fan-out an acquisition's solicitation and its latest-modification
       contractor are each reduced to one (smallest key) before joining.
The latest accrual per line is a keep-one by month end then id (WIN-3);
day counts use ``as_of`` instead of the current date (FN-10, FN-11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import date_sk, like_any
from gildhall.operators import keep_one, pick_one, preagg_join, resolve_sk
from gildhall.session import stored
from gildhall.sources import live

# Acquisition status patterns → procurement phase (code, description), first match wins.
PHASES = [
    (("CLOSEOUT", "Closeout"), ["%CLOSE%", "%COMPLETE%"]),
    (("POST_AWARD", "Post-Award"), ["%POST_AWARD%", "%INVOICE%", "%ACCEPT%"]),
    (("AWARD", "Award"), ["%AWARD%"]),
    (("SOLICITATION", "Solicitation"), ["%SOL%", "%EVAL%"]),
]
DEFAULT_PHASE = ("PRE_AWARD", "Pre-Award")
CLOSED_INVOICE_STATUSES = ["ACCEPTED", "CANCELLED", "REJECTED"]


def _phase(status, i: int) -> F.Column:
    s = F.coalesce(status, F.lit(""))
    out = None
    for labels, pats in PHASES:
        cond = like_any(s, pats)
        out = F.when(cond, labels[i]) if out is None else out.when(cond, labels[i])
    return out.otherwise(DEFAULT_PHASE[i])


def _by_modification(silver, gold) -> DataFrame:
    """Award, acquisition and their keys of each latest modification: one row per modification, the smallest award's."""
    awards = live(silver["aasbs_award"])
    first = F.min(F.struct(F.col("id").alias("award_id"), "acquisition_id")).alias("_first")
    m = awards.where(F.col("id").isNotNull()).groupBy(F.col("latest_award_mod_id").alias("award_mod_id")).agg(first) \
        .select("award_mod_id", "_first.award_id", "_first.acquisition_id")
    bridge = pick_one(live(silver["aasbs_award_ia"]), "award_id", "ia_id", how="min")
    m = resolve_sk(m.join(bridge, "award_id", "left"), gold["common.dim_ia"], "ia_id", "ia_sk").drop("award_id", "ia_id")
    # modifications per acquisition, and the smallest company of those with the latest number
    companies = pick_one(live(silver["aasbs_award_mod_company"]).select(F.col("award_mod_id").alias("id"), F.col("id").alias("_company")),
                         "id", "_company", how="min")
    mods = live(silver["aasbs_award_mod"]).select("id", "award_id", "mod_num", "m1p_mod_start_dt").join(
        awards.select(F.col("id").alias("award_id"), "acquisition_id"), "award_id").join(companies, "id", "left")
    per_num = mods.groupBy("acquisition_id", "mod_num").agg(
        F.count("id").alias("_n"), F.max("m1p_mod_start_dt").alias("_last"), F.min("_company").alias("award_mod_company_id"))
    latest = F.max(F.when(F.col("mod_num").isNotNull(), F.struct("mod_num", "award_mod_company_id"))).alias("_latest")
    per_acq = per_num.groupBy("acquisition_id").agg(
        F.sum("_n").alias("mods_count"), F.max("_last").alias("_last_mod_signed"), latest) \
        .select("acquisition_id", "mods_count", "_last_mod_signed", "_latest.award_mod_company_id")
    m = m.join(per_acq, "acquisition_id", "left")
    acq = gold["alt.dim_acquisition"].filter(F.col("is_current_flag")).select(
        "acquisition_id", "acquisition_sk", F.col("agency_sk").alias("_acq_agency"), "acquisition_status_cd",
        F.col("created_dt").alias("_acq_created"))
    m = m.join(acq, "acquisition_id", "left")
    m = resolve_sk(m, gold["alt.dim_closeout"], "acquisition_id", "closeout_sk", missing=None).drop("acquisition_id")
    sol = pick_one(gold["alt.dim_solicitation"], "acquisition_sk", "solicitation_sk", how="min")
    m = m.join(sol, "acquisition_sk", "left")
    return resolve_sk(m, gold["alt.dim_contractor"], "award_mod_company_id", "contractor_sk", missing=None) \
        .drop("award_mod_company_id")


def fact_award_lifecycle(silver, gold, as_of: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    today = F.to_date(F.lit(as_of))
    f = live(silver["aasbs_line_item_accepted"]).select(F.col("id").alias("lia_id"), "award_mod_id")
    # D-10: invoices of the line through its invoice items; acceptance items of the line
    items = live(silver["aasbs_invoice_item"]).filter(F.col("cost_line_item_accepted_id").isNotNull())
    invoices = live(silver["aasbs_invoice"]).select(F.col("id").alias("invoice_id"), "invoice_status_cd")
    per_line_inv = items.select(F.col("cost_line_item_accepted_id").alias("lia_id"), "invoice_id").distinct() \
        .join(invoices, "invoice_id")
    f = preagg_join(f, per_line_inv, "lia_id", [
        F.count(F.lit(1)).alias("total_invoices_count"),
        F.count_if(~F.col("invoice_status_cd").isin(CLOSED_INVOICE_STATUSES)).alias("pending_invoices_count")])
    acc = live(silver["aasbs_acceptance_item"]).withColumnRenamed("line_item_accepted_id", "lia_id")
    f = preagg_join(f, acc, "lia_id", [F.sum(F.coalesce("item_gsa_approved_amt", zero)).alias("current_accepted_amt")])
    accrual = keep_one(live(silver["aasbs_accrual_expense"]), ["line_item_accepted_id"],
                       [F.col("accrual_month_end_dt").desc_nulls_last(), F.col("id").desc()]) \
        .select(F.col("line_item_accepted_id").alias("lia_id"), F.col("udo_amt").alias("_holdback"))
    f = f.join(accrual, "lia_id", "left")
    li = gold["common.dim_line_item"].filter(F.col("is_current_flag")).select(
        F.col("line_item_accepted_id").alias("lia_id"), "line_item_sk", "li_pop_end_dt", "obligated_ceiling_amt")
    # stored: the shuffle files of the lines are gone when those of the modifications are written
    f = stored(f.join(li, "lia_id", "left").drop("lia_id"))
    # what the award and its acquisition decide is joined per modification, not on the lines
    f = f.join(_by_modification(silver, gold), "award_mod_id", "left")
    f = f.withColumn("ia_sk", F.coalesce("ia_sk", F.lit(-1)).cast("bigint"))
    aw = gold["common.dim_award"].filter(F.col("is_current_flag")).select("award_mod_id", "award_sk", "award_start_dt")
    f = f.join(pick_one(aw, "award_mod_id", "award_sk", how="min").join(aw.select("award_sk", "award_start_dt"),
                                                                          "award_sk"), "award_mod_id", "left")
    ceiling = F.coalesce("obligated_ceiling_amt", zero)
    accepted = F.coalesce("current_accepted_amt", zero)
    return f.select(
        F.coalesce("line_item_sk", F.lit(-1)).cast("bigint").alias("line_item_sk"),
        F.coalesce("award_sk", F.lit(-1)).cast("bigint").alias("award_sk"),
        F.coalesce("acquisition_sk", F.lit(-1)).cast("bigint").alias("acquisition_sk"),
        "solicitation_sk", "contractor_sk", "closeout_sk", "ia_sk",
        F.coalesce("_acq_agency", F.lit(-1)).cast("bigint").alias("agency_sk"),
        date_sk("award_start_dt").alias("award_date_sk"), date_sk("_last_mod_signed").alias("last_mod_date_sk"),
        _phase(F.upper(F.col("acquisition_status_cd")), 0).alias("current_proc_phase_cd"),
        _phase(F.upper(F.col("acquisition_status_cd")), 1).alias("current_proc_phase_desc"),
        F.datediff(F.to_date("award_start_dt"), F.to_date("_acq_created")).alias("days_in_pre_award"),
        F.datediff(today, F.to_date("_last_mod_signed")).alias("days_since_last_mod"),
        F.datediff(F.to_date("li_pop_end_dt"), today).alias("days_to_pop_end"),
        F.coalesce("mods_count", F.lit(0)).cast("int").alias("mods_count"),
        F.coalesce("total_invoices_count", F.lit(0)).cast("int").alias("total_invoices_count"),
        F.coalesce("pending_invoices_count", F.lit(0)).cast("int").alias("pending_invoices_count"),
        zero.alias("base_award_amt"), ceiling.cast("decimal(15,2)").alias("current_obligated_amt"),
        accepted.cast("decimal(15,2)").alias("current_accepted_amt"),
        F.greatest(ceiling - accepted, zero).cast("decimal(15,2)").alias("current_udo_amt"),
        F.coalesce("_holdback", zero).cast("decimal(15,2)").alias("accrual_holdback_amt"))
