"""Service charge & CLIN pricing dimensions (psc).

``dim_clin_subtype`` (SET-2): a line item points at one or more subtype
rows (deliverable, labour, fixed fee, travel, award fee). Instead of five
UNION branches that each rescan ``line_item``, the line items are scanned
once and exploded into ``(line_item_id, subtype, subtype_id)`` pairs, the
five subtype tables are unioned into one tagged shape (``subtype_union``),
and one equi-join on ``(subtype, id)`` pairs them. Service charge and
procurement phase are then looked up once.

``dim_billing_period`` (JON-8): invoiced amount per schedule period from
invoice items of the line's latest accepted version whose service dates lie
inside the period — an equi-join on the line with a range residual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import billing_label, yn_flag
from gildhall.operators import assign_sk, decode, pick_one, period_contains, subtype_union
from gildhall.plans.domain.steps import step
from gildhall.sources import live

# Subtype code → line item pointer column and subtype table.
SUBTYPES = [
    ("DELIVERABLE", "li_deliverable_id", "aasbs_li_deliverable"),
    ("SC_LABOR", "li_sc_labor_id", "aasbs_li_sc_labor"),
    ("SC_FIXED_FEE", "li_sc_fixed_fee_id", "aasbs_li_sc_fixed_fee"),
    ("SC_TRAVEL", "li_sc_travel_id", "aasbs_li_sc_travel"),
    ("AWARD_FEE", "li_award_fee_id", "aasbs_li_award_fee"),
]
SERVICE_CHARGE_SUBTYPES = ["SC_LABOR", "SC_FIXED_FEE", "SC_TRAVEL"]


def _opt(df: DataFrame, col: str, dtype: str = "string") -> F.Column:
    return F.col(col) if col in df.columns else F.lit(None).cast(dtype)


def dim_clin_subtype(silver, gold, as_of: str) -> DataFrame:
    li = live(silver["aasbs_line_item"])
    pairs = F.array(*[F.struct(F.lit(cd).alias("clin_subtype_cd"), F.col(ptr).alias("_sub_id"))
                      for cd, ptr, _ in SUBTYPES])
    exploded = (li.select(F.col("id").alias("line_item_id"), "service_charge_id", F.explode(pairs).alias("_p"))
                  .select("line_item_id", "service_charge_id", "_p.*")
                  .filter(F.col("_sub_id").isNotNull()))
    branches = []
    for cd, _, table in SUBTYPES:
        t = live(silver[table])
        branches.append((t, cd, {
            "_sub_id": F.col("id"), "proc_phase_cd": _opt(t, "proc_phase_cd"), "project_num": _opt(t, "project_num"),
            "severability_type_cd": _opt(t, "severability_type_cd"), "psc_cd": _opt(t, "psc_cd"),
            "contract_type_cd": _opt(t, "contract_type_cd")}))
    subs = subtype_union(branches, tag="clin_subtype_cd")
    j = exploded.join(subs, ["clin_subtype_cd", "_sub_id"], "inner")
    sc = live(silver["aasbs_service_charge"]).select(
        F.col("id").alias("service_charge_id"), F.col("act_number").alias("_act"), F.col("is_credit_yn").alias("_credit"))
    j = j.join(sc, "service_charge_id", "left")
    j = decode(j, live(silver["aasbs_lu_proc_phase"]).select("cd", "description"), "proc_phase_cd", "description",
               out="proc_phase_desc", lookup_code="cd")
    is_sc = F.col("clin_subtype_cd").isin(SERVICE_CHARGE_SUBTYPES)
    out = j.select(
        "line_item_id", "clin_subtype_cd", "proc_phase_cd", "proc_phase_desc", "project_num",
        F.when(is_sc, yn_flag("_credit", default="N")).alias("is_credit_flag"),
        F.when(is_sc, F.col("_act")).alias("act_num"),
        "severability_type_cd", "psc_cd", "contract_type_cd")
    return assign_sk(out, ["line_item_id", "clin_subtype_cd"], name="clin_subtype_sk")


def dim_billing_period(silver, gold, as_of: str) -> DataFrame:
    scs = live(silver["aasbs_service_charge_schedule"])
    latest = pick_one(live(silver["aasbs_line_item_accepted"]), "line_item_id", "id", how="max", out="lia_id")
    # periods and invoiced sums are stored before the next joins: their shuffle files end there
    periods = step(gold, scs.filter(F.col("service_start_dt").isNotNull() & F.col("service_end_dt").isNotNull())
                   .select(F.col("id").alias("schedule_id"), "line_item_id", "service_start_dt", "service_end_dt")
                   .join(latest, "line_item_id").drop("line_item_id"))
    items = live(silver["aasbs_invoice_item"]).select(
        F.col("cost_line_item_accepted_id").alias("lia_id"), "invoice_item_begin_dt", "invoice_item_end_dt",
        "invoice_item_amt")
    inside = period_contains(items, periods, "lia_id", "invoice_item_begin_dt", "invoice_item_end_dt",
                             "service_start_dt", "service_end_dt", all_periods=scs)
    invoiced = step(gold, inside.groupBy("schedule_id").agg(F.sum(F.coalesce("invoice_item_amt", F.lit(0))).alias("_inv")))
    s = scs.select(F.col("id").alias("schedule_id"), "service_start_dt", "service_end_dt", "scheduled_amt") \
        .join(invoiced, "schedule_id", "left")
    sched = F.coalesce("scheduled_amt", F.lit(0)).cast("decimal(15,2)")
    inv = F.coalesce("_inv", F.lit(0)).cast("decimal(15,2)")
    start = F.col("service_start_dt")
    out = s.select(
        "schedule_id",
        F.when(start.isNotNull(), billing_label(F.year(start), F.month(start))).alias("billing_period_label"),
        F.to_date(start).alias("period_start_dt"), F.to_date("service_end_dt").alias("period_end_dt"),
        sched.alias("scheduled_amt"), inv.alias("invoiced_amt"),
        F.when(sched != 0, F.round((inv - sched) / sched, 4)).cast("decimal(7,4)").alias("variance_pct"))
    return assign_sk(out, ["schedule_id"], name="billing_period_sk")
