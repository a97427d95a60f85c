"""Service charge schedule and CLIN pricing facts (psc).

fact_service_charge_schedule  one row per schedule period. Invoice items of
    the line's latest accepted version are matched to the periods that
    contain their service dates with ONE equi + range join (JON-8); the
    travel measures are conditional sums of the same join (the reference
    runs the containment join twice). On-schedule is the ±10 % tolerance
    flag, NULL when nothing is scheduled (FN-23).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import within
from gildhall.operators import period_contains, pick_one, resolve_sk
from gildhall.plans.domain.steps import step
from gildhall.sources import live

# Fixed value: on-schedule tolerance.
ON_SCHEDULE_TOLERANCE = 0.10


def fact_service_charge_schedule(silver, gold, as_of: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    scs = live(silver["aasbs_service_charge_schedule"])
    li = live(silver["aasbs_line_item"]).select(
        F.col("id").alias("line_item_id"), "service_charge_id", "parent_award_mod_id", "parent_ia_id",
        F.col("li_sc_travel_id").isNotNull().alias("_is_travel"))
    latest = pick_one(live(silver["aasbs_line_item_accepted"]), "line_item_id", "id", how="max", out="lia_id")
    # the periods, what was invoiced in them and the line's keys are stored before the next joins: their shuffle files end there
    periods = step(gold, scs.filter(F.col("service_start_dt").isNotNull() & F.col("service_end_dt").isNotNull())
                   .select(F.col("id").alias("schedule_id"), "line_item_id", "service_start_dt", "service_end_dt")
                   .join(latest, "line_item_id").drop("line_item_id"))
    items = live(silver["aasbs_invoice_item"]).select(
        F.col("cost_line_item_accepted_id").alias("lia_id"), F.col("id").alias("_item_id"), "invoice_item_begin_dt",
        "invoice_item_end_dt", "invoice_item_amt")
    inside = period_contains(items, periods, "lia_id", "invoice_item_begin_dt", "invoice_item_end_dt",
                             "service_start_dt", "service_end_dt", all_periods=scs)
    per_schedule = step(gold, inside.groupBy("schedule_id").agg(
        F.sum(F.coalesce("invoice_item_amt", zero)).alias("_inv"), F.count("_item_id").alias("_n")))
    # the line's keys are resolved on the lines, the schedule's on the schedules; then the two meet once
    mods = live(silver["aasbs_award_mod"]).select(F.col("id").alias("parent_award_mod_id"), "award_id")
    mods = resolve_sk(mods, gold["common.dim_award"], "award_id", "award_sk").drop("award_id")
    li = li.join(mods, "parent_award_mod_id", "left").drop("parent_award_mod_id")
    li = resolve_sk(li, gold["common.dim_ia"], {"parent_ia_id": "ia_id"}, "ia_sk").drop("parent_ia_id")
    latest = resolve_sk(latest, gold["common.dim_line_item"], {"lia_id": "line_item_accepted_id"}, "line_item_sk").drop("lia_id")
    li = step(gold, li.join(latest, "line_item_id", "full"))     # accepted lines without a line item keep their key
    f = scs.select(F.col("id").alias("schedule_id"), "line_item_id", "sc_schedule_status_cd", "scheduled_amt")
    f = f.join(per_schedule, "schedule_id", "left")
    f = resolve_sk(f, gold["psc.dim_billing_period"], "schedule_id", "billing_period_sk", current_flag=None).drop("schedule_id")
    f = f.join(li, "line_item_id", "left")
    f = f.withColumns({c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("line_item_sk", "award_sk", "ia_sk")})
    travel = F.coalesce(F.col("_is_travel"), F.lit(False))
    sched = F.coalesce("scheduled_amt", zero).cast("decimal(15,2)")
    inv = F.coalesce("_inv", zero).cast("decimal(15,2)")
    return f.select(
        "line_item_sk", "billing_period_sk", "award_sk", "ia_sk",
        F.col("service_charge_id").alias("source_service_charge_id"),
        F.col("sc_schedule_status_cd").alias("schedule_status_cd"), sched.alias("scheduled_amt"),
        inv.alias("invoiced_amt"), inv.alias("accepted_amt"),
        within(inv, sched, ON_SCHEDULE_TOLERANCE).alias("on_schedule_flag"),
        F.coalesce(F.when(travel, F.col("_n")), F.lit(0)).cast("int").alias("travel_voucher_count"),
        F.when(travel, inv).otherwise(zero).cast("decimal(15,2)").alias("travel_voucher_amt"))


def fact_clin_pricing(silver, gold, as_of: str) -> DataFrame:
    """Line × LOA (× subtype) pricing with the LOA burn order.

    The burn order ranks a line's LOAs by their first ledger row (WIN-6):
    aggregate to (line, LOA) first, then number within the line with the
    skew-safe ``rank_by_agg``. Planned amounts are the first non-NULL of the
    labour / fixed-fee / travel plans, else the line total; actuals are the
    line's invoice items, aggregated before the join.
    """
    from gildhall.operators import preagg_join, rank_by_agg

    zero = F.lit(0).cast("decimal(15,2)")
    li = live(silver["aasbs_line_item"])
    any_sub = (F.col("li_deliverable_id").isNotNull() | F.col("li_sc_labor_id").isNotNull()
               | F.col("li_sc_fixed_fee_id").isNotNull() | F.col("li_sc_travel_id").isNotNull()
               | F.col("li_award_fee_id").isNotNull())
    li = li.filter(any_sub)
    lia = live(silver["aasbs_line_item_accepted"])
    ledger = live(silver["aasbs_loa_ledger"]).select(F.col("line_item_accepted_id").alias("lia_id"), "loa_id",
                                                     F.col("id").alias("ll_id"))
    per_loa = ledger.join(lia.select(F.col("id").alias("lia_id"), "line_item_id"), "lia_id")
    burn = rank_by_agg(per_loa, ["loa_id"], ["line_item_id"], [F.min("ll_id").alias("_first_ll")],
                       [F.col("_first_ll"), F.col("loa_id")], name="loa_burn_order")
    burn = resolve_sk(burn.drop("_first_ll"), gold["common.dim_loa"], "loa_id", "loa_sk").drop("loa_id")
    # the line's keys are resolved before its LOAs multiply it
    mods = live(silver["aasbs_award_mod"]).select(F.col("id").alias("parent_award_mod_id"), "award_id")
    mods = resolve_sk(mods, gold["common.dim_award"], "award_id", "award_sk").drop("award_id")
    f = li.select(F.col("id").alias("line_item_id"), "line_item_total_amt", "parent_award_mod_id", "parent_ia_id")
    f = f.join(mods, "parent_award_mod_id", "left").drop("parent_award_mod_id")
    f = resolve_sk(f, gold["common.dim_ia"], {"parent_ia_id": "ia_id"}, "ia_sk").drop("parent_ia_id")
    plan_cols = []
    for ptr, table, alias in [("li_sc_labor_id", "aasbs_li_sc_labor", "_lab"),
                              ("li_sc_fixed_fee_id", "aasbs_li_sc_fixed_fee", "_ff"),
                              ("li_sc_travel_id", "aasbs_li_sc_travel", "_tr")]:
        t = live(silver[table])
        extra = [F.col("cost_rate_type_cd").alias("cost_rate_type_cd")] if alias == "_lab" else []
        # only lines with the pointer: the others would be dealt to one task
        pointed = li.filter(F.col(ptr).isNotNull()).select(F.col("id").alias("line_item_id"), ptr)
        f = f.join(pointed.join(t.select(F.col("id").alias(ptr), F.col("planned_amt").alias(alias), *extra), ptr).drop(ptr),
                   "line_item_id", "left")
        plan_cols.append(F.col(alias))
    f = f.join(burn, "line_item_id", "inner")
    inv = live(silver["aasbs_invoice_item"]).join(
        lia.select(F.col("id").alias("cost_line_item_accepted_id"), "line_item_id"), "cost_line_item_accepted_id")
    f = preagg_join(f, inv, "line_item_id", [F.sum(F.coalesce("invoice_item_amt", zero)).alias("actual_amt")])
    latest = pick_one(lia, "line_item_id", "id", how="max", out="lia_id")
    latest = resolve_sk(latest, gold["common.dim_line_item"], {"lia_id": "line_item_accepted_id"}, "line_item_sk").drop("lia_id")
    f = f.join(latest, "line_item_id", "left")
    subs = gold["psc.dim_clin_subtype"].select("line_item_id", "clin_subtype_sk")
    f = f.join(subs, "line_item_id", "left")
    f = resolve_sk(f, gold["psc.dim_cost_rate_type"], "cost_rate_type_cd", "cost_rate_type_sk", missing=None)
    f = f.withColumns({c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("line_item_sk", "award_sk", "ia_sk")})
    return f.select(
        "line_item_sk", F.coalesce("clin_subtype_sk", F.lit(-1)).cast("bigint").alias("clin_subtype_sk"),
        "cost_rate_type_sk", "award_sk", "ia_sk", "loa_sk",
        F.coalesce(*plan_cols, F.col("line_item_total_amt"), zero).cast("decimal(15,2)").alias("planned_amt"),
        F.lit(None).cast("decimal(10,2)").alias("planned_hours"), F.lit(None).cast("decimal(10,4)").alias("planned_rate"),
        F.lit(None).cast("decimal(15,2)").alias("award_fee_amt"),
        F.lit(None).cast("decimal(7,4)").alias("award_fee_surcharge_rate"),
        F.col("_ff").cast("decimal(15,2)").alias("fixed_fee_amt"),
        F.col("_tr").cast("decimal(15,2)").alias("travel_planned_amt"),
        F.coalesce("actual_amt", zero).cast("decimal(15,2)").alias("actual_amt"),
        F.lit(None).cast("decimal(10,2)").alias("actual_hours"), "loa_burn_order",
        F.lit(None).cast("decimal(7,4)").alias("loa_proration_pct"))
