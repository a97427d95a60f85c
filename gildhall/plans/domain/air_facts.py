"""Accrual income fact (air): one row per income distribution.

The accrual month arrives as '1', '01' or 'JAN' and is decoded once
(FN-13, FLT-3) before it picks the accrual period; the holdback is derived
once and used twice (PRJ-2). Transmission status and document type are the
values of the latest transmission header, ties broken by id (AGG-5,
``max_by`` over a struct). Every lookup is made one row per key before the
join: LOA by tracking number (smallest id), IA per award through the bridge
(JON-6), batch per income (smallest), document type per AAC (active
mapping first, then oldest — WIN-2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import month_number
from gildhall.operators import keep_one, pick_one, preagg_join, resolve_sk
from gildhall.session import stored
from gildhall.sources import live

# Fixed value: reconciliation tolerance between distributed and calculated income.
RECON_TOLERANCE = 0.01


def fact_accrual_income(silver, gold, as_of: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    dist = live(silver["aasbs_accrual_income_dist"]).select(
        F.col("id").alias("dist_id"), "accrual_income_id", "tracking_num", "distribute_amt", "proration_pct",
        "accrual_transmission_status_cd")
    inc = live(silver["aasbs_accrual_income"]).select(
        F.col("id").alias("accrual_income_id"), "accrual_year", "accrual_month", "line_item_accepted_id",
        "accrual_income_amt", "include_in_transmission_yn", "accrual_income_calc_comment", "accrual_expense_id")
    # what an income decides is joined on the incomes, before its distributions multiply them
    inc = inc.withColumn("accrual_month_int", month_number("accrual_month"))
    inc = resolve_sk(inc, gold["air.dim_accrual_period"], {"accrual_year": "accrual_year", "accrual_month_int": "accrual_month"},
                     "accrual_period_sk").drop("accrual_year", "accrual_month", "accrual_month_int")
    inc = resolve_sk(inc, gold["common.dim_line_item"], "line_item_accepted_id", "line_item_sk").drop("line_item_accepted_id")
    exp = live(silver["aasbs_accrual_expense"]).select(
        F.col("id").alias("accrual_expense_id"), "award_id",
        (F.coalesce("accrual_expense_amt_before_holdback", zero)
         - F.coalesce("accrual_expense_amt_with_holdback_applied", zero)).alias("_gap"))
    inc = inc.join(exp, "accrual_expense_id", "left").drop("accrual_expense_id")
    # the IA's key is resolved on the awards, so the incomes move once for both
    bridge = pick_one(live(silver["aasbs_award_ia"]), "award_id", "ia_id", how="min")
    bridge = resolve_sk(bridge, gold["common.dim_ia"], "ia_id", "ia_sk").drop("ia_id")
    inc = inc.join(bridge, "award_id", "left").drop("award_id")
    inc = inc.withColumn("ia_sk", F.coalesce("ia_sk", F.lit(-1)).cast("bigint"))
    il = live(silver["accrual_accrual_income_line"])
    ah = live(silver["accrual_accrual_header"]).select("accrual_header_id", "accrual_batch_id")
    batch = pick_one(il.join(ah, "accrual_header_id"), "accrual_income_id", "accrual_batch_id", how="min")
    # batches and resolved distributions are stored, so their shuffle files are gone when the incomes' begin
    inc = inc.join(stored(batch), "accrual_income_id", "left")
    # what a distribution decides: its LOA by tracking number, its transmissions
    loa = live(silver["aasbs_loa"]).filter(F.col("tracking_num").isNotNull())
    loa_by_tracking = pick_one(loa, "tracking_num", "id", how="min", out="loa_id") \
        .join(loa.select(F.col("id").alias("loa_id"), "agency_location_code"), "loa_id")
    # one row a tracking number and code: resolved there, not on the distributions
    loa_by_tracking = resolve_sk(loa_by_tracking, gold["common.dim_loa"], "loa_id", "loa_sk").drop("loa_id")
    hdr = live(silver["aasbs_transmit_accrual_income_header"]).filter(F.col("accrual_income_dist_id").isNotNull())
    lines = live(silver["aasbs_transmit_accrual_income_acct_line"]).groupBy(
        F.col("accrual_income_header_id").alias("id")).agg(
        F.sum(F.coalesce("transaction_currency_amt", zero)).alias("_line_amt"))
    hdr = hdr.join(lines, "id")
    latest = F.struct("created_dt", "id")
    f = preagg_join(dist, hdr, "dist_id", right_on="accrual_income_dist_id", aggs=[
        F.sum("_line_amt").alias("baar_transmitted_amt"),
        F.max_by("transmittal_status_cd", latest).alias("_tx_status"),
        F.max_by("document_type", latest).alias("_tx_doc_type")]).drop("dist_id")
    m = live(silver["aasbs_map_aac_onefund"])
    active_first = F.when(F.upper(F.coalesce("active_yn", F.lit("N"))) == "Y", 0).otherwise(1)
    m = keep_one(m, ["activity_address_cd"], [active_first, F.col("created_dt").asc_nulls_last(),
                                              F.col("onefund_program_cd").asc_nulls_last()])
    dt = live(silver["aasbs_map_onefund_program_accrual_income_doc_type"]).filter(
        F.upper(F.coalesce("active_yn", F.lit("Y"))) == "Y")
    dt = pick_one(dt, "onefund_program_cd", "accrual_income_doc_type_cd", how="min")
    doc = m.join(dt, "onefund_program_cd", "left").select(F.col("activity_address_cd").alias("agency_location_code"),
                                                           F.col("accrual_income_doc_type_cd").alias("_map_doc_type"))
    loa_by_tracking = loa_by_tracking.join(doc, "agency_location_code", "left")
    loa_by_tracking = resolve_sk(loa_by_tracking, gold["common.dim_agency"], {"agency_location_code": "activity_address_cd"}, "agency_sk")
    loa_by_tracking = resolve_sk(loa_by_tracking, gold["air.dim_onefund_program"], {"agency_location_code": "aac"}, "onefund_sk", missing=None)
    # stored: one short row a LOA, broadcast by its size where there are few
    f = f.join(stored(loa_by_tracking.drop("agency_location_code")), "tracking_num", "left").drop("tracking_num")
    f = f.withColumns({c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("loa_sk", "agency_sk")})
    f = stored(f).join(inc, "accrual_income_id")
    f = f.withColumn("holdback_amt", F.round(
        F.col("_gap") * F.coalesce(F.col("proration_pct"), F.lit(0).cast("decimal(7,4)")), 2).cast("decimal(15,2)"))
    dist_amt = F.coalesce("distribute_amt", zero)
    return f.select(
        "line_item_sk", "loa_sk", "ia_sk", "agency_sk", "accrual_period_sk", "onefund_sk", "accrual_income_id",
        "accrual_batch_id", F.coalesce("accrual_income_amt", zero).cast("decimal(15,2)").alias("calculated_income_amt"),
        dist_amt.cast("decimal(15,2)").alias("distributed_income_amt"), "holdback_amt",
        F.round(dist_amt - F.coalesce("holdback_amt", zero), 2).cast("decimal(15,2)").alias("net_accrued_amt"),
        F.coalesce("baar_transmitted_amt", zero).cast("decimal(15,2)").alias("baar_transmitted_amt"),
        F.lit(None).cast("decimal(15,2)").alias("baar_accepted_amt"),
        F.lit(None).cast("decimal(15,2)").alias("baar_rejected_amt"),
        F.coalesce("_tx_status", "accrual_transmission_status_cd").alias("baar_transmission_status_cd"),
        F.lit(None).cast("timestamp_ntz").alias("baar_response_dt"),
        (F.upper(F.coalesce("include_in_transmission_yn", F.lit("N"))) == "Y").alias("inclusion_override_flag"),
        F.col("accrual_income_calc_comment").alias("inclusion_override_reason"),
        F.coalesce("_tx_doc_type", "_map_doc_type").alias("accrual_doc_type_cd"))


def distribution_recon(fact: DataFrame) -> DataFrame:
    """Income records whose distributions miss the calculated amount by more
    than 0.01 (CHK-7): group + having, one pass over the fact."""
    per = fact.groupBy("accrual_income_id").agg(F.sum("distributed_income_amt").alias("sum_distributed"),
                                                F.max("calculated_income_amt").alias("calculated_income"))
    return per.filter(F.abs(F.col("sum_distributed") - F.col("calculated_income")) > F.lit(RECON_TOLERANCE))


