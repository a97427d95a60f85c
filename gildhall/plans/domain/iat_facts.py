"""IA tracker facts: amendments and annual reviews.

fact_ia_amendment  one row per amendment; cost change and period extension
                   against the previous amendment of the same IA (WIN-7/8,
                   LAG as a rank equi-join — a hot IA is never one task);
                   status from which signatures exist (PRJ-9). Funding and
                   LOA are reduced to ONE row per IA before the join
                   (``pick_one``; fix for D-14: the reference's per-IA views
                   group by an extra key and fan the fact out).
fact_ia_review     one row per review, fiscal year of the review date (FN-1),
                   reviewer joined on a cast-once text key (JON-16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import date_sk, fiscal_year
from gildhall.operators import delta, pick_one, resolve_sk
from gildhall.sources import live


def _agency_per_ia(silver, gold) -> DataFrame:
    ia = live(silver["aasbs_ia"]).select(F.col("id").alias("ia_id"), "activity_address_cd", "serv_agency_cd")
    return resolve_sk(ia, gold["common.dim_agency"], "activity_address_cd", "agency_sk")


def fact_ia_amendment(silver, gold, as_of: str) -> DataFrame:
    am = live(silver["aasbs_ia_amendment"])
    zero = F.lit(0).cast("decimal(15,2)")
    am = am.withColumn("revised_total_cost_amt",
                       (F.coalesce("direct_cost_est_amt", zero) + F.coalesce("charges_est_amt", zero))
                       .cast("decimal(16,2)"))
    am = delta(am, ["ia_id"], [F.col("id").asc()], {"revised_total_cost_amt": "cost_change_amt"},
               {"end_dt": "pop_extension_days"})
    ia = _agency_per_ia(silver, gold)
    am = am.join(ia.select("ia_id", "serv_agency_cd", "agency_sk"), "ia_id", "left")
    # D-14: one funding per IA (smallest id), then the LOA rows of its latest amendment
    funding = live(silver["aasbs_funding"])
    per_ia = pick_one(funding, "ia_id", "id", how="min", out="funding_id")
    per_ia = per_ia.join(funding.select(F.col("id").alias("funding_id"), "latest_funding_amendment_id"), "funding_id")
    per_ia = resolve_sk(per_ia, gold["common.dim_funding"], "funding_id", "funding_sk")
    fal = live(silver["aasbs_funding_amendment_loa"]).withColumnRenamed("funding_amendment_id",
                                                                        "latest_funding_amendment_id")
    loas = per_ia.select("ia_id", "latest_funding_amendment_id").join(fal, "latest_funding_amendment_id")
    loa_per_ia = loas.groupBy("ia_id").agg(F.min("loa_id").alias("loa_id"),
                                           F.sum(F.coalesce("loa_change_amt", zero)).alias("loa_change_amt"))
    loa_per_ia = resolve_sk(loa_per_ia, gold["common.dim_loa"], "loa_id", "loa_sk")
    am = am.join(per_ia.select("ia_id", "funding_sk"), "ia_id", "left") \
        .join(loa_per_ia.select("ia_id", "loa_sk", "loa_change_amt"), "ia_id", "left")
    am = resolve_sk(am, gold["common.dim_ia"], "ia_id", "ia_sk")
    am = resolve_sk(am, gold["iat.dim_amend_action"], {"ia_amend_action_cd": "amend_action_cd"}, "amend_action_sk")
    svc, req = F.col("service_agency_signed_dt"), F.col("request_agency_signed_dt")
    status = F.when(svc.isNotNull() & req.isNotNull(), "FINAL").when(svc.isNotNull(), "PENDING_REQUEST") \
        .otherwise("DRAFT")
    return am.select(
        "ia_sk", F.lit(-1).cast("bigint").alias("award_sk"), "amend_action_sk",
        F.coalesce("funding_sk", F.lit(-1)).cast("bigint").alias("funding_sk"),
        F.coalesce("loa_sk", F.lit(-1)).cast("bigint").alias("loa_sk"),
        F.coalesce("agency_sk", F.lit(-1)).cast("bigint").alias("agency_sk"),
        date_sk(F.coalesce(svc, F.col("created_dt"))).alias("amend_date_sk"),
        F.col("id").alias("source_ia_amendment_id"), F.col("piid_ext").try_cast("int").alias("amendment_num"),
        status.alias("amendment_status_cd"), F.col("cost_change_amt").cast("decimal(15,2)").alias("cost_change_amt"),
        F.col("revised_total_cost_amt").cast("decimal(15,2)").alias("revised_total_cost_amt"),
        "pop_extension_days", F.col("end_dt").alias("revised_pop_end_dt"),
        F.col("serv_agency_cd").alias("servicing_aac_cd"), F.lit(None).cast("string").alias("mod_type_cds"),
        F.lit(None).cast("boolean").alias("validation_override_flag"),
        F.lit(None).cast("string").alias("validation_override_reason"),
        F.coalesce("loa_change_amt", zero).cast("decimal(15,2)").alias("loa_change_amt"))


def fact_ia_review(silver, gold, as_of: str) -> DataFrame:
    ir = live(silver["aasbs_ia_review"])
    ir = resolve_sk(ir, gold["common.dim_ia"], "ia_id", "ia_sk")
    ir = ir.withColumn("_reviewer_key", F.col("service_agency_reviewer_id").cast("string"))
    ir = resolve_sk(ir, gold["iat.dim_reviewer"], {"_reviewer_key": "reviewer_user_id"}, "reviewer_sk")
    ir = ir.join(_agency_per_ia(silver, gold).select("ia_id", "agency_sk"), "ia_id", "left")
    d = F.col("review_dt")
    return ir.select(
        "ia_sk", "reviewer_sk", F.coalesce("agency_sk", F.lit(-1)).cast("bigint").alias("agency_sk"),
        date_sk(d).alias("review_date_sk"), F.col("id").alias("source_ia_review_id"),
        fiscal_year(d).alias("review_fiscal_year"), F.lit(None).cast("string").alias("review_type_cd"),
        F.col("attach_hash_id").isNotNull().alias("has_attachment_flag"),
        F.lit(None).cast("boolean").alias("review_completed_flag"), F.lit(None).cast("int").alias("days_overdue"))
