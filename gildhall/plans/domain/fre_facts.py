"""FPDS transaction fact (fre): one row per award modification.

The ledger is aggregated to the modification before the join (JON-7);
the PSC is the one of the modification's first line by line number, then
accepted-line id (WIN-4); contractor, small-business flag, acquisition plan
and amount snapshot are each reduced to one row per key before the join,
where the reference fans out on several companies per modification or
several plans per acquisition. The offer count is responses per
solicitation, aggregated first. Action type: base award, termination or
change, from fixed codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import date_sk
from gildhall.operators import keep_one, pick_one, preagg_join, resolve_sk
from gildhall.sources import live

# Modification numbers of the base award; FPDS reason code of a termination.
BASE_MOD_NUMS = ["0", "00", "A", "A0"]
TERMINATION_REASON = "D"
TERMINATION_PATTERN = "%TERM%"


def fact_fpds_transaction(silver, gold, as_of: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    am = live(silver["aasbs_award_mod"])
    aw = live(silver["aasbs_award"]).select(F.col("id").alias("award_id"), "acquisition_id", "solicit_id",
                                            "lead_svc_activity_address_cd")
    lia = live(silver["aasbs_line_item_accepted"]).select(F.col("id").alias("lia_id"), "award_mod_id", "line_item_id")
    ll = live(silver["aasbs_loa_ledger"]).select(F.col("line_item_accepted_id").alias("lia_id"), "loa_id", "ia_id",
                                                 "line_item_obligated_amt")
    loa = live(silver["aasbs_loa"]).select(F.col("id").alias("loa_id"), "tracking_num", "agency_location_code")
    ledger = ll.join(lia, "lia_id").join(loa, "loa_id")
    # each lookup is resolved on the rows that have its key, so modifications without one are not dealt to one task
    per_mod = ledger.groupBy(F.col("award_mod_id").alias("id")).agg(
        F.sum(F.coalesce("line_item_obligated_amt", zero)).alias("action_obligation_amt"),
        F.min("tracking_num").alias("po_tracking_num"), F.min("loa_id").alias("first_loa_id"),
        F.min("agency_location_code").alias("funding_aac"), F.min("ia_id").alias("ia_id"))
    per_mod = resolve_sk(per_mod, gold["common.dim_ia"], "ia_id", "ia_sk").drop("ia_id")
    per_mod = resolve_sk(per_mod, gold["common.dim_loa"], {"first_loa_id": "loa_id"}, "loa_sk", missing=None).drop("first_loa_id")
    f = am.join(per_mod, "id", "left")
    li = live(silver["aasbs_line_item"]).select(F.col("id").alias("line_item_id"), "line_item_num", "li_deliverable_id")
    first_line = keep_one(lia.join(li, "line_item_id"), ["award_mod_id"],
                          [F.col("line_item_num").asc_nulls_last(), F.col("lia_id").asc()])
    deliv = live(silver["aasbs_li_deliverable"]).select(F.col("id").alias("li_deliverable_id"), "psc_cd")
    psc = first_line.join(deliv, "li_deliverable_id", "left").select(F.col("award_mod_id").alias("id"), "psc_cd")
    f = f.join(psc, "id", "left")
    companies = live(silver["aasbs_award_mod_company"])
    first_co = pick_one(companies, "award_mod_id", "id", how="min", out="_company_id").withColumnRenamed("award_mod_id", "id")
    first_co = resolve_sk(first_co, gold["fre.dim_fpds_contractor"], {"_company_id": "award_mod_company_id"}, "fpds_contractor_sk")
    sb = gold["alt.dim_contractor"].filter(F.col("is_current_flag")).select(
        F.col("award_mod_company_id").alias("_company_id"), F.col("small_business_flag").alias("_sb"))
    f = f.join(first_co.join(sb, "_company_id", "left").drop("_company_id"), "id", "left")
    plan = keep_one(live(silver["aasbs_acquisition_plan"]), ["acquisition_id"],
                    [F.col("created_dt").desc_nulls_last(), F.col("competition_type_cd").asc_nulls_last()]) \
        .select("acquisition_id", "competition_type_cd")
    snaps = silver["aasbs_snap_award_mod_amts"]
    if "is_deleted" in snaps.columns:
        snaps = live(snaps)
    f = preagg_join(f, snaps, "id", right_on="award_mod_id", aggs=[
        F.max("base_exc_opt_amt").alias("_exc"), F.max("base_all_opt_amt").alias("_all"),
        F.max("cum_funded_amt").alias("_cum"), F.max("cost_to_client_total_amt").alias("_ctc")])
    resp = live(silver["aasbs_solicit_response"])
    solicited = aw.filter(F.col("solicit_id").isNotNull()).select("award_id", "solicit_id")
    offers = preagg_join(solicited, resp, "solicit_id", [F.count(F.lit(1)).alias("_offers")]).drop("solicit_id")
    aw = aw.join(plan, "acquisition_id", "left").drop("acquisition_id")
    f = f.join(aw, "award_id", "left").join(offers, "award_id", "left")
    f = resolve_sk(f, gold["fre.dim_fpds_award"], "award_id", "fpds_award_sk", current_flag=None)
    f = resolve_sk(f, gold["fre.dim_fpds_agency"], {"lead_svc_activity_address_cd": "aac"}, "fpds_agency_sk",
                   current_flag=None)
    f = resolve_sk(f, gold["fre.dim_fpds_agency"], {"funding_aac": "aac"}, "fpds_agency_sk", out="funding_agency_sk",
                   current_flag=None)
    f = resolve_sk(f, gold["fre.dim_fpds_psc"], "psc_cd", "psc_sk", missing=None, current_flag=None)
    f = resolve_sk(f, gold["common.dim_award"], "award_id", "award_sk")
    f = f.withColumns({c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("ia_sk", "fpds_contractor_sk")})
    mod_type = F.upper(F.coalesce("m1p_sf30_mod_type_cd", F.lit("")))
    action = (F.when(F.upper(F.coalesce("mod_num", F.lit(""))).isin(BASE_MOD_NUMS), "A")
               .when(mod_type.like(TERMINATION_PATTERN)
                     | (F.upper(F.coalesce("m1p_award_mod_fpds_reason_cd", F.lit(""))) == TERMINATION_REASON), "D")
               .otherwise("C"))
    return f.select(
        "fpds_award_sk", "fpds_contractor_sk", "fpds_agency_sk", "funding_agency_sk", "psc_sk", "award_sk", "ia_sk",
        "loa_sk", date_sk("co_signature_dt").alias("action_date_sk"), F.col("id").alias("award_mod_id"), "mod_num",
        F.col("m1p_sf30_mod_type_cd").alias("sf30_mod_type_cd"), F.col("m1p_award_mod_fpds_reason_cd").alias("fpds_reason_cd"),
        action.alias("action_type_cd"), F.col("fpds_car_status_cd").alias("car_status_cd"),
        F.col("co_signature_dt").alias("car_submitted_dt"), F.lit(None).cast("timestamp_ntz").alias("car_accepted_dt"),
        "po_tracking_num",
        F.coalesce("action_obligation_amt", zero).cast("decimal(15,2)").alias("action_obligation_amt"),
        *[F.coalesce(c, zero).cast("decimal(15,2)").alias(o) for c, o in [
            ("_exc", "base_exercised_opts_amt"), ("_all", "base_all_opts_amt"), ("_cum", "current_total_value_amt"),
            ("_ctc", "ultimate_contract_value")]],
        F.coalesce("_sb", F.lit(False)).alias("is_small_business_flag"), "competition_type_cd",
        F.lit(None).cast("string").alias("reason_not_competed_cd"),
        F.when(F.col("solicit_id").isNotNull(), F.coalesce("_offers", F.lit(0))).cast("bigint").alias("number_of_offers"))
