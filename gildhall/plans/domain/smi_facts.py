"""Solicitation response fact (smi): one row per vendor response.

The contractor is found on two paths, first hit wins (JON-18): the company's
industry partner → its first company record → contractor, else the
response's DUNS → contractor. Each path is made unique per key before the
join (the DUNS path can match several contractor rows). Every dimension is
resolved against its current version (fix for D-24), awards are reduced to
one per response, and the IA comes through the award→IA bridge (JON-6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import date_sk, yn_flag
from gildhall.operators import pick_one, resolve_sk
from gildhall.session import stored
from gildhall.sources import live


def fact_solicitation_response(silver, gold, as_of: str) -> DataFrame:
    sr = live(silver["aasbs_solicit_response"])
    # what the solicitation, the award and the company decide is joined on their own rows: responses without one
    # (most have no award) would be dealt to one task by each key they lack
    acq = live(silver["aasbs_acquisition"]).select(F.col("id").alias("acquisition_id"),
                                                   F.col("activity_address_cd").alias("_acq_aac"))
    sol = live(silver["aasbs_solicit"]).select(F.col("id").alias("solicit_id"), "acquisition_id")
    sol = resolve_sk(sol, gold["alt.dim_acquisition"], "acquisition_id", "acquisition_sk").join(acq, "acquisition_id", "left")
    sol = resolve_sk(sol, gold["common.dim_agency"], {"_acq_aac": "activity_address_cd"}, "agency_sk").drop("acquisition_id", "_acq_aac")
    # awards of the response: one (smallest id) per response
    aw = live(silver["aasbs_award"]).filter(F.col("solicit_response_id").isNotNull())
    award = pick_one(aw, "solicit_response_id", "id", how="min", out="award_id") \
        .join(aw.select(F.col("id").alias("award_id"), "latest_award_mod_id"), "award_id")
    bridge = pick_one(live(silver["aasbs_award_ia"]), "award_id", "ia_id", how="min")
    award = award.join(bridge, "award_id", "left")
    award = resolve_sk(award, gold["smi.dim_piid"], {"award_id": "piid_id"}, "piid_sk", missing=None).drop("award_id")
    snaps = silver["aasbs_snap_award_mod_amts"].groupBy(F.col("award_mod_id").alias("latest_award_mod_id")).agg(
        F.max("cum_funded_amt").alias("_cum_funded"))
    mods = live(silver["aasbs_award_mod"]).select(F.col("id").alias("latest_award_mod_id"),
                                                  F.col("co_signature_dt").alias("_award_signed"))
    award = award.join(snaps, "latest_award_mod_id", "left").join(mods, "latest_award_mod_id", "left").drop("latest_award_mod_id")
    award = resolve_sk(award, gold["common.dim_ia"], "ia_id", "ia_sk").drop("ia_id")
    f = sr.join(award.withColumnRenamed("solicit_response_id", "id"), "id", "left")
    # contractor: partner path first, then DUNS path (first hit)
    contractors = gold["alt.dim_contractor"].filter(F.col("is_current_flag"))
    by_amc = contractors.select(F.col("award_mod_company_id").alias("_amc_id"),
                                F.col("contractor_sk").alias("_c1"), F.col("small_business_flag").alias("_sb1"))
    first_amc = pick_one(live(silver["aasbs_award_mod_company"]).filter(F.col("ipartner_id").isNotNull()),
                         "ipartner_id", "id", how="min", out="_amc_id")
    # stored: planned by its size, so that few partners are broadcast and their companies not dealt to one task a partner
    partners = stored(first_amc.join(by_amc, "_amc_id", "left").drop("_amc_id"))
    sc = live(silver["aasbs_solicit_company"]).select(F.col("id").alias("solicit_company_id"), "ipartner_id")
    f = f.join(sc.join(partners, "ipartner_id", "left").drop("ipartner_id"), "solicit_company_id", "left")
    by_duns = contractors.filter(F.col("duns_num").isNotNull()).groupBy(
        F.col("duns_num").alias("response_company_duns")).agg(
        F.min("contractor_sk").alias("_c2"), F.min_by("small_business_flag", "contractor_sk").alias("_sb2"))
    f = f.join(by_duns, "response_company_duns", "left")
    f = f.join(sol, "solicit_id", "left")
    f = resolve_sk(f, gold["alt.dim_solicitation"], "solicit_id", "solicitation_sk")
    f = resolve_sk(f, gold["smi.dim_posting_type"], "solicit_id", "posting_type_sk")
    f = f.withColumns({c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("acquisition_sk", "agency_sk", "ia_sk")})
    win = yn_flag("winning_response_yn", default="N")
    status = F.when(win, "AWARDED").when(yn_flag("no_response_yn", default="N"), "NO_RESPONSE").otherwise("SUBMITTED")
    return f.select(
        "solicitation_sk", "acquisition_sk", F.coalesce("_c1", "_c2", F.lit(-1)).cast("bigint").alias("contractor_sk"),
        "posting_type_sk", "piid_sk", "agency_sk", "ia_sk",
        date_sk("latest_response_update_dt").alias("response_date_sk"), date_sk("_award_signed").alias("award_date_sk"),
        F.col("id").alias("source_response_id"), status.alias("response_status_cd"), win.alias("is_winner_flag"),
        F.coalesce("_sb1", "_sb2", F.lit(False)).alias("is_small_business_flag"),
        F.lit(None).cast("decimal(15,2)").alias("bid_total_amt"), F.lit(None).cast("int").alias("bid_clin_count"),
        F.when(win, F.coalesce("_cum_funded", F.lit(0))).cast("decimal(15,2)").alias("award_total_amt"),
        F.lit(None).cast("decimal(15,2)").alias("bid_vs_award_variance"), F.lit(None).cast("int").alias("competition_rank"))
