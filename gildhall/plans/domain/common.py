"""Common conformed dimensions (date, agency, IA, LOA, award, funding, line item).

Corrections against the reference (SURVEY §2.15):
  D-7  the award's IA comes from the award→IA bridge (minimum IA per award),
       not from a join on ``is_current_flag`` alone (a cross product);
  D-16 one bureau per agency (first by update date, then code), so an
       address code has exactly one current row;
  LOA  the 2-character agency lookup is made unique before the prefix join
       (one agency per code), so a LOA never fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import compose_code, yn_flag
from gildhall.operators import (
    assign_sk, decode, keep_one, pick_one, prefix_join, resolve_sk, scd2_initial, valid_rows,
)
from gildhall.plans.domain.steps import step
from gildhall.sources import date_spine, live

# Instrument type codes grouped into IA types, with their descriptions.
GT_AND_C_CODES = ["GTC", "GT", "GTAC", "GT_AND_C"]
ORDER_CODES = ["IAA", "MIPR", "ECONOMY_ACT", "MOU", "IOA", "BOA", "CROSS_SERVICING"]
IA_TYPE_GT_AND_C = ("GT_AND_C", "Government-wide Task and Delivery Order Contract")
IA_TYPE_ORDER = ("ORDER", "Interagency Order")
IA_TYPE_INTRA = ("INTRA_AGENCY", "Intra-Agency Instrument")

# Modification numbers that mark the base award.
BASE_MOD_NUMS = ["0", "00", "A", "A0"]

# Federal agency types counted as OMB-tracked.
OMB_AGENCY_TYPES = ["EXEC", "LEGIS", "JUDIC"]


def _lookup(silver, name: str) -> DataFrame:
    return live(silver[name]).select("cd", "description")


def dim_date(silver, gold, as_of: str) -> DataFrame:
    return date_spine(next(iter(silver.values())).sparkSession)


def agency_rows(silver, gold, as_of: str) -> DataFrame:
    """One current row per activity address code (AAC)."""
    aac = live(silver["aasbs_lu_activity_address_code"]).select(
        F.col("cd").alias("activity_address_cd"), F.col("fpds_ng_agency_identifier").alias("agency_code_2"),
        F.col("description").alias("aac_description"))
    ag = live(silver["aasbs_lu_agency"])
    internal = pick_one(ag.filter(F.col("cd_2char").isNotNull()), "cd_2char", "cd", out="agency_cd_internal")
    names = ag.select(F.col("cd").alias("agency_cd_internal"), F.col("description").alias("agency_name"))
    bureau = keep_one(live(silver["aasbs_lu_bureau"]), ["agency_cd"], [F.col("updated_dt").asc_nulls_last(), "cd"]) \
        .select(F.col("agency_cd").alias("agency_cd_internal"), F.col("cd").alias("bureau_code"),
                F.col("description").alias("bureau_name"))
    fed = valid_rows(live(silver["table_master_lu_federal_agency"]), "inactive_date", as_of)
    fed = keep_one(fed, ["agency_code"], [F.col("agency_description").asc_nulls_last(), "agency_type"]).select(
        F.col("agency_code").alias("agency_code_2"), F.col("agency_code").alias("department_code"),
        F.col("agency_description").alias("department_name"), "agency_type")
    j = (aac.filter(F.col("activity_address_cd").isNotNull())
            .join(internal.withColumnRenamed("cd_2char", "agency_code_2"), "agency_code_2", "left")
            .join(names.dropDuplicates(["agency_cd_internal"]), "agency_cd_internal", "left")
            .join(bureau, "agency_cd_internal", "left")
            .join(fed, "agency_code_2", "left"))
    out = j.select(
        F.coalesce("agency_code_2", "department_code", F.lit("UNKNOWN")).alias("agency_code"),
        "bureau_code", "activity_address_cd",
        F.coalesce("agency_name", "department_name", F.lit("UNKNOWN")).alias("agency_name"),
        "bureau_name", "aac_description", "department_code", "department_name",
        F.lit(None).cast("string").alias("treasury_symbol"),
        F.coalesce(F.col("agency_type").isin(OMB_AGENCY_TYPES), F.lit(False)).alias("is_omb_agency_flag"),
        F.lit(False).alias("is_intel_community"))
    out = keep_one(out, ["activity_address_cd"], ["agency_code", "bureau_code"])
    return out


def _ia_type(code_col) -> tuple:
    u = F.upper(F.coalesce(code_col, F.lit("")))
    cd = (F.when(u.isin(GT_AND_C_CODES), IA_TYPE_GT_AND_C[0]).when(u.isin(ORDER_CODES), IA_TYPE_ORDER[0])
           .when(code_col.isNotNull(), IA_TYPE_INTRA[0]))
    desc = (F.when(u.isin(GT_AND_C_CODES), IA_TYPE_GT_AND_C[1]).when(u.isin(ORDER_CODES), IA_TYPE_ORDER[1])
             .when(code_col.isNotNull(), IA_TYPE_INTRA[1]))
    return cd, desc


def ia_rows(silver, gold, as_of: str) -> DataFrame:
    ia = live(silver["aasbs_ia"]).select(
        F.col("id").alias("ia_id"), F.col("piid").alias("ia_num"), "instrument_type_cd", "ia_status_cd",
        "fiscal_year", F.col("ia_began_dt").alias("ia_start_dt"), F.col("activity_address_cd").alias("serv_aac"))
    ia = decode(ia, _lookup(silver, "aasbs_lu_ia_status"), "ia_status_cd", "description", out="ia_status_desc",
                lookup_code="cd")
    aac = live(silver["aasbs_lu_activity_address_code"]).select(F.col("cd").alias("serv_aac"), "program_cd", "region_cd")
    ia = ia.join(aac.dropDuplicates(["serv_aac"]), "serv_aac", "left")
    ia = resolve_sk(ia, gold["common.dim_agency"], {"serv_aac": "activity_address_cd"}, "agency_sk",
                    out="servicing_agency_sk")
    cd, desc = _ia_type(F.col("instrument_type_cd"))
    out = ia.select(
        "ia_id", "ia_num", cd.alias("ia_type_cd"), desc.alias("ia_type_desc"), "ia_status_cd", "ia_status_desc",
        "instrument_type_cd", F.coalesce("ia_status_desc", "instrument_type_cd").alias("instrument_type_desc"),
        "fiscal_year", "ia_start_dt", F.lit(None).cast("timestamp_ntz").alias("ia_end_dt"),
        F.lit(None).cast("decimal(15,2)").alias("total_direct_cost_est_amt"),
        F.lit(None).cast("decimal(15,2)").alias("total_charges_est_amt"),
        "servicing_agency_sk", F.lit(None).cast("bigint").alias("requesting_agency_sk"), "program_cd", "region_cd")
    return out


def loa_rows(silver, gold, as_of: str) -> DataFrame:
    loa = live(silver["aasbs_loa"])
    tas = compose_code("-", "tsym_alloc_trans_agency_cd", "requesting_agency_cd",
                       F.concat(F.coalesce("tsym_availability_type", F.lit("")), F.coalesce("appropriation", F.lit(""))),
                       "treasury_sub_account")
    base = loa.select(
        F.col("id").alias("loa_id"), "tracking_num", "loa_status_cd", "agreement_number",
        F.col("ginv_line_num").cast("string").alias("agreement_line_num"), tas.alias("treasury_account_symbol"),
        F.col("customer_fund").alias("fund_cd"), "fund_type_cd",
        F.col("customer_act_num").alias("org_code"), F.col("first_fy_available_year").alias("bbfy"),
        F.col("last_fy_available_year").alias("ebfy"), "agreement_end_dt", "transmitted_dt",
        F.col("requesting_agency_cd").alias("requesting_agency_cd_raw"))
    base = decode(base, _lookup(silver, "aasbs_lu_loa_status"), "loa_status_cd", "description",
                  out="loa_status_desc", lookup_code="cd")
    agency = gold["common.dim_agency"].filter(F.col("is_current_flag"))
    by_code = pick_one(agency, "agency_code", "agency_sk", how="min")
    base = prefix_join(base, by_code, "requesting_agency_cd_raw", 2, "agency_code", ["agency_sk"])
    out = base.select(
        "loa_id", "tracking_num", "loa_status_cd", "loa_status_desc", "agreement_number", "agreement_line_num",
        "treasury_account_symbol", "fund_cd", "fund_type_cd",
        *[F.lit(None).cast("string").alias(c) for c in ("object_class_cd", "program_activity_cd", "budget_activity_cd")],
        "org_code", F.lit(None).cast("string").alias("cost_center"), F.lit(None).cast("string").alias("project_code"),
        "bbfy", "ebfy", "agreement_end_dt", "transmitted_dt", "agency_sk")
    return out


def award_rows(silver, gold, as_of: str) -> DataFrame:
    mods = live(silver["aasbs_award_mod"])
    counts = mods.groupBy("award_id").agg(
        F.count(F.lit(1)).alias("total_mods_count"),
        F.min(F.when(F.col("mod_num").isin(BASE_MOD_NUMS), F.col("m1p_mod_start_dt"))).alias("base_award_dt"))
    aw = live(silver["aasbs_award"]).select(
        F.col("id").alias("award_id"), "award_piid", "award_status_cd", F.col("award_fin").alias("fin_code"),
        F.col("lead_svc_activity_address_cd").alias("aac"), "latest_award_mod_id")
    latest = mods.select(F.col("id").alias("latest_award_mod_id"), F.col("id").alias("award_mod_id"),
                         F.col("mod_num").alias("award_mod_num"), F.col("m1p_mod_start_dt").alias("award_start_dt"),
                         F.col("co_signature_dt").alias("last_mod_dt"))
    aw = aw.join(latest, "latest_award_mod_id", "left").join(counts, "award_id", "left")
    # D-7: award → IA through the bridge, one IA per award (the smallest id), then resolved
    bridge = pick_one(live(silver["aasbs_award_ia"]), "award_id", "ia_id", how="min")
    aw = aw.join(bridge, "award_id", "left")
    aw = resolve_sk(aw, gold["common.dim_ia"], "ia_id", "ia_sk")
    aw = resolve_sk(aw, gold["common.dim_agency"], {"aac": "activity_address_cd"}, "agency_sk")
    out = aw.select(
        "award_id", "award_piid", "award_mod_num", "award_mod_id", "fin_code", "award_status_cd",
        F.coalesce("award_status_cd", F.lit("UNKNOWN")).alias("award_status_desc"),
        F.lit(None).cast("string").alias("contract_type_cd"), F.lit(None).cast("string").alias("contract_type_desc"),
        F.lit(None).cast("string").alias("vehicle_type_cd"), F.lit(None).cast("string").alias("vehicle_type_desc"),
        "ia_sk", "agency_sk", "award_start_dt", F.lit(None).cast("timestamp_ntz").alias("award_end_dt"),
        "base_award_dt", "last_mod_dt", "total_mods_count")
    return out


def funding_rows(silver, gold, as_of: str) -> DataFrame:
    amend = live(silver["aasbs_funding_amendment"])
    amloa = live(silver["aasbs_funding_amendment_loa"])
    funded = amend.select(F.col("id").alias("funding_amendment_id"), "funding_id").join(amloa, "funding_amendment_id") \
        .groupBy("funding_id").agg(F.sum(F.coalesce("loa_change_amt", F.lit(0))).alias("total_funded_amt"))
    f = live(silver["aasbs_funding"]).select(
        F.col("id").alias("funding_id"), "ia_id", "fund_status_cd", "fund_category_cd", "billing_type_cd",
        F.col("latest_funding_amendment_id").alias("funding_amendment_id"))
    for code, lk, out in [("fund_status_cd", "aasbs_lu_fund_status", "fund_status_desc"),
                          ("fund_category_cd", "aasbs_lu_fund_category", "fund_category_desc"),
                          ("billing_type_cd", "aasbs_lu_billing_type", "billing_type_desc")]:
        f = decode(f, _lookup(silver, lk), code, "description", out=out, lookup_code="cd")
    ia = gold["common.dim_ia"]
    f = resolve_sk(f, ia, "ia_id", "ia_sk", carry={"servicing_agency_sk": "_serv_agency"})
    f = f.withColumn("agency_sk", F.coalesce("_serv_agency", F.lit(-1)).cast("bigint")).drop("_serv_agency")
    f = f.join(funded, "funding_id", "left")
    out = f.select(
        "funding_id", "funding_amendment_id", "fund_status_cd", "fund_status_desc", "fund_category_cd",
        "fund_category_desc", "billing_type_cd", "billing_type_desc",
        F.lit(None).cast("string").alias("fund_type_cd"), F.lit(None).cast("string").alias("fund_type_desc"),
        "ia_sk", "agency_sk", F.coalesce("total_funded_amt", F.lit(0)).cast("decimal(15,2)").alias("total_funded_amt"),
        F.lit(None).cast("int").alias("fiscal_year"))
    return out


def line_item_rows(silver, gold, as_of: str) -> DataFrame:
    lia = live(silver["aasbs_line_item_accepted"])
    # the latest accepted row (largest id) and its details in one aggregate
    latest = F.max(F.struct("id", "budget_fy", "exercise_this_yn")).alias("_latest")
    detail = lia.filter(F.col("id").isNotNull()).groupBy("line_item_id").agg(latest).select(
        "line_item_id", F.col("_latest.id").alias("line_item_accepted_id"), "_latest.budget_fy", "_latest.exercise_this_yn")
    li = live(silver["aasbs_line_item"])
    num = F.trim("line_item_num")
    core = li.select(
        F.col("id").alias("line_item_id"), "li_tracking_num", "line_item_type_cd", F.col("line_item_num").alias("clin_num"),
        F.when(F.length(num) > 4, F.expr("substring(trim(line_item_num), 5)")).alias("slin_num"),
        F.col("line_item_start_dt").alias("li_pop_start_dt"), F.col("line_item_end_dt").alias("li_pop_end_dt"),
        F.col("line_item_total_amt").alias("obligated_ceiling_amt"), F.col("line_item_fy").alias("li_fy"))
    core = core.join(detail, "line_item_id", "left")
    # what the line points at is followed on narrow rows, modification → award key on the modifications' own; the wide
    # rows move once to meet it
    refs = li.select(F.col("id").alias("line_item_id"), "parent_award_mod_id", "li_deliverable_id")
    mod_award = resolve_sk(live(silver["aasbs_award_mod"]).select(F.col("id").alias("parent_award_mod_id"), "award_id"),
                           gold["common.dim_award"], "award_id", "award_sk").drop("award_id")
    refs = refs.join(mod_award, "parent_award_mod_id", "left").drop("parent_award_mod_id")
    deliv = live(silver["aasbs_li_deliverable"]).select(
        F.col("id").alias("li_deliverable_id"), "psc_cd", "contract_type_cd", "severability_type_cd",
        "unit_of_measure_cd", "bona_fide_need_fy")
    # both are stored before they are dealt again: the shuffle files of one step end before the next
    refs = step(gold, refs.join(deliv, "li_deliverable_id", "left").drop("li_deliverable_id"))
    core = core.join(refs, "line_item_id", "left")
    core = core.withColumn("award_sk", F.coalesce("award_sk", F.lit(-1)).cast("bigint"))
    core = step(gold, decode(core, _lookup(silver, "aasbs_lu_line_item_type"), "line_item_type_cd", "description",
                             out="line_item_type_desc", lookup_code="cd"))
    out = core.select(
        "line_item_id", "line_item_accepted_id", "li_tracking_num", "award_sk", "clin_num", "slin_num",
        "line_item_type_cd", "line_item_type_desc", "psc_cd", "unit_of_measure_cd", "contract_type_cd",
        "severability_type_cd", "li_pop_start_dt", "li_pop_end_dt", "obligated_ceiling_amt",
        yn_flag("exercise_this_yn", default=None).alias("exercise_this_yn"), "bona_fide_need_fy",
        F.coalesce("budget_fy", "li_fy").alias("budget_fy"))
    return out




# natural key and surrogate key of every SCD2 dimension built from rows
DIM_KEYS = {
    "common.dim_agency": ("activity_address_cd", "agency_sk", agency_rows),
    "common.dim_ia": ("ia_id", "ia_sk", ia_rows),
    "common.dim_loa": ("loa_id", "loa_sk", loa_rows),
    "common.dim_award": ("award_id", "award_sk", award_rows),
    "common.dim_funding": ("funding_id", "funding_sk", funding_rows),
    "common.dim_line_item": ("line_item_id", "line_item_sk", line_item_rows),
}
# Silver table whose id is the natural key: the dimension's rows are dealt by its quantiles when they are numbered
KEY_SOURCES = {"common.dim_ia": "aasbs_ia", "common.dim_loa": "aasbs_loa", "common.dim_award": "aasbs_award",
               "common.dim_funding": "aasbs_funding", "common.dim_line_item": "aasbs_line_item"}


def _full_load(name: str):
    key, sk, rows = DIM_KEYS[name]

    def build(silver, gold, as_of: str) -> DataFrame:
        """Full load: rows, dense surrogate keys by natural key, all current (SCD-2f)."""
        keys = live(silver[KEY_SOURCES[name]]).select(F.col("id").alias(key)) if name in KEY_SOURCES else None
        return scd2_initial(assign_sk(rows(silver, gold, as_of), [key], name=sk, keys=keys), as_of)
    build.__name__ = name.split(".")[-1]
    return build


dim_agency = _full_load("common.dim_agency")
dim_ia = _full_load("common.dim_ia")
dim_loa = _full_load("common.dim_loa")
dim_award = _full_load("common.dim_award")
dim_funding = _full_load("common.dim_funding")
dim_line_item = _full_load("common.dim_line_item")
