"""IA tracker (iat) and solicitation (smi) dimensions.

dim_reviewer          distinct reviewer ids (AGG-9) joined to users on a
                      cast-to-text key (JON-16), cast once
dim_fin_code_history  every FIN log row, flagged current when it is the
                      latest of its FIN (WIN-9 as group-by + join back);
                      this target has no DDL in the reference (D-15), the
                      columns here are its contract
dim_posting_type      posting type from which source matched (PRJ-10):
                      direct postings and connect postings are each reduced
                      to one row per solicitation before the join (JON-7)
dim_piid              positional parse of the contract number with a length
                      guard (FN-17)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import full_name
from gildhall.operators import assign_sk, latest_flag, preagg_join
from gildhall.sources import live

# Posting types (code, description) in precedence order.
POSTING_DIRECT_CONNECT = ("DIRECT_CONNECT", "Direct Connect (external source)")
POSTING_DIRECT = ("DIRECT", "Direct Award (sole-source / J&A)")
POSTING_OPEN = ("OPEN", "Open Competitive Solicitation")
POSTING_INFORMAL = ("INFORMAL", "Informal / No Formal Posting")

# Contract number layout — minimum length, then (start, length)
# of the address code, fiscal year (2 digits, + 2000), instrument type and sequence.
PIID_MIN_LEN = 13
PIID_AAC = (1, 6)
PIID_FY = (7, 2)
PIID_TYPE = (9, 1)
PIID_SEQ = (10, 4)


def dim_reviewer(silver, gold, as_of: str) -> DataFrame:
    rev = live(silver["aasbs_ia_review"]).filter(F.col("service_agency_reviewer_id").isNotNull()) \
        .select(F.col("service_agency_reviewer_id").cast("string").alias("reviewer_user_id")).distinct()
    users = live(silver["assist_users"]).select(
        F.col("id").cast("string").alias("reviewer_user_id"), F.col("id").alias("_uid"), "first_name",
        "middle_initial", "last_name", "reg_status", "inactive_date")
    j = rev.join(users.dropDuplicates(["reviewer_user_id"]), "reviewer_user_id", "left")
    active = (F.when((F.col("reg_status") == "ACTIVE") & F.col("inactive_date").isNull(), True)
               .when(F.col("_uid").isNull(), F.lit(None).cast("boolean")).otherwise(False))
    out = j.select(
        "reviewer_user_id",
        F.when(F.col("first_name").isNotNull(), full_name("first_name", "middle_initial", "last_name"))
         .alias("reviewer_name"),
        F.lit(None).cast("string").alias("reviewer_role_cd"), F.lit(None).cast("string").alias("reviewer_org"),
        active.alias("is_active_flag"))
    return assign_sk(out, ["reviewer_user_id"], name="reviewer_sk")


def dim_fin_code_history(silver, gold, as_of: str) -> DataFrame:
    log = live(silver["aasbs_award_fin_log"])
    flagged = latest_flag(log, ["fin"], "id", out="is_current_flag")
    out = flagged.select(
        F.col("id").alias("fin_log_id"), F.lit(-1).cast("bigint").alias("award_sk"),
        F.lit(-1).cast("bigint").alias("ia_sk"), F.col("fin").alias("fin_cd"), "fin_base_10",
        F.col("created_dt").alias("effective_dt"), F.lit(None).cast("timestamp_ntz").alias("superseded_dt"),
        "is_current_flag", "created_by_user_id")
    return assign_sk(out, ["fin_log_id"], name="fin_code_history_sk")


def dim_posting_type(silver, gold, as_of: str) -> DataFrame:
    amend = live(silver["aasbs_solicit_amendment"]).select(F.col("id").alias("solicit_amendment_id"), "solicit_id")
    direct = live(silver["aasbs_solicit_posting_direct"]).join(amend, "solicit_amendment_id")
    connect = live(silver["aasbs_solicit_posting_connect"]).join(amend, "solicit_amendment_id")
    s = live(silver["aasbs_solicit"]).select(F.col("id").alias("solicit_id"))
    s = preagg_join(s, direct, "solicit_id", [
        F.min("id").alias("posting_direct_id"), F.min("reason_for_direct_cd").alias("ja_reason_cd"),
        F.min("external_source_ref").alias("external_source_ref"), F.min("open_dt").alias("_direct_open")])
    s = preagg_join(s, connect, "solicit_id", [
        F.min("id").alias("posting_connect_id"), F.min("pm_responsible_user_id").alias("pm_responsible_user_id"),
        F.min("open_dt").alias("_connect_open")])
    d, c, ext = F.col("posting_direct_id").isNotNull(), F.col("posting_connect_id").isNotNull(), \
        F.col("external_source_ref").isNotNull()

    def pick(i):
        return (F.when(d & ext, POSTING_DIRECT_CONNECT[i]).when(d, POSTING_DIRECT[i]).when(c, POSTING_OPEN[i])
                 .otherwise(POSTING_INFORMAL[i]))
    out = s.select("solicit_id", pick(0).alias("posting_type_cd"), pick(1).alias("posting_type_desc"),
                   F.coalesce("_direct_open", "_connect_open").alias("open_dt"), "pm_responsible_user_id",
                   "ja_reason_cd", "external_source_ref")
    return assign_sk(out, ["solicit_id"], name="posting_type_sk")


def dim_piid(silver, gold, as_of: str) -> DataFrame:
    aw = live(silver["aasbs_award"]).filter(F.col("award_piid").isNotNull())
    mods = live(silver["aasbs_award_mod"]).select(F.col("id").alias("latest_award_mod_id"), "award_piid_ext")
    aw = aw.join(mods, "latest_award_mod_id", "left")
    p = F.trim("award_piid")
    ok = F.length(p) >= PIID_MIN_LEN

    def part(span):
        return F.when(ok, F.substring(p, span[0], span[1]))
    fy_txt = F.substring(p, PIID_FY[0], PIID_FY[1])
    out = aw.select(
        F.col("id").alias("piid_id"), F.col("award_piid").alias("piid_value"), F.col("award_piid").alias("base_piid"),
        F.col("award_piid_ext").alias("piid_ext"), part(PIID_AAC).alias("aac"),
        part(PIID_TYPE).alias("instrument_type_cd"), part(PIID_SEQ).alias("sequence_num"),
        F.when(ok & fy_txt.rlike("^[0-9]{2}$"), fy_txt.cast("int") + 2000).alias("piid_fiscal_year"))
    return assign_sk(out, ["piid_id"], name="piid_sk")
