"""Transmission & payment (tpp) and accrual (air) dimensions.

Corrections: an AAC is suspended when any suspension of its transmittal
type is open-ended or still running at ``as_of`` (``bool_or``) — ``MAX`` of
the end date ignores an open-ended suspension beside an ended one (fix for
D-19). Every lookup that may repeat per key (program → document type) is
reduced to one row per key before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.operators import assign_sk, decode, keep_one, preagg_join
from gildhall.sources import live


def dim_transmittal_type(silver, gold, as_of: str) -> DataFrame:
    t = live(silver["aasbs_transmit_lu_transmittal_type"]).select(
        F.col("cd").alias("transmittal_type_cd"), F.col("description").alias("transmittal_type_desc"),
        F.col("flatfile_cd").alias("flat_file_code"))
    sv = live(silver["aasbs_transmit_transmittal_spec_version"])
    t = preagg_join(t, sv, "transmittal_type_cd", [F.max("specification_version").alias("spec_version")])
    out = t.select("transmittal_type_cd", "transmittal_type_desc", "flat_file_code", "spec_version",
                   *[F.lit(None).cast("string").alias(c) for c in ("envelope_format", "poc_name", "poc_email")])
    return assign_sk(out, ["transmittal_type_cd"], name="transmittal_type_sk")


def dim_aac_envelope(silver, gold, as_of: str) -> DataFrame:
    ae = keep_one(live(silver["aasbs_transmit_aac_envelope"]), ["activity_address_cd"],
                  [F.col("created_dt").desc_nulls_last(), F.col("id").desc()])
    poc = live(silver["aasbs_transmit_transmittal_poc"]).select(
        F.col("id").alias("transmittal_poc_id"), "poc_name", "poc_email")
    ae = ae.join(poc, "transmittal_poc_id", "left")
    bs = live(silver["aasbs_transmit_billing_summary"]).filter(F.col("activity_address_cd").isNotNull())
    ae = preagg_join(ae, bs, "activity_address_cd", [F.max("generated_dt").alias("last_transmission_dt")])
    now = F.lit(as_of).cast("timestamp_ntz")
    susp = live(silver["aasbs_transmit_transmittal_suspension"])
    active = F.col("suspend_end_dt").isNull() | (F.col("suspend_end_dt") >= now)
    ae = preagg_join(ae, susp, "transmittal_type_cd", [
        F.max("suspend_start_dt").alias("suspension_start_dt"),
        F.when(F.bool_or(F.col("suspend_end_dt").isNull()), F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.max("suspend_end_dt")).alias("suspension_end_dt"),
        F.bool_or(active).alias("is_suspended_flag")])
    out = ae.select(F.col("activity_address_cd").alias("aac"), F.col("transmittal_status_cd").alias("envelope_status_cd"),
                    "poc_name", "poc_email", "last_transmission_dt",
                    F.coalesce("is_suspended_flag", F.lit(False)).alias("is_suspended_flag"),
                    "suspension_start_dt", "suspension_end_dt")
    return assign_sk(out, ["aac"], name="aac_envelope_sk")


def dim_agreement(silver, gold, as_of: str) -> DataFrame:
    a = live(silver["agreement_agreement"])
    lines = live(silver["agreement_agreement_line"])
    a = preagg_join(a, lines, "agreement_id", [F.count(F.lit(1)).alias("line_count")], fill={"line_count": 0})
    log = live(silver["agreement_agreement_log"]).filter(
        F.upper(F.coalesce("transmission_status", F.lit(""))).like("%ACCEPT%") & F.col("response_date").isNotNull())
    a = preagg_join(a, log, "agreement_id", [F.max("response_date").alias("last_transmitted_dt")])
    out = a.select("agreement_id", F.col("agreement_num").alias("agreement_number"),
                   F.col("funding_status").alias("fund_status_cd"),
                   F.lit(None).cast("decimal(15,2)").alias("obligations_available"),
                   F.col("acct_period").alias("accounting_period"),
                   F.col("maximum_agreement_amt").alias("total_agreement_amt"), "line_count", "last_transmitted_dt")
    return assign_sk(out, ["agreement_id"], name="agreement_sk")


def dim_receiving_report(silver, gold, as_of: str) -> DataFrame:
    rr = live(silver["aasbs_transmit_rr_summary"])
    det = live(silver["aasbs_transmit_rr_detail"])
    rr = preagg_join(rr, det, "id", right_on="rr_summary_id",
                     aggs=[F.sum(F.coalesce("total_mdl_amount", F.lit(0))).alias("mdl_amt")])
    out = rr.select(F.col("id").alias("rr_summary_id"), F.col("pegasys_invoice_number").alias("pegasys_invoice_num"),
                    F.col("accepted_dt").alias("rr_acceptance_dt"), F.col("max_approved_amt").alias("total_rr_amt"),
                    F.col("number_of_detail_lines").alias("rr_line_count"),
                    F.coalesce("mdl_amt", F.lit(0)).cast("decimal(15,2)").alias("mdl_amt"))
    return assign_sk(out, ["rr_summary_id"], name="receiving_report_sk",
                     keys=live(silver["aasbs_transmit_rr_summary"]).select(F.col("id").alias("rr_summary_id")))


def dim_onefund_program(silver, gold, as_of: str) -> DataFrame:
    """One mapping per AAC: active first, then the oldest (WIN-2)."""
    m = live(silver["aasbs_map_aac_onefund"])
    active_first = F.when(F.upper(F.coalesce("active_yn", F.lit("N"))) == "Y", 0).otherwise(1)
    m = keep_one(m, ["activity_address_cd"], [active_first, F.col("created_dt").asc_nulls_last(),
                                              F.col("onefund_program_cd").asc_nulls_last()])
    dt = live(silver["aasbs_map_onefund_program_accrual_income_doc_type"]).filter(
        F.upper(F.coalesce("active_yn", F.lit("Y"))) == "Y")
    dt = keep_one(dt, ["onefund_program_cd"], [F.col("accrual_income_doc_type_cd").asc_nulls_last()]) \
        .select("onefund_program_cd", F.col("accrual_income_doc_type_cd").alias("baar_doc_type_cd"))
    j = m.join(dt, "onefund_program_cd", "left")
    for code, lk, out_col in [("onefund_program_cd", "aasbs_lu_onefund_program", "program_desc"),
                              ("onefund_activity_cd", "aasbs_lu_onefund_activity", "activity_desc"),
                              ("baar_doc_type_cd", "aasbs_lu_accrual_income_doc_type", "baar_doc_type_desc")]:
        j = decode(j, live(silver[lk]).select("cd", "description"), code, "description", out=out_col,
                   lookup_code="cd", keep_code=False)
    out = j.select(F.col("activity_address_cd").alias("aac"), F.col("fund_cd").alias("onefund_fund_cd"),
                   "onefund_activity_cd", "onefund_program_cd", "object_class_cd", "baar_doc_type_cd",
                   "baar_doc_type_desc", "program_desc", "activity_desc")
    return assign_sk(out, ["aac"], name="onefund_sk")
