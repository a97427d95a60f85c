"""Transmission & payment facts (tpp).

fact_transmission_event      one row per billing summary; the IA is found
    through a multi-hop path (agreement number → LOA → ledger, smallest IA
    per agreement, JON-5) aggregated to the agreement before the join;
    errors and confirmations are reduced to one row per summary first.
fact_payment_reconciliation  one row per invoice summary; the first CLIN
    (smallest accepted line), receiving report, purchase order and IA (award
    → IA bridge, smallest, JON-6) are each reduced to one row per key before
    the join (JON-7).
invoice_line_report          invoices spanning several lines, counted
    BEFORE any pick-one (CHK-17, fix for D-11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import date_sk
from gildhall.operators import pick_one, preagg_join, resolve_sk
from gildhall.session import stored
from gildhall.sources import live


def fact_transmission_event(silver, gold, as_of: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    bs = live(silver["aasbs_transmit_billing_summary"])
    tr = live(silver["aasbs_transmit_transmittal"]).select(
        F.col("id").alias("transmittal_id"), "transmittal_type_cd", F.col("sent_dt").alias("transmitted_dt"),
        F.col("release_count").alias("batch_record_count"))
    f = bs.join(tr, "transmittal_id", "left")
    # JON-5: agreement number → LOA → ledger → smallest IA, aggregated per agreement
    loa = live(silver["aasbs_loa"]).filter(F.col("agreement_number").isNotNull()) \
        .select(F.col("id").alias("loa_id"), F.col("agreement_number").alias("agreement_num"))
    ll = live(silver["aasbs_loa_ledger"]).filter(F.col("ia_id").isNotNull()).select("loa_id", "ia_id")
    # stored: a short list, broadcast by its size instead of dealing the summaries to one task an agreement
    ia_per_agreement = stored(pick_one(loa.join(ll, "loa_id"), "agreement_num", "ia_id", how="min"))
    f = f.join(ia_per_agreement, "agreement_num", "left")
    err = live(silver["aasbs_transmit_transmit_error"]).filter(
        F.upper(F.coalesce("source_table_name_cd", F.lit(""))).like("%BILLING%"))
    f = preagg_join(f, err, "id", right_on="source_record_id", aggs=[
        F.min("retry_cnt").alias("retry_count"), F.max("error_description").alias("error_description"),
        F.max("transmittal_type_cd").alias("error_code")])
    resp = live(silver["billing_billing_response_info"])
    f = preagg_join(f, resp, "billing_record_id", [
        F.bool_or(F.upper(F.coalesce("accepted_status", F.lit("N"))) == "Y").alias("_accepted")])
    agr = live(silver["agreement_agreement"]).select("agreement_id", F.col("agreement_num").alias("_agr_num"))
    agr = stored(pick_one(agr, "_agr_num", "agreement_id", how="min").withColumnRenamed("_agr_num", "agreement_num"))
    f = f.join(agr, "agreement_num", "left")
    f = resolve_sk(f, gold["tpp.dim_transmittal_type"], "transmittal_type_cd", "transmittal_type_sk")
    f = resolve_sk(f, gold["tpp.dim_aac_envelope"], {"activity_address_cd": "aac"}, "aac_envelope_sk")
    f = resolve_sk(f, gold["tpp.dim_agreement"], "agreement_id", "agreement_sk")
    f = resolve_sk(f, gold["common.dim_ia"], "ia_id", "ia_sk")
    f = resolve_sk(f, gold["common.dim_agency"], "activity_address_cd", "agency_sk")
    amt = F.coalesce("billing_amount", zero)
    confirmed = F.when(F.coalesce("_accepted", F.lit(False)), F.col("billing_amount"))
    return f.select(
        "transmittal_type_sk", "aac_envelope_sk", "agreement_sk", "ia_sk", "agency_sk",
        date_sk("generated_dt").alias("event_date_sk"), F.col("id").alias("source_billing_summary_id"),
        F.col("transmittal_status_cd").alias("transmittal_stage_cd"), "transmittal_status_cd", "transmitted_dt",
        F.lit(None).cast("timestamp_ntz").alias("confirmed_dt"), "error_code", "error_description",
        F.coalesce("retry_count", F.lit(0)).cast("int").alias("retry_count"),
        F.coalesce("batch_record_count", F.lit(0)).cast("int").alias("batch_record_count"),
        amt.cast("decimal(15,2)").alias("transmitted_amt"), confirmed.cast("decimal(15,2)").alias("confirmed_amt"),
        F.when(confirmed.isNotNull(), F.round(amt - confirmed, 2)).cast("decimal(15,2)").alias("variance_amt"))


def fact_payment_reconciliation(silver, gold, as_of: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    inv = live(silver["aasbs_transmit_inv_summary"])
    items = live(silver["aasbs_invoice_item"]).filter(F.col("cost_line_item_accepted_id").isNotNull())
    invoices = live(silver["aasbs_invoice"]).select(F.col("id").alias("invoice_id"))
    # reduced before the invoices are looked up: one row an invoice moves, not every item
    first_clin = pick_one(items, "invoice_id", "cost_line_item_accepted_id", how="min", out="primary_lia_id") \
        .join(invoices, "invoice_id", "left_semi")
    # keys are resolved on the rows that have them, so invoices without one are not dealt to one task
    first_clin = resolve_sk(first_clin, gold["common.dim_line_item"], {"primary_lia_id": "line_item_accepted_id"},
                            "line_item_sk").drop("primary_lia_id")
    rr = live(silver["aasbs_transmit_rr_summary"]).filter(F.col("invoice_id").isNotNull()).groupBy("invoice_id").agg(
        F.min("id").alias("rr_summary_id"), F.max("max_approved_amt").alias("rr_amt"))
    rr = resolve_sk(rr, gold["tpp.dim_receiving_report"], "rr_summary_id", "receiving_report_sk", out="rr_sk").drop("rr_summary_id")
    pos = live(silver["aasbs_transmit_po_summary"]).filter(F.col("purchase_order_number").isNotNull())
    pol = live(silver["aasbs_transmit_po_line"]).groupBy(F.col("po_summary_id").alias("id")).agg(
        F.sum(F.coalesce("total_line_amt", zero)).alias("_line_amt"))
    po = pos.join(pol, "id", "left").groupBy("purchase_order_number").agg(
        F.min("award_mod_id").alias("award_mod_id"), F.sum(F.coalesce("_line_amt", zero)).alias("po_amt"))
    mods = live(silver["aasbs_award_mod"]).select(F.col("id").alias("award_mod_id"), "award_id")
    bridge = pick_one(live(silver["aasbs_award_ia"]), "award_id", "ia_id", how="min")
    po = po.join(mods, "award_mod_id", "left").join(bridge, "award_id", "left")
    po = resolve_sk(po, gold["common.dim_ia"], "ia_id", "ia_sk")
    po = po.select("purchase_order_number", "po_amt", "ia_sk")
    ordered = F.col("purchase_order_number").isNotNull()
    f = inv.filter(ordered).join(po, "purchase_order_number", "left").unionByName(inv.filter(~ordered), allowMissingColumns=True)
    f = f.join(first_clin, "invoice_id", "left").join(rr, "invoice_id", "left")
    f = f.withColumns({c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("line_item_sk", "rr_sk", "ia_sk")})
    f = resolve_sk(f, gold["common.dim_agency"], "activity_address_cd", "agency_sk")
    po_amt, rr_amt = F.coalesce("po_amt", zero), F.coalesce("rr_amt", zero)
    return f.select(
        "line_item_sk", "rr_sk", F.lit(-1).cast("bigint").alias("agreement_sk"), "ia_sk", "agency_sk",
        date_sk("invoice_dt").alias("invoice_date_sk"), F.lit(None).cast("int").alias("payment_date_sk"),
        F.col("id").alias("source_inv_summary_id"), F.col("pegasys_doc_num").alias("pegasys_invoice_num"),
        F.coalesce("total_invoice_amount", zero).cast("decimal(15,2)").alias("invoice_amt"),
        po_amt.cast("decimal(15,2)").alias("po_amt"), rr_amt.cast("decimal(15,2)").alias("rr_amt"),
        F.lit(None).cast("decimal(15,2)").alias("payment_amt"), F.lit(None).cast("decimal(15,2)").alias("billing_amt"),
        F.lit(None).cast("int").alias("invoice_to_payment_days"),
        F.lit(None).cast("boolean").alias("is_prompt_payment_compliant"),
        F.round(po_amt - rr_amt, 2).cast("decimal(15,2)").alias("po_to_rr_variance_amt"),
        F.lit(None).cast("decimal(15,2)").alias("invoice_to_billing_variance_amt"))


def invoice_line_report(silver) -> DataFrame:
    """Invoices whose items span more than one accepted line, counted on the
    raw items before any reduction (CHK-17, D-11)."""
    items = live(silver["aasbs_invoice_item"]).filter(F.col("cost_line_item_accepted_id").isNotNull())
    per = items.groupBy("invoice_id").agg(F.count_distinct("cost_line_item_accepted_id").alias("n_lines"))
    return per.filter(F.col("n_lines") > 1)
