"""Obligation & expenditure fact (DP1): accepted line × LOA × funding × IA ×
fiscal period, with invoice, acceptance and billing amounts of the line.

Plan: the ledger is aggregated to its grain (partial aggregation, one
shuffle); invoices, acceptances and bills are each aggregated to the
accepted line before they are joined (no fan-out); keys are resolved to
current surrogate keys with the -1 sentinel, on narrow rows, in stored steps
so that no step's shuffle files outlive it; all-zero rows are dropped.
The same builder serves the full load and, given ``affected`` grains, the
CDC refresh (SURVEY D-5: one builder, prime rules).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import all_zero, date_sk, fiscal_month, fiscal_quarter, fiscal_year
from gildhall.operators import preagg_join, resolve_sk
from gildhall.plans.domain.steps import materialised, step
from gildhall.session import stored
from gildhall.sources import live

GRAIN = ["line_item_accepted_id", "loa_id", "funding_id", "ia_id", "fiscal_year", "fiscal_quarter", "fiscal_month"]


def _zero():
    return F.lit(0).cast("decimal(15,2)")


def ledger_grain(ledger: DataFrame) -> DataFrame:
    d = F.col("created_dt")
    lines = live(ledger).filter(F.col("line_item_accepted_id").isNotNull())
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",")
    return lines.groupBy("line_item_accepted_id", "loa_id", "funding_id", "ia_id",
                         fiscal_year(d).alias("fiscal_year"), fiscal_quarter(d).alias("fiscal_quarter"),
                         fiscal_month(d).alias("fiscal_month")).agg(
        F.max("transaction_type_cd").alias("loa_transaction_type_cd"),
        F.to_date(F.max(d)).alias("snapshot_date"),
        F.sum("line_item_committed_amt").alias("committed_amt"),
        F.sum("line_item_certified_amt").alias("certified_amt"),
        F.sum("line_item_obligated_amt").alias("obligated_amt"),
        F.sum("service_charge_amt").alias("service_charge_amt"),
        ids.alias("source_loa_ledger_ids"))


def fact_obligation_expenditure(silver, gold, as_of: str, affected: DataFrame | None = None,
                                accrual_gate=None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``affected``: optional ``(line_item_accepted_id, loa_id)`` grains to
    re-aggregate in full (CDC); otherwise the full load. Items, accepted lines
    and line items of other lines are then dropped before they are aggregated:
    ``affected`` should be stored, so that few grains are broadcast by their
    known size and nothing else moves. ``carry``: columns of the ledger grain
    to return as well.

    ``accrual_gate``: optional boolean Column (a scalar subquery over the audit
    log, CDC-6). When given, accrual income per accepted line is aggregated
    and joined once, and ``accrued_amt`` takes it only where the gate is
    true; otherwise ``accrued_amt`` is 0 as in the full load."""
    key = "line_item_accepted_id"
    # dealt by line once: the grain holds the line, so its aggregate and the joins on the line move nothing more
    ledger = silver["aasbs_loa_ledger"]
    if affected is not None:
        ledger = ledger.join(affected.select("line_item_accepted_id", "loa_id").distinct(),
                             ["line_item_accepted_id", "loa_id"], "left_semi")
    g = ledger_grain(ledger.repartition(key))

    def of_lines(df: DataFrame) -> DataFrame:
        return df if affected is None else df.join(affected.select(key).distinct(), key, "left_semi")
    inv = live(silver["aasbs_invoice_item"]).filter(F.col("cost_line_item_accepted_id").isNotNull()) \
        .withColumnRenamed("cost_line_item_accepted_id", key)
    inv = of_lines(inv)
    g = preagg_join(g, inv, key, [F.sum("invoice_item_amt").alias("invoiced_amt"),
                                  F.count_distinct("invoice_id").alias("invoice_count")])
    acc = of_lines(live(silver["aasbs_acceptance_item"]).filter(F.col(key).isNotNull()))
    g = preagg_join(g, acc, key, [F.sum("item_gsa_approved_amt").alias("accepted_amt"),
                                  F.count_distinct("acceptance_id").alias("acceptance_count")])
    bill = of_lines(live(silver["aasbs_bill_item"]).filter(F.col(key).isNotNull()))
    g = preagg_join(g, bill, key, [F.sum("bill_item_amt").alias("billed_amt")])
    if accrual_gate is not None:
        acr = of_lines(live(silver["aasbs_accrual_income"]).filter(F.col(key).isNotNull()))
        g = preagg_join(g, acr, key, [F.sum("calculated_income_amt").alias("_accrued")])
    lia = live(silver["aasbs_line_item_accepted"]).select(F.col("id").alias(key), "line_item_id", "budget_fy")
    lia = of_lines(lia)
    lia = lia.dropDuplicates([key]) if affected is None else stored(lia.dropDuplicates([key]))    # joined, and names the line items
    # the line's keys are resolved on the narrow lookups, so they meet the fact's rows where those lie, by line
    lines = gold["common.dim_line_item"].withColumnRenamed("award_sk", "li_award_sk")
    lines = lines.select(*[c for c in ("line_item_id", "line_item_sk", "li_award_sk", "is_current_flag") if c in lines.columns])
    if affected is not None:
        lines = lines.join(lia.select("line_item_id").distinct(), "line_item_id", "left_semi")
    lines = resolve_sk(lines, gold["common.dim_award"].withColumnRenamed("award_sk", "li_award_sk")
                       .withColumn("award_sk", F.col("li_award_sk")), "li_award_sk", "award_sk")
    lia = resolve_sk(lia, lines, "line_item_id", "line_item_sk", missing=None, carry={"award_sk": "award_sk"})
    if affected is None:
        lia = step(gold, lia)
    g = g.join(lia, key, "left")
    g = g.withColumn("award_sk", F.coalesce("award_sk", F.lit(-1)).cast("bigint"))

    def keyed(rows: DataFrame) -> DataFrame:
        rows = resolve_sk(rows, gold["common.dim_loa"], "loa_id", "loa_sk")
        rows = resolve_sk(rows, gold["common.dim_funding"], "funding_id", "funding_sk")
        rows = resolve_sk(rows, gold["common.dim_ia"], "ia_id", "ia_sk", carry={"servicing_agency_sk": "_serv_agency"})
        return resolve_sk(rows, gold["common.dim_agency"].withColumnRenamed("agency_sk", "_serv_agency")
                          .withColumn("agency_sk", F.col("_serv_agency")), "_serv_agency", "agency_sk")

    if affected is None and materialised(gold):
        # the ledger's keys are resolved on narrow rows, numbered as they are stored; the wide ones move once to meet them
        g = step(gold, g.withColumn("_row", F.monotonically_increasing_id()))
        refs = keyed(g.select("_row", "loa_id", "funding_id", "ia_id")).select("_row", "loa_sk", "funding_sk", "ia_sk", "agency_sk")
        g = g.join(step(gold, refs), "_row")
    else:
        g = keyed(g)

    ZERO = _zero()
    obl, acc_amt, inv_amt = (F.coalesce(F.col(c), ZERO) for c in ("obligated_amt", "accepted_amt", "invoiced_amt"))
    out = g.select(
        "line_item_sk", "loa_sk", "funding_sk", "award_sk", "ia_sk", "agency_sk",
        date_sk("snapshot_date").alias("snapshot_date_sk"), "fiscal_year", "fiscal_quarter", "fiscal_month",
        "budget_fy",
        F.coalesce("committed_amt", ZERO).cast("decimal(15,2)").alias("committed_amt"),
        F.coalesce("certified_amt", ZERO).cast("decimal(15,2)").alias("certified_amt"),
        obl.cast("decimal(15,2)").alias("obligated_amt"), inv_amt.cast("decimal(15,2)").alias("invoiced_amt"),
        acc_amt.cast("decimal(15,2)").alias("accepted_amt"),
        F.coalesce("billed_amt", ZERO).cast("decimal(15,2)").alias("billed_amt"),
        (F.when(accrual_gate, F.coalesce(F.col("_accrued"), ZERO)).otherwise(ZERO) if accrual_gate is not None
         else ZERO).cast("decimal(15,2)").alias("accrued_amt"),
        (obl - acc_amt).cast("decimal(15,2)").alias("udo_amt"),
        F.coalesce("service_charge_amt", ZERO).cast("decimal(15,2)").alias("service_charge_amt"),
        F.lit(None).cast("decimal(15,2)").alias("disbursed_amt"),
        (obl - inv_amt).cast("decimal(15,2)").alias("undelivered_orders_amt"),
        "loa_transaction_type_cd",
        F.coalesce("invoice_count", F.lit(0)).cast("int").alias("invoice_count"),
        F.coalesce("acceptance_count", F.lit(0)).cast("int").alias("acceptance_count"),
        F.col("line_item_id").alias("source_line_item_id"), "source_loa_ledger_ids", *carry)
    return out.filter(~all_zero(["obligated_amt", "accepted_amt", "invoiced_amt"]))
