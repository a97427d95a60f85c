"""The first product's domain builders run over Silver derived from the whole
test tables (``dp1_silver``), with the same derivation and build rules in
DuckDB SQL as the oracle."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from gildhall.plans.dp1_silver import derived_silver
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF, DMUL, FY, LEDGER_SQL
from gildhall.session import stored

LIVE = "(is_deleted IS NULL OR is_deleted = FALSE)"


def _pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"


SILVER_DIM_SQL = f"""s_lu_agency AS (
  SELECT upper(substr(r_name, 1, 3)) AS cd, {_pad('r_regionkey', 2)} AS cd_2char, r_name AS description FROM region),
s_fed AS (
  SELECT {_pad('r_regionkey', 2)} AS agency_code, lower(r_name) AS agency_description,
         CASE WHEN r_regionkey % 3 = 0 THEN 'EXEC' WHEN r_regionkey % 3 = 1 THEN 'LEGIS' ELSE 'OTHER' END AS agency_type,
         CAST(NULL AS TIMESTAMP) AS inactive_date FROM region),
s_aac AS (
  SELECT 'AAC' || {_pad('n_nationkey', 3)} AS cd, n_name AS description, {_pad('n_regionkey', 2)} AS fpds,
         'P' || CAST(n_nationkey % 3 AS VARCHAR) AS program_cd, {_pad('n_regionkey', 2)} AS region_cd
  FROM nation WHERE NOT (n_nationkey = 24)),
s_bureau AS (
  SELECT upper(substr(r_name, 1, 3)) AS agency_cd, 'B' || {_pad('n_nationkey', 2)} AS cd, n_name || ' bureau' AS description,
         CAST(DATE '2000-01-01' + CAST(24 - n_nationkey AS INTEGER) AS TIMESTAMP) AS updated_dt
  FROM nation JOIN region ON n_regionkey = r_regionkey),
s_ia AS (
  SELECT c_custkey AS id, 'IA-' || CAST(c_custkey AS VARCHAR) AS piid,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MIPR' WHEN 'BUILDING' THEN 'gtc' WHEN 'FURNITURE' THEN 'IAA'
              WHEN 'HOUSEHOLD' THEN 'LOCAL' END AS instrument_type_cd,
         'S' || CAST(c_custkey % 4 AS VARCHAR) AS ia_status_cd, CAST(1995 + c_custkey % 7 AS INTEGER) AS fiscal_year,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) AS ia_began_dt,
         'AAC' || {_pad('c_nationkey', 3)} AS activity_address_cd, 'SVC' || CAST(c_nationkey % 5 AS VARCHAR) AS serv_agency_cd
  FROM customer WHERE NOT (c_custkey % 97 = 1)),
s_ia_status AS (SELECT DISTINCT ia_status_cd AS cd, 'Code ' || ia_status_cd AS description FROM (
  SELECT 'S' || CAST(c_custkey % 4 AS VARCHAR) AS ia_status_cd FROM customer) WHERE ia_status_cd <> 'S3'),
g_agency_rows AS (
  SELECT COALESCE(a.fpds, f.agency_code, 'UNKNOWN') AS agency_code, b.cd AS bureau_code, a.cd AS activity_address_cd,
         COALESCE(ag.description, f.agency_description, 'UNKNOWN') AS agency_name, b.description AS bureau_name,
         a.description AS aac_description, f.agency_code AS department_code, f.agency_description AS department_name,
         CAST(NULL AS VARCHAR) AS treasury_symbol,
         COALESCE(f.agency_type IN ('EXEC', 'LEGIS', 'JUDIC'), FALSE) AS is_omb_agency_flag, FALSE AS is_intel_community
  FROM s_aac a
  LEFT JOIN (SELECT cd_2char, MIN(cd) AS agency_cd_internal FROM s_lu_agency WHERE cd_2char IS NOT NULL GROUP BY 1) i
         ON i.cd_2char = a.fpds
  LEFT JOIN s_lu_agency ag ON ag.cd = i.agency_cd_internal
  LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY agency_cd ORDER BY updated_dt ASC NULLS LAST, cd) AS rn
             FROM s_bureau) WHERE rn = 1) b ON b.agency_cd = i.agency_cd_internal
  LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY agency_code
             ORDER BY agency_description ASC NULLS LAST, agency_type) AS rn FROM s_fed
             WHERE inactive_date IS NULL OR inactive_date > TIMESTAMP '{AS_OF}') WHERE rn = 1) f ON f.agency_code = a.fpds),
g_agency AS (SELECT ROW_NUMBER() OVER (ORDER BY activity_address_cd) AS agency_sk, * FROM g_agency_rows),
g_ia_rows AS (
  SELECT i.id AS ia_id, i.piid AS ia_num,
         CASE WHEN upper(COALESCE(instrument_type_cd, '')) IN ('GTC', 'GT', 'GTAC', 'GT_AND_C') THEN 'GT_AND_C'
              WHEN upper(COALESCE(instrument_type_cd, '')) IN ('IAA', 'MIPR', 'ECONOMY_ACT', 'MOU', 'IOA', 'BOA', 'CROSS_SERVICING') THEN 'ORDER'
              WHEN instrument_type_cd IS NOT NULL THEN 'INTRA_AGENCY' END AS ia_type_cd,
         CASE WHEN upper(COALESCE(instrument_type_cd, '')) IN ('GTC', 'GT', 'GTAC', 'GT_AND_C') THEN 'Government-wide Task and Delivery Order Contract'
              WHEN upper(COALESCE(instrument_type_cd, '')) IN ('IAA', 'MIPR', 'ECONOMY_ACT', 'MOU', 'IOA', 'BOA', 'CROSS_SERVICING') THEN 'Interagency Order'
              WHEN instrument_type_cd IS NOT NULL THEN 'Intra-Agency Instrument' END AS ia_type_desc,
         i.ia_status_cd, COALESCE(st.description, i.ia_status_cd) AS ia_status_desc, i.instrument_type_cd,
         COALESCE(COALESCE(st.description, i.ia_status_cd), i.instrument_type_cd) AS instrument_type_desc,
         i.fiscal_year, i.ia_began_dt AS ia_start_dt, CAST(NULL AS TIMESTAMP) AS ia_end_dt,
         CAST(NULL AS DECIMAL(15,2)) AS total_direct_cost_est_amt, CAST(NULL AS DECIMAL(15,2)) AS total_charges_est_amt,
         COALESCE(ag.agency_sk, -1) AS servicing_agency_sk, CAST(NULL AS BIGINT) AS requesting_agency_sk,
         aac.program_cd, aac.region_cd
  FROM s_ia i LEFT JOIN s_ia_status st ON st.cd = i.ia_status_cd
  LEFT JOIN s_aac aac ON aac.cd = i.activity_address_cd
  LEFT JOIN g_agency ag ON ag.activity_address_cd = i.activity_address_cd),
g_ia AS (SELECT ROW_NUMBER() OVER (ORDER BY ia_id) AS ia_sk, * FROM g_ia_rows)"""

def _materialized(sql: str) -> str:
    """``sql`` with each of its common tables computed once, instead of expanded wherever it is read."""
    return re.sub(r"(?<![\w)] )\b(\w+) AS \((?=\s*SELECT)", r"\1 AS MATERIALIZED (", sql)


SCD_COLS_SQL = f"TIMESTAMP '{AS_OF}' AS eff_start_dt, CAST(NULL AS TIMESTAMP) AS eff_end_dt, TRUE AS is_current_flag"


def _ckpt(name: str, df):
    # each Gold table a target reads is materialised (Parquet in the shared folder), as a
    # production load writes it: later builders read it instead of recomputing its chain.
    # Dimensions come numbered from stored rows (``assign_sk``) and are not written twice
    return df if name.split(".")[-1].startswith("dim_") else stored(df)


def _gold(t, silver=None):
    """Gold over derived Silver, each table built on first access with only what it reads."""
    from gildhall.plans.domain import LazyGold
    return LazyGold(derived_silver(t) if silver is None else silver, AS_OF, materialise=_ckpt)


def _build(t, target: str):
    """``target`` over derived Silver; the Gold tables it reads (and only those) are built first."""
    return _gold(t).plan(target)


@query("q_dp1_dim_agency", f"WITH {SILVER_DIM_SQL} SELECT *, {SCD_COLS_SQL} FROM g_agency")
def q_dp1_dim_agency(t):
    """Agency dimension built from derived Silver: one bureau per agency (D-16), dense keys by address code."""
    return _build(t, "common.dim_agency")


@query("q_dp1_dim_ia", f"WITH {SILVER_DIM_SQL} SELECT *, {SCD_COLS_SQL} FROM g_ia")
def q_dp1_dim_ia(t):
    """IA dimension: type rules, status decode, servicing agency key with sentinel."""
    return _build(t, "common.dim_ia")


FACT_SQL = f"""{LEDGER_SQL},
s_lineitem_ids AS (SELECT *, l_orderkey * 100 + l_linenumber AS lia FROM lineitem),
g_loa AS (SELECT ROW_NUMBER() OVER (ORDER BY s_suppkey) AS loa_sk, s_suppkey AS loa_id FROM supplier
          WHERE NOT (s_suppkey % 50 = 49)),
g_award AS (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS award_sk, o_orderkey AS award_id FROM orders),
g_funding AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS funding_sk, c_custkey AS funding_id FROM customer),
s_line_item AS (SELECT l_orderkey * 100 + l_linenumber AS line_item_id, l_orderkey * 10 + 1 AS parent_award_mod_id,
                CAST(year(MAX(l_shipdate)) AS INTEGER) AS budget_fy
                FROM lineitem GROUP BY l_orderkey, l_linenumber),
g_line_item AS (SELECT ROW_NUMBER() OVER (ORDER BY li.line_item_id) AS line_item_sk, li.line_item_id, li.budget_fy,
                COALESCE(aw.award_sk, -1) AS award_sk
                FROM s_line_item li LEFT JOIN g_award aw ON aw.award_id = (li.parent_award_mod_id - 1) // 10),
s_ledger AS (SELECT l.l_orderkey * 100 + l.l_linenumber AS id, l.l_orderkey * 100 + l.l_linenumber AS line_item_accepted_id,
             l.l_suppkey AS loa_id, o.o_custkey AS funding_id, o.o_custkey AS ia_id, l.l_shipdate AS created_dt,
             CAST(l.l_extendedprice AS DECIMAL(15,2)) AS obligated, CAST(l.l_extendedprice AS DECIMAL(15,2)) AS committed,
             round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(1 - l.l_discount AS DECIMAL(15,2)), 2) AS certified,
             round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_tax AS DECIMAL(15,2)), 2) AS service_charge,
             l.l_linestatus AS transaction_type_cd, l.is_deleted
             FROM ledger l JOIN orders o ON o.o_orderkey = l.l_orderkey),
g AS (SELECT line_item_accepted_id, loa_id, funding_id, ia_id,
             CAST(year(created_dt) + CASE WHEN month(created_dt) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
             CAST((((month(created_dt) + 2) % 12)) // 3 + 1 AS INTEGER) AS fiscal_quarter,
             CAST(((month(created_dt) + 2) % 12) + 1 AS INTEGER) AS fiscal_month,
             MAX(transaction_type_cd) AS loa_transaction_type_cd, CAST(MAX(created_dt) AS DATE) AS snapshot_date,
             SUM(committed) AS committed_amt, SUM(certified) AS certified_amt, SUM(obligated) AS obligated_amt,
             SUM(service_charge) AS service_charge_amt,
             string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS source_loa_ledger_ids
      FROM s_ledger WHERE {LIVE} AND line_item_accepted_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7),
inv AS (SELECT lia, SUM(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(1 - l_discount AS DECIMAL(15,2)), 2)) AS invoiced_amt,
        COUNT(DISTINCT l_orderkey) AS invoice_count FROM s_lineitem_ids WHERE l_returnflag = 'A' GROUP BY 1),
acc AS (SELECT lia, SUM(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(0.9 AS DECIMAL(15,2)), 2)) AS accepted_amt,
        COUNT(DISTINCT l_orderkey) AS acceptance_count FROM s_lineitem_ids WHERE l_linestatus = 'F' GROUP BY 1),
bill AS (SELECT lia, SUM(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)), 2)) AS billed_amt
         FROM s_lineitem_ids WHERE l_returnflag = 'N' GROUP BY 1),
fact AS (
  SELECT li.line_item_sk, COALESCE(lo.loa_sk, -1) AS loa_sk, COALESCE(fu.funding_sk, -1) AS funding_sk,
         COALESCE(li.award_sk, -1) AS award_sk, COALESCE(ia.ia_sk, -1) AS ia_sk,
         COALESCE(ia.servicing_agency_sk, -1) AS agency_sk,
         CAST(strftime(g.snapshot_date, '%Y%m%d') AS INTEGER) AS snapshot_date_sk, g.fiscal_year, g.fiscal_quarter,
         g.fiscal_month, li.budget_fy,
         CAST(COALESCE(g.committed_amt, 0) AS DECIMAL(15,2)) AS committed_amt,
         CAST(COALESCE(g.certified_amt, 0) AS DECIMAL(15,2)) AS certified_amt,
         CAST(COALESCE(g.obligated_amt, 0) AS DECIMAL(15,2)) AS obligated_amt,
         CAST(COALESCE(inv.invoiced_amt, 0) AS DECIMAL(15,2)) AS invoiced_amt,
         CAST(COALESCE(acc.accepted_amt, 0) AS DECIMAL(15,2)) AS accepted_amt,
         CAST(COALESCE(bill.billed_amt, 0) AS DECIMAL(15,2)) AS billed_amt,
         CAST(0 AS DECIMAL(15,2)) AS accrued_amt,
         CAST(COALESCE(g.obligated_amt, 0) - COALESCE(acc.accepted_amt, 0) AS DECIMAL(15,2)) AS udo_amt,
         CAST(COALESCE(g.service_charge_amt, 0) AS DECIMAL(15,2)) AS service_charge_amt,
         CAST(NULL AS DECIMAL(15,2)) AS disbursed_amt,
         CAST(COALESCE(g.obligated_amt, 0) - COALESCE(inv.invoiced_amt, 0) AS DECIMAL(15,2)) AS undelivered_orders_amt,
         g.loa_transaction_type_cd, CAST(COALESCE(inv.invoice_count, 0) AS INTEGER) AS invoice_count,
         CAST(COALESCE(acc.acceptance_count, 0) AS INTEGER) AS acceptance_count,
         li.line_item_id AS source_line_item_id, g.source_loa_ledger_ids
  FROM g
  LEFT JOIN inv ON inv.lia = g.line_item_accepted_id
  LEFT JOIN acc ON acc.lia = g.line_item_accepted_id
  LEFT JOIN bill ON bill.lia = g.line_item_accepted_id
  LEFT JOIN g_line_item li ON li.line_item_id = g.line_item_accepted_id
  LEFT JOIN g_loa lo ON lo.loa_id = g.loa_id
  LEFT JOIN g_funding fu ON fu.funding_id = g.funding_id
  LEFT JOIN g_ia ia ON ia.ia_id = g.ia_id
  WHERE NOT (COALESCE(g.obligated_amt, 0) = 0 AND COALESCE(acc.accepted_amt, 0) = 0 AND COALESCE(inv.invoiced_amt, 0) = 0))"""


@query("q_dp1_fact_obligation", f"WITH {SILVER_DIM_SQL}, {FACT_SQL} SELECT * FROM fact")
def q_dp1_fact_obligation(t):
    """The obligation fact over the whole derived ledger: grain aggregate, line-level
    invoice/acceptance/bill aggregates joined once each, six key resolutions, zero rows dropped."""
    return _build(t, "oet.fact_obligation_expenditure")


# loads of the fact: everything that had arrived by the first cutoff, then the changes up to each later one. A ledger
# row arrives when it is created, one in seven of them 40 days later, after the load that should have read it
CUTOFFS = ("1998-01-01", "1998-02-01", "1998-03-01")
LATE_DAYS = 45
ARRIVED = "(l_shipdate + CASE WHEN (l_orderkey * 100 + l_linenumber) % 7 = 3 THEN INTERVAL 40 DAY ELSE INTERVAL 0 DAY END)"
CDC_FACT_SQL = FACT_SQL.replace("FROM ledger l JOIN orders o ON o.o_orderkey = l.l_orderkey)",
                                f"FROM ledger l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE {ARRIVED} < TIMESTAMP '{CUTOFFS[2]}')") \
    .replace("li.line_item_id AS source_line_item_id, g.source_loa_ledger_ids",
             "li.line_item_id AS source_line_item_id, g.source_loa_ledger_ids, g.line_item_accepted_id, g.loa_id")


@query("q_dp1_cdc_fact", f"""WITH {SILVER_DIM_SQL}, {CDC_FACT_SQL},
last_load AS (
  SELECT l_orderkey * 100 + l_linenumber AS line_item_accepted_id, l_suppkey AS loa_id,
         CAST(MAX(CASE WHEN {ARRIVED} < TIMESTAMP '{CUTOFFS[0]}' THEN 0 WHEN {ARRIVED} < TIMESTAMP '{CUTOFFS[1]}' THEN 1 ELSE 2 END)
              AS INTEGER) AS _load_sk
  FROM ledger WHERE {ARRIVED} < TIMESTAMP '{CUTOFFS[2]}' GROUP BY 1, 2)
SELECT fact.*, last_load._load_sk FROM fact JOIN last_load USING (line_item_accepted_id, loa_id)""")
def q_dp1_cdc_fact(t):
    """The obligation fact by a full load and two change loads, the first of them repeated, with ledger rows that
    arrive after their window: the latest state equals a build from the final ledger, and each row is from
    the last load that had a changed row of its grain, so rows read again appended nothing (CDC-1, CDC-4..6, SNK-3, SNP-1)."""
    import uuid
    from collections import ChainMap

    from gildhall.operators import SnapshotFact
    from gildhall.plans.domain.cdc import FACT_GRAIN, load_fact
    from gildhall.session import checkpoint_dir
    silver = derived_silver(t)
    gold = _gold(t, silver)
    spark = t["lineitem"].sparkSession
    ledger = _ckpt("aasbs_loa_ledger", silver["aasbs_loa_ledger"])      # read by every load
    late = F.when(F.col("id") % 7 == 3, F.expr("INTERVAL 40 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    fact = SnapshotFact(spark, f"{checkpoint_dir(spark).rstrip('/')}/cdc-fact-{uuid.uuid4().hex}", FACT_GRAIN, ["id", "loa_id"], buckets=16)
    for load in (0, 1, 1, 2):
        hi = CUTOFFS[load]
        there = ledger.filter(F.col("created_dt") + late < F.lit(hi).cast("timestamp_ntz"))
        load_fact(fact, load, ChainMap({"aasbs_loa_ledger": there}, silver), gold, CUTOFFS[load - 1] if load else None, hi,
                  overlap_days=LATE_DAYS)
    return fact.state()


CFO_SQL = f"""g_line_item_attrs AS (
  SELECT li.line_item_id, lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || 'AA' AS clin_num,
         COALESCE(CASE WHEN li.type_cd = 'F' THEN 'Fulfilled' END, li.type_cd) AS line_item_type_desc, p.p_brand AS psc_cd
  FROM (SELECT l_orderkey * 100 + l_linenumber AS line_item_id, l_linenumber, MIN(l_linestatus) AS type_cd,
               MIN(l_partkey) AS part FROM lineitem GROUP BY l_orderkey, l_linenumber) li
  LEFT JOIN part p ON p.p_partkey = li.part),
g_loa_attrs AS (
  SELECT s_suppkey AS loa_id, 'F' || CAST(s_suppkey % 4 AS VARCHAR) AS fund_cd, CAST(NULL AS VARCHAR) AS object_class_cd,
         NULLIF(concat_ws('-', '047', NULLIF(trim({_pad('s_nationkey % 5', 2)} || {_pad('s_nationkey', 2)}), ''),
                NULLIF(trim(COALESCE(CASE WHEN s_suppkey % 2 = 0 THEN 'X' END, '') || {_pad('s_suppkey % 100', 4)}), ''),
                NULLIF(trim(CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '001' END), '')), '') AS treasury_account_symbol
  FROM supplier WHERE NOT (s_suppkey % 50 = 49))"""


@query("q_dp1_cfo_summary", f"""WITH {SILVER_DIM_SQL}, {FACT_SQL}, {CFO_SQL}
SELECT a.agency_name, a.bureau_name, f.fiscal_year, f.fiscal_quarter, ia.ia_num, ia.ia_type_desc, li.clin_num,
       li.line_item_type_desc, li.psc_cd, loa.fund_cd, loa.treasury_account_symbol, loa.object_class_cd,
       CAST(SUM(f.obligated_amt) AS DECIMAL(38,2)) AS total_obligated, CAST(SUM(f.accepted_amt) AS DECIMAL(38,2)) AS total_accepted,
       CAST(SUM(f.billed_amt) AS DECIMAL(38,2)) AS total_billed, CAST(SUM(f.udo_amt) AS DECIMAL(38,2)) AS total_udo,
       CAST(SUM(f.accrued_amt) AS DECIMAL(38,2)) AS total_accrued,
       CAST(SUM(f.service_charge_amt) AS DECIMAL(38,2)) AS total_service_charge
FROM fact f
JOIN g_agency a ON a.agency_sk = f.agency_sk
JOIN g_ia ia ON ia.ia_sk = f.ia_sk
JOIN g_line_item gli ON gli.line_item_sk = f.line_item_sk
JOIN g_line_item_attrs li ON li.line_item_id = gli.line_item_id
JOIN g_loa lsk ON lsk.loa_sk = f.loa_sk
JOIN g_loa_attrs loa ON loa.loa_id = lsk.loa_id
GROUP BY ALL""")
def q_dp1_cfo_summary(t):
    """oet.v_cfo_obligation_summary over the built DP1 Gold tables: latest snapshot
    per grain (D-6), star join to current dimensions, grouped sums."""
    from pyspark.sql import functions as F

    from gildhall.plans.views import v_cfo_obligation_summary
    gold = _gold(t)
    v = v_cfo_obligation_summary(gold)
    sums = [c for c in v.columns if c.startswith("total_")]
    return v.select(*[F.col(c).cast("decimal(38,2)").alias(c) if c in sums else F.col(c) for c in v.columns])


CDC_AS_OF = "2002-03-01"
CDC_LO, CDC_HI = "2002-02-01", "2002-03-01"


def _silver_v2(silver):
    """Second Silver state: every seventh IA changes status inside the CDC window."""
    from pyspark.sql import functions as F
    ia = silver["aasbs_ia"]
    changed = F.col("id") % 7 == 0
    from collections import ChainMap
    out = ChainMap({}, silver)     # overlay: the other tables stay lazy
    out["aasbs_ia"] = ia.withColumn("ia_status_cd", F.when(changed, F.lit("S9")).otherwise(F.col("ia_status_cd"))) \
        .withColumn("updated_dt", F.when(changed, F.lit("2002-02-10 08:00:00").cast("timestamp_ntz")))
    return out


CDC_IA_SQL = f"""chg AS (SELECT * FROM g_ia WHERE ia_id % 7 = 0),
mx AS (SELECT MAX(ia_sk) AS m FROM g_ia),
nxt AS (SELECT * REPLACE ('S9' AS ia_status_cd, 'S9' AS ia_status_desc, 'S9' AS instrument_type_desc) FROM chg),
cdc AS (
  SELECT *, {SCD_COLS_SQL}, 'kept' AS _action FROM g_ia
  WHERE ia_id % 7 <> 0
  UNION ALL
  SELECT *, TIMESTAMP '{AS_OF}' AS eff_start_dt, TIMESTAMP '{CDC_AS_OF}' AS eff_end_dt, FALSE AS is_current_flag,
         'closed' AS _action FROM chg
  UNION ALL
  SELECT * REPLACE ((SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY ia_id) AS ia_sk),
         TIMESTAMP '{CDC_AS_OF}' AS eff_start_dt, CAST(NULL AS TIMESTAMP) AS eff_end_dt, TRUE AS is_current_flag,
         'inserted' AS _action FROM nxt)"""


@query("q_dp1_cdc_ia", f"WITH {SILVER_DIM_SQL}, {CDC_IA_SQL} SELECT * FROM cdc")
def q_dp1_cdc_ia(t):
    """CDC refresh of the IA dimension over the whole derived Silver: changed keys from
    the window, the full-load row builder on the restricted input, one classifying
    SCD2 join, fresh surrogate keys for new versions after the current maximum (CDC-7)."""
    from gildhall.plans.domain.cdc import refresh_dimension
    silver = derived_silver(t)
    gold = _gold(t)
    return refresh_dimension(_silver_v2(silver), gold, "common.dim_ia", CDC_LO, CDC_HI, CDC_AS_OF, "cdc-1")


AMEND_SQL = f"""s_am AS (
  SELECT o_orderkey AS id, o_custkey AS ia_id,
         CASE WHEN o_orderkey % 11 = 0 THEN 'X1' ELSE {_pad('o_orderkey % 100', 2)} END AS piid_ext,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'COST_INCREASE' WHEN '2-HIGH' THEN 'EXTEND_POP'
              WHEN '3-MEDIUM' THEN 'SCOPE_CHANGE' ELSE 'ADMIN' END AS ia_amend_action_cd,
         CAST(o_totalprice AS DECIMAL(15,2)) AS direct_cost,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL
              ELSE round(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.05 AS DECIMAL(15,2)), 2) END AS charges,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS TIMESTAMP) END AS end_dt,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(CAST(o_orderdate AS DATE) + 5 AS TIMESTAMP) END AS svc_signed,
         CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 10 AS TIMESTAMP) END AS req_signed,
         o_orderdate AS created_dt
  FROM orders),
g_action AS (SELECT ROW_NUMBER() OVER (ORDER BY cd) AS amend_action_sk, cd
             FROM (SELECT DISTINCT ia_amend_action_cd AS cd FROM s_am)),
ia_agency AS (SELECT i.id AS ia_id, i.serv_agency_cd, COALESCE(ag.agency_sk, -1) AS agency_sk
              FROM s_ia i LEFT JOIN g_agency ag ON ag.activity_address_cd = i.activity_address_cd),
loa_per_ia AS (
  SELECT o_custkey AS ia_id, MIN(o_orderkey % (SELECT MAX(s_suppkey) + 1 FROM supplier)) AS loa_id,
         SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS loa_change_amt FROM orders GROUP BY 1),
d AS (SELECT *, CAST(COALESCE(direct_cost, 0) + COALESCE(charges, 0) AS DECIMAL(16,2)) AS rev FROM s_am),
w AS (SELECT *, rev - LAG(rev) OVER (PARTITION BY ia_id ORDER BY id) AS cost_change,
             date_diff('day', LAG(CAST(end_dt AS DATE)) OVER (PARTITION BY ia_id ORDER BY id), CAST(end_dt AS DATE)) AS pop_ext
      FROM d),
amend AS (
  SELECT COALESCE(ia.ia_sk, -1) AS ia_sk, CAST(-1 AS BIGINT) AS award_sk, COALESCE(ac.amend_action_sk, -1) AS amend_action_sk,
         COALESCE(fu.funding_sk, -1) AS funding_sk, COALESCE(lo.loa_sk, -1) AS loa_sk, COALESCE(iag.agency_sk, -1) AS agency_sk,
         CAST(strftime(COALESCE(w.svc_signed, w.created_dt), '%Y%m%d') AS INTEGER) AS amend_date_sk,
         w.id AS source_ia_amendment_id, TRY_CAST(w.piid_ext AS INTEGER) AS amendment_num,
         CASE WHEN w.svc_signed IS NOT NULL AND w.req_signed IS NOT NULL THEN 'FINAL'
              WHEN w.svc_signed IS NOT NULL THEN 'PENDING_REQUEST' ELSE 'DRAFT' END AS amendment_status_cd,
         CAST(w.cost_change AS DECIMAL(15,2)) AS cost_change_amt, CAST(w.rev AS DECIMAL(15,2)) AS revised_total_cost_amt,
         CAST(w.pop_ext AS INTEGER) AS pop_extension_days, w.end_dt AS revised_pop_end_dt, iag.serv_agency_cd AS servicing_aac_cd,
         CAST(NULL AS VARCHAR) AS mod_type_cds, CAST(NULL AS BOOLEAN) AS validation_override_flag,
         CAST(NULL AS VARCHAR) AS validation_override_reason,
         CAST(COALESCE(lp.loa_change_amt, 0) AS DECIMAL(15,2)) AS loa_change_amt
  FROM w
  LEFT JOIN g_ia ia ON ia.ia_id = w.ia_id
  LEFT JOIN g_action ac ON ac.cd = w.ia_amend_action_cd
  LEFT JOIN g_funding fu ON fu.funding_id = w.ia_id
  LEFT JOIN loa_per_ia lp ON lp.ia_id = w.ia_id
  LEFT JOIN g_loa lo ON lo.loa_id = lp.loa_id
  LEFT JOIN ia_agency iag ON iag.ia_id = w.ia_id)"""


@query("q_iat_fact_ia_amendment", f"WITH {SILVER_DIM_SQL}, {FACT_SQL}, {AMEND_SQL} SELECT * FROM amend")
def q_iat_fact_ia_amendment(t):
    """IA amendment fact over amendments derived from all orders: LAG cost and period
    deltas per IA as a rank equi-join (skew-safe), one funding and LOA per IA (D-14)."""
    return _build(t, "iat.fact_ia_amendment")


def _entity_sql(code: str) -> str:
    u = f"upper({code})"
    return (f"CASE WHEN {u} LIKE '%AWARD%' THEN 'AWARD' WHEN {u} = 'IA' OR {u} LIKE '%\\_IA' ESCAPE '\\' THEN 'IA' "
            f"WHEN {u} LIKE '%ACQUISITION%' THEN 'ACQUISITION' WHEN {u} LIKE '%SOLICIT%' THEN 'SOLICITATION' "
            f"WHEN {u} LIKE '%FUNDING%' THEN 'FUNDING' ELSE 'COLLAB' END")


def _is_ia_sql(code: str) -> str:
    u = f"upper({code})"
    return f"({u} = 'IA' OR {u} LIKE '%\\_IA' ESCAPE '\\')"


LIFECYCLE_SQL = f"""ev_type AS (SELECT ROW_NUMBER() OVER (ORDER BY cd) AS event_type_sk, cd FROM (
    SELECT DISTINCT upper(event_type) AS cd FROM events UNION SELECT 'COLLABORATION' FROM conversations)),
ent AS (SELECT * FROM (VALUES ('ACQUISITION', 1), ('AWARD', 2), ('COLLAB', 3), ('FUNDING', 4), ('IA', 5),
                              ('SOLICITATION', 6)) v(entity_type_cd, entity_type_sk)),
award_by_mod AS (SELECT o_orderkey * 10 + k AS award_mod_id, aw.award_sk
                 FROM orders, (VALUES (0), (1)) m(k), g_award aw WHERE aw.award_id = o_orderkey),
acq AS (SELECT o_orderkey AS acquisition_id, COALESCE(ag.agency_sk, -1) AS agency_sk FROM orders
        LEFT JOIN g_agency ag ON ag.activity_address_cd = 'AAC' || {_pad('o_custkey % 25', 3)}),
chron AS (SELECT event_id AS id,
            CASE event_type WHEN 'purchase' THEN 'AWARD_MOD' WHEN 'signup' THEN 'IA' WHEN 'click' THEN 'FOO_IA'
                 WHEN 'view' THEN 'ACQUISITION' ELSE 'MEDIA' END AS code,
            user_id AS source_record_id, user_id * 10 + 1 AS event_record_id, upper(event_type) AS event_type_cd,
            ts AS created_dt, user_id AS created_by_user_id, props AS entry_description FROM events),
chron_rows AS (
  SELECT COALESCE(et.event_type_sk, -1) AS event_type_sk, COALESCE(en.entity_type_sk, -1) AS entity_type_sk,
         COALESCE(am.award_sk, -1) AS award_sk, COALESCE(ia.ia_sk, -1) AS ia_sk, COALESCE(a.agency_sk, -1) AS agency_sk,
         CAST(strftime(c.created_dt, '%Y%m%d') AS INTEGER) AS event_date_sk, c.source_record_id AS source_entity_id,
         c.id AS source_chronology_id, CAST(NULL AS BIGINT) AS source_collab_id, c.created_dt AS event_timestamp,
         c.created_by_user_id AS event_user_id, c.entry_description AS event_description,
         CAST(NULL AS VARCHAR) AS collab_type_cd, CAST(NULL AS VARCHAR) AS collab_status_cd,
         CAST(NULL AS TIMESTAMP) AS collab_due_dt, CAST(NULL AS VARCHAR) AS comment_type_cd,
         CAST(NULL AS VARCHAR) AS comment_text, CAST(NULL AS VARCHAR) AS email_status_cd
  FROM chron c
  LEFT JOIN ev_type et ON et.cd = c.event_type_cd
  LEFT JOIN ent en ON en.entity_type_cd = {_entity_sql('c.code')}
  LEFT JOIN award_by_mod am ON upper(c.code) LIKE '%AWARD%' AND am.award_mod_id = c.event_record_id
  LEFT JOIN g_ia ia ON {_is_ia_sql('c.code')} AND ia.ia_id = c.source_record_id
  LEFT JOIN acq a ON upper(c.code) LIKE '%ACQUISITION%' AND a.acquisition_id = c.source_record_id),
collab AS (SELECT conv_id AS id,
             CASE conv_id % 4 WHEN 0 THEN 'IA' WHEN 1 THEN 'AWARD_MOD' WHEN 2 THEN 'X_IA' ELSE 'MEDIA' END AS code,
             CASE WHEN conv_id % 4 = 1 THEN conv_id * 10 + 1 ELSE conv_id END AS table_record_id,
             CAST(DATE '2024-01-01' + CAST(conv_id % 365 AS INTEGER) AS TIMESTAMP) AS created_dt,
             conv_id AS created_by_user_id, role AS subject,
             CASE WHEN conv_id % 2 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS collab_status_cd
           FROM conversations WHERE turn = 0),
collab_acq AS (SELECT conv_id AS id, MIN(conv_id * 3 + turn - 1) AS acquisition_id FROM conversations
               WHERE turn IN (1, 2) GROUP BY 1),
last_comment AS (SELECT conv_id AS id, role AS comment_type_cd, text AS comment_text FROM (
                   SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY conv_id * 1000 + turn DESC) AS rn
                   FROM conversations) WHERE rn = 1),
collab_rows AS (
  SELECT COALESCE((SELECT event_type_sk FROM ev_type WHERE cd = 'COLLABORATION'), -1) AS event_type_sk,
         COALESCE(en.entity_type_sk, -1) AS entity_type_sk, COALESCE(am.award_sk, -1) AS award_sk,
         COALESCE(ia.ia_sk, -1) AS ia_sk, COALESCE(a.agency_sk, -1) AS agency_sk,
         CAST(strftime(c.created_dt, '%Y%m%d') AS INTEGER) AS event_date_sk, c.table_record_id AS source_entity_id,
         CAST(NULL AS BIGINT) AS source_chronology_id, c.id AS source_collab_id, c.created_dt AS event_timestamp,
         c.created_by_user_id AS event_user_id, c.subject AS event_description, 'REVIEW' AS collab_type_cd,
         c.collab_status_cd, CAST(NULL AS TIMESTAMP) AS collab_due_dt, lc.comment_type_cd, lc.comment_text,
         CAST(NULL AS VARCHAR) AS email_status_cd
  FROM collab c
  LEFT JOIN ent en ON en.entity_type_cd = {_entity_sql('c.code')}
  LEFT JOIN award_by_mod am ON upper(c.code) LIKE '%AWARD%' AND am.award_mod_id = c.table_record_id
  LEFT JOIN g_ia ia ON {_is_ia_sql('c.code')} AND ia.ia_id = c.table_record_id
  LEFT JOIN collab_acq ca ON ca.id = c.id
  LEFT JOIN acq a ON a.acquisition_id = ca.acquisition_id
  LEFT JOIN last_comment lc ON lc.id = c.id)"""


@query("q_cat_fact_lifecycle_event", f"""WITH {SILVER_DIM_SQL}, {FACT_SQL}, {LIFECYCLE_SQL}
SELECT * FROM chron_rows UNION ALL SELECT * FROM collab_rows""")
def q_cat_fact_lifecycle_event(t):
    """Lifecycle event fact over all events (chronology) and conversations (collaborations,
    whole comment texts): polymorphic references with the escaped IA pattern (D-28), the
    COLLABORATION event type as a constant lookup (scalar subquery), latest comment per
    collaboration, both branches in one shape."""
    return _build(t, "cat.fact_lifecycle_event")


BILLING_SQL = f"""s_lines AS (SELECT l_orderkey, l_orderkey * 100 + l_linenumber AS lia,
                   SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS total FROM lineitem GROUP BY l_orderkey, l_linenumber),
s_od AS (SELECT l.*, CAST(o.o_orderdate AS DATE) AS od FROM s_lines l JOIN orders o ON o.o_orderkey = l.l_orderkey),
s_scs AS (
  SELECT lia * 10 + 1 AS id, lia AS line_item_id, CAST(od AS TIMESTAMP) AS service_start_dt,
         CAST(od + 60 AS TIMESTAMP) AS service_end_dt, {DMUL("total", "0.5")} AS scheduled_amt,
         CAST(NULL AS BOOLEAN) AS is_deleted FROM s_od
  UNION ALL
  SELECT lia * 10 + 2, lia, CASE WHEN l_orderkey % 9 <> 0 THEN CAST(od + 61 AS TIMESTAMP) END,
         CAST(od + 180 AS TIMESTAMP), CASE WHEN lia % 7 <> 0 THEN {DMUL("total", "0.25")} END,
         lia % 41 = 0 FROM s_od),
s_inv_item AS (SELECT l_orderkey * 100 + l_linenumber AS lia, {DMUL("l_extendedprice", "1 - l_discount")} AS amt,
               l_shipdate AS begin_dt, CAST(CAST(l_shipdate AS DATE) + l_linenumber * 3 AS TIMESTAMP) AS end_dt
               FROM lineitem WHERE l_returnflag = 'A'),
scs_live AS (SELECT * FROM s_scs WHERE {LIVE}),
sched_inv AS (SELECT p.id AS schedule_id, SUM(COALESCE(i.amt, 0)) AS inv
              FROM scs_live p JOIN s_inv_item i ON i.lia = p.line_item_id
               AND p.service_start_dt <= i.begin_dt AND i.end_dt <= p.service_end_dt
              WHERE p.service_start_dt IS NOT NULL AND p.service_end_dt IS NOT NULL GROUP BY 1),
billing AS (
  SELECT ROW_NUMBER() OVER (ORDER BY p.id) AS billing_period_sk, p.id AS schedule_id,
         CASE WHEN p.service_start_dt IS NOT NULL THEN CAST(year(p.service_start_dt) AS VARCHAR) || '-M'
              || lpad(CAST(month(p.service_start_dt) AS VARCHAR), 2, '0') END AS billing_period_label,
         CAST(p.service_start_dt AS DATE) AS period_start_dt, CAST(p.service_end_dt AS DATE) AS period_end_dt,
         CAST(COALESCE(p.scheduled_amt, 0) AS DECIMAL(15,2)) AS scheduled_amt,
         CAST(COALESCE(si.inv, 0) AS DECIMAL(15,2)) AS invoiced_amt,
         CASE WHEN COALESCE(p.scheduled_amt, 0) <> 0 THEN CAST(round((COALESCE(si.inv, 0) - p.scheduled_amt)
              / p.scheduled_amt, 4) AS DECIMAL(7,4)) END AS variance_pct
  FROM scs_live p LEFT JOIN sched_inv si ON si.schedule_id = p.id)"""


@query("q_psc_dim_billing_period", f"WITH {BILLING_SQL} SELECT * FROM billing")
def q_psc_dim_billing_period(t):
    """Billing periods over every derived schedule: invoice items matched to the periods that
    contain their service dates (one equi + range join), variance against the schedule."""
    return _build(t, "psc.dim_billing_period")


SCS_FACT_SQL = f"""s_li AS (SELECT l.l_orderkey * 100 + l.l_linenumber AS line_item_id, o.o_custkey AS parent_ia_id,
                l.l_orderkey % 50 AS service_charge_id, l.l_orderkey AS award_id, l.l_linenumber = 3 AS is_travel,
                MIN(l.l_linestatus) AS status
                FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
                GROUP BY l.l_orderkey, l.l_linenumber, o.o_custkey),
per_schedule AS (
  SELECT p.id AS schedule_id, SUM(COALESCE(i.amt, 0)) AS inv,
         COUNT(CASE WHEN COALESCE(li.is_travel, FALSE) THEN i.lia END) AS tv_n,
         SUM(CASE WHEN COALESCE(li.is_travel, FALSE) THEN COALESCE(i.amt, 0) END) AS tv_amt
  FROM scs_live p JOIN s_inv_item i ON i.lia = p.line_item_id
   AND p.service_start_dt <= i.begin_dt AND i.end_dt <= p.service_end_dt
  LEFT JOIN s_li li ON li.line_item_id = p.line_item_id
  WHERE p.service_start_dt IS NOT NULL AND p.service_end_dt IS NOT NULL GROUP BY 1),
scs_fact AS (
  SELECT COALESCE(gl.line_item_sk, -1) AS line_item_sk, b.billing_period_sk, COALESCE(ga.award_sk, -1) AS award_sk,
         COALESCE(gi.ia_sk, -1) AS ia_sk, li.service_charge_id AS source_service_charge_id,
         li.status AS schedule_status_cd, CAST(COALESCE(p.scheduled_amt, 0) AS DECIMAL(15,2)) AS scheduled_amt,
         CAST(COALESCE(ps.inv, 0) AS DECIMAL(15,2)) AS invoiced_amt,
         CAST(COALESCE(ps.inv, 0) AS DECIMAL(15,2)) AS accepted_amt,
         CASE WHEN COALESCE(p.scheduled_amt, 0) = 0 THEN NULL
              ELSE CAST(abs(COALESCE(ps.inv, 0) - p.scheduled_amt) AS DOUBLE)
                   <= abs(CAST(p.scheduled_amt AS DOUBLE)) * CAST(0.1 AS DOUBLE) END AS on_schedule_flag,
         CAST(COALESCE(ps.tv_n, 0) AS INTEGER) AS travel_voucher_count,
         CAST(COALESCE(ps.tv_amt, 0) AS DECIMAL(15,2)) AS travel_voucher_amt
  FROM scs_live p
  LEFT JOIN s_li li ON li.line_item_id = p.line_item_id
  LEFT JOIN per_schedule ps ON ps.schedule_id = p.id
  LEFT JOIN g_line_item gl ON gl.line_item_id = p.line_item_id
  LEFT JOIN billing b ON b.schedule_id = p.id
  LEFT JOIN g_award ga ON ga.award_id = li.award_id
  LEFT JOIN g_ia gi ON gi.ia_id = li.parent_ia_id)"""


@query("q_psc_fact_service_charge_schedule",
       _materialized(f"WITH {SILVER_DIM_SQL}, {FACT_SQL}, {BILLING_SQL}, {SCS_FACT_SQL} SELECT * FROM scs_fact"))
def q_psc_fact_service_charge_schedule(t):
    """Service charge schedule fact: one row per live schedule, invoice and travel measures from
    one containment join, four key resolutions, the +/-10 % on-schedule flag."""
    return _build(t, "psc.fact_service_charge_schedule")


CLIN_SQL = f"""s_lines2 AS (SELECT l_orderkey, l_linenumber, l_orderkey * 100 + l_linenumber AS lia,
                    SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS total, MIN(l_partkey) AS part
                    FROM lineitem GROUP BY l_orderkey, l_linenumber),
s_labor AS (SELECT lia AS id, {DMUL("total", "0.6")} AS planned_amt,
                   CASE l_orderkey % 3 WHEN 0 THEN 'ACT' WHEN 1 THEN 'EST' ELSE 'FIXED' END AS cost_rate_type_cd,
                   'PH' || CAST(l_orderkey % 4 AS VARCHAR) AS proc_phase_cd,
                   'PRJ' || CAST(l_orderkey % 100 AS VARCHAR) AS project_num
            FROM s_lines2 WHERE l_linenumber = 1),
s_ff AS (SELECT lia AS id, CASE WHEN lia % 5 <> 0 THEN {DMUL("total", "0.3")} END AS planned_amt
         FROM s_lines2 WHERE l_linenumber = 2),
s_tr AS (SELECT lia AS id, {DMUL("total", "0.1")} AS planned_amt FROM s_lines2 WHERE l_linenumber = 3 AND lia % 13 <> 0),
s_af AS (SELECT lia AS id FROM s_lines2 WHERE l_linenumber = 4),
s_sc AS (SELECT DISTINCT o_orderkey % 50 AS id FROM orders),
sub_rows AS (
  SELECT l.lia AS line_item_id, 'DELIVERABLE' AS clin_subtype_cd, CAST(NULL AS VARCHAR) AS proc_phase_cd,
         CAST(NULL AS VARCHAR) AS project_num, p.p_brand AS psc_cd, p.p_type AS contract_type_cd, l.l_orderkey
  FROM s_lines2 l JOIN part p ON p.p_partkey = l.part
  UNION ALL SELECT l.lia, 'SC_LABOR', b.proc_phase_cd, b.project_num, NULL, NULL, l.l_orderkey
  FROM s_lines2 l JOIN s_labor b ON b.id = l.lia WHERE l.l_linenumber = 1
  UNION ALL SELECT l.lia, 'SC_FIXED_FEE', NULL, NULL, NULL, NULL, l.l_orderkey
  FROM s_lines2 l JOIN s_ff b ON b.id = l.lia WHERE l.l_linenumber = 2
  UNION ALL SELECT l.lia, 'SC_TRAVEL', NULL, NULL, NULL, NULL, l.l_orderkey
  FROM s_lines2 l JOIN s_tr b ON b.id = l.lia WHERE l.l_linenumber = 3
  UNION ALL SELECT l.lia, 'AWARD_FEE', NULL, NULL, NULL, NULL, l.l_orderkey
  FROM s_lines2 l JOIN s_af b ON b.id = l.lia WHERE l.l_linenumber = 4),
clin_subtype AS (
  SELECT r.line_item_id, r.clin_subtype_cd, r.proc_phase_cd,
         CASE WHEN r.proc_phase_cd IS NULL THEN NULL WHEN r.proc_phase_cd = 'PH3' THEN 'PH3'
              ELSE 'Code ' || r.proc_phase_cd END AS proc_phase_desc,
         r.project_num,
         CASE WHEN r.clin_subtype_cd IN ('SC_LABOR', 'SC_FIXED_FEE', 'SC_TRAVEL') THEN
              CASE WHEN (r.l_orderkey % 50) % 4 = 0 THEN TRUE WHEN (r.l_orderkey % 50) % 4 = 1 THEN FALSE
                   ELSE FALSE END END AS is_credit_flag,
         CASE WHEN r.clin_subtype_cd IN ('SC_LABOR', 'SC_FIXED_FEE', 'SC_TRAVEL')
              THEN 'ACT' || CAST(r.l_orderkey % 50 AS VARCHAR) END AS act_num,
         CAST(NULL AS VARCHAR) AS severability_type_cd, r.psc_cd, r.contract_type_cd,
         ROW_NUMBER() OVER (ORDER BY r.line_item_id, r.clin_subtype_cd) AS clin_subtype_sk
  FROM sub_rows r),
cost_rate AS (SELECT ROW_NUMBER() OVER (ORDER BY cd) AS cost_rate_type_sk, cd
              FROM (SELECT DISTINCT cost_rate_type_cd AS cd FROM s_labor WHERE cost_rate_type_cd <> 'FIXED') x),
burn AS (
  SELECT line_item_id, loa_id,
         ROW_NUMBER() OVER (PARTITION BY line_item_id ORDER BY first_ll, loa_id) AS loa_burn_order
  FROM (SELECT line_item_accepted_id AS line_item_id, loa_id, MIN(id) AS first_ll FROM s_ledger
        WHERE {LIVE} GROUP BY 1, 2) x),
actual AS (SELECT lia AS line_item_id, SUM(COALESCE(amt, 0)) AS actual_amt FROM s_inv_item GROUP BY 1),
clin_fact AS (
  SELECT COALESCE(gl.line_item_sk, -1) AS line_item_sk, COALESCE(cs.clin_subtype_sk, -1) AS clin_subtype_sk,
         cr.cost_rate_type_sk, COALESCE(ga.award_sk, -1) AS award_sk, COALESCE(gi.ia_sk, -1) AS ia_sk,
         COALESCE(lo.loa_sk, -1) AS loa_sk,
         CAST(COALESCE(lab.planned_amt, ff.planned_amt, tr.planned_amt, l.total, 0) AS DECIMAL(15,2)) AS planned_amt,
         CAST(NULL AS DECIMAL(10,2)) AS planned_hours, CAST(NULL AS DECIMAL(10,4)) AS planned_rate,
         CAST(NULL AS DECIMAL(15,2)) AS award_fee_amt, CAST(NULL AS DECIMAL(7,4)) AS award_fee_surcharge_rate,
         CAST(ff.planned_amt AS DECIMAL(15,2)) AS fixed_fee_amt, CAST(tr.planned_amt AS DECIMAL(15,2)) AS travel_planned_amt,
         CAST(COALESCE(a.actual_amt, 0) AS DECIMAL(15,2)) AS actual_amt, CAST(NULL AS DECIMAL(10,2)) AS actual_hours,
         b.loa_burn_order, CAST(NULL AS DECIMAL(7,4)) AS loa_proration_pct
  FROM s_lines2 l
  JOIN burn b ON b.line_item_id = l.lia
  LEFT JOIN s_labor lab ON lab.id = l.lia AND l.l_linenumber = 1
  LEFT JOIN s_ff ff ON ff.id = l.lia AND l.l_linenumber = 2
  LEFT JOIN s_tr tr ON tr.id = l.lia AND l.l_linenumber = 3
  LEFT JOIN actual a ON a.line_item_id = l.lia
  LEFT JOIN g_line_item gl ON gl.line_item_id = l.lia
  LEFT JOIN clin_subtype cs ON cs.line_item_id = l.lia
  LEFT JOIN cost_rate cr ON cr.cd = lab.cost_rate_type_cd
  LEFT JOIN g_award ga ON ga.award_id = l.l_orderkey
  LEFT JOIN s_li li ON li.line_item_id = l.lia
  LEFT JOIN g_ia gi ON gi.ia_id = li.parent_ia_id
  LEFT JOIN g_loa lo ON lo.loa_id = b.loa_id)"""


@query("q_psc_dim_clin_subtype", f"WITH {CLIN_SQL} SELECT * FROM clin_subtype")
def q_psc_dim_clin_subtype(t):
    """CLIN subtypes: line items scanned once, exploded into subtype pointers, paired with the
    five subtype tables in one tagged union and one equi-join; service charge and phase decoded."""
    return _build(t, "psc.dim_clin_subtype")


@query("q_psc_fact_clin_pricing", f"""WITH {SILVER_DIM_SQL}, {FACT_SQL}, {BILLING_SQL}, {SCS_FACT_SQL}, {CLIN_SQL}
SELECT * FROM clin_fact""")
def q_psc_fact_clin_pricing(t):
    """CLIN pricing: line x LOA x subtype with the LOA burn order (skew-safe ranking of each
    line's LOAs by first ledger row), plans by first non-NULL, actuals pre-aggregated."""
    return _build(t, "psc.fact_clin_pricing")


@query("q_tpp_invoice_line_report", """SELECT l_orderkey AS invoice_id,
       COUNT(DISTINCT l_orderkey * 100 + l_linenumber) AS n_lines
FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey
HAVING COUNT(DISTINCT l_orderkey * 100 + l_linenumber) > 1""")
def q_tpp_invoice_line_report(t):
    """Invoices whose items span more than one accepted line, counted on the raw items."""
    from gildhall.plans.domain.tpp_facts import invoice_line_report
    return invoice_line_report(derived_silver(t))


REVIEW_SQL = f"""s_review AS (
  SELECT o_orderkey AS id, o_custkey AS ia_id,
         CASE WHEN o_orderkey % 17 <> 0 THEN (o_custkey % 37) * 5 END AS reviewer_id,
         CAST(CAST(o_orderdate AS DATE) + 3 AS TIMESTAMP) AS review_dt,
         CASE WHEN o_orderkey % 3 = 0 THEN 'H' || CAST(o_orderkey AS VARCHAR) END AS attach_hash_id
  FROM orders WHERE o_orderstatus = 'F' AND NOT (o_orderkey % 101 = 0)),
s_users AS (
  SELECT user_id AS id, CASE WHEN user_id % 11 <> 0 THEN 'User' END AS first_name,
         CASE WHEN user_id % 2 = 0 THEN 'Q' ELSE ' ' END AS middle_initial, 'N' || CAST(user_id AS VARCHAR) AS last_name,
         CASE WHEN user_id % 5 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS reg_status,
         CASE WHEN user_id % 10 = 3 THEN TIMESTAMP '2001-01-01' END AS inactive_date
  FROM (SELECT DISTINCT user_id FROM events)),
reviewer AS (
  SELECT ROW_NUMBER() OVER (ORDER BY r.reviewer_user_id) AS reviewer_sk, r.reviewer_user_id,
         CASE WHEN u.first_name IS NOT NULL THEN concat_ws(' ', NULLIF(trim(u.first_name), ''),
              NULLIF(trim(u.middle_initial), ''), NULLIF(trim(u.last_name), '')) END AS reviewer_name,
         CAST(NULL AS VARCHAR) AS reviewer_role_cd, CAST(NULL AS VARCHAR) AS reviewer_org,
         CASE WHEN u.reg_status = 'ACTIVE' AND u.inactive_date IS NULL THEN TRUE
              WHEN u.id IS NULL THEN NULL ELSE FALSE END AS is_active_flag
  FROM (SELECT DISTINCT CAST(reviewer_id AS VARCHAR) AS reviewer_user_id FROM s_review
        WHERE reviewer_id IS NOT NULL) r
  LEFT JOIN s_users u ON CAST(u.id AS VARCHAR) = r.reviewer_user_id),
review_fact AS (
  SELECT COALESCE(gi.ia_sk, -1) AS ia_sk, COALESCE(rv.reviewer_sk, -1) AS reviewer_sk,
         COALESCE(iag.agency_sk, -1) AS agency_sk,
         CAST(strftime(r.review_dt, '%Y%m%d') AS INTEGER) AS review_date_sk, r.id AS source_ia_review_id,
         {FY("r.review_dt")} AS review_fiscal_year, CAST(NULL AS VARCHAR) AS review_type_cd,
         r.attach_hash_id IS NOT NULL AS has_attachment_flag, CAST(NULL AS BOOLEAN) AS review_completed_flag,
         CAST(NULL AS INTEGER) AS days_overdue
  FROM s_review r
  LEFT JOIN g_ia gi ON gi.ia_id = r.ia_id
  LEFT JOIN reviewer rv ON rv.reviewer_user_id = CAST(r.reviewer_id AS VARCHAR)
  LEFT JOIN ia_agency iag ON iag.ia_id = r.ia_id)"""


@query("q_iat_dim_reviewer", f"WITH {REVIEW_SQL} SELECT * FROM reviewer")
def q_iat_dim_reviewer(t):
    """Reviewers named on IA reviews, joined to their user records (name, active flag)."""
    return _build(t, "iat.dim_reviewer")


@query("q_iat_fact_ia_review", f"WITH {SILVER_DIM_SQL}, {FACT_SQL}, {AMEND_SQL}, {REVIEW_SQL} SELECT * FROM review_fact")
def q_iat_fact_ia_review(t):
    """IA review fact: IA, reviewer and servicing agency keys, review date key and fiscal year."""
    return _build(t, "iat.fact_ia_review")


def _like_any_sql(c: str, patterns) -> str:
    return "COALESCE(" + " OR ".join(f"upper(trim({c})) LIKE '{p}'" for p in patterns) + ", FALSE)"


def _first_sql(c: str, table) -> str:
    return "CASE " + " ".join(f"WHEN {_like_any_sql(c, pats)} THEN '{label}'" for label, pats in table) + " END"


def _code_dim_sql(codes_sql: str, code: str, desc: str, extra: dict, sk: str) -> str:
    cols = "".join(f", {expr} AS {name}" for name, expr in extra.items())
    return (f"SELECT cd AS {code}, 'Code ' || cd AS {desc}{cols}, ROW_NUMBER() OVER (ORDER BY cd) AS {sk} "
            f"FROM (SELECT DISTINCT cd FROM ({codes_sql}) WHERE cd IS NOT NULL)")


def _lookup_sql():
    from gildhall.plans.domain import lookups as L
    ev = _code_dim_sql("SELECT upper(event_type) AS cd FROM events UNION ALL SELECT 'COLLABORATION' FROM conversations",
                       "event_type_cd", "event_type_desc", {
                           "lifecycle_phase_cd": _first_sql("cd", L.EVENT_PHASE),
                           "is_system_event_flag": _like_any_sql("cd", L.EVENT_SYSTEM),
                           "is_audit_significant": _like_any_sql("cd", L.EVENT_AUDIT)}, "event_type_sk")
    am = _code_dim_sql("SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'COST_INCREASE' WHEN '2-HIGH' THEN "
                       "'EXTEND_POP' WHEN '3-MEDIUM' THEN 'SCOPE_CHANGE' ELSE 'ADMIN' END AS cd FROM orders",
                       "amend_action_cd", "amend_action_desc", {
                           "changes_scope_flag": _like_any_sql("cd", L.AMEND_SCOPE),
                           "changes_cost_flag": _like_any_sql("cd", L.AMEND_COST),
                           "changes_period_flag": _like_any_sql("cd", L.AMEND_PERIOD)}, "amend_action_sk")
    actual = ", ".join(f"'{c}'" for c in L.ACTUAL_RATE_CODES)
    cr = _code_dim_sql("SELECT CASE l_orderkey % 3 WHEN 0 THEN 'ACT' WHEN 1 THEN 'EST' END AS cd FROM lineitem "
                       "WHERE l_linenumber = 1", "cost_rate_type_cd", "cost_rate_type_desc", {
                           "is_actual_flag": f"COALESCE(upper(trim(cd)) IN ({actual}), FALSE)"}, "cost_rate_type_sk")
    return ev, am, cr


_EV_SQL, _AM_SQL, _CR_SQL = _lookup_sql()


@query("q_cat_dim_event_type", _EV_SQL)
def q_cat_dim_event_type(t):
    """Event types of all events (plus collaborations) with lifecycle phase and flags from the pattern rules."""
    return _build(t, "cat.dim_event_type")


@query("q_iat_dim_amend_action", _AM_SQL)
def q_iat_dim_amend_action(t):
    """IA amendment actions with scope / cost / period flags from the pattern rules."""
    return _build(t, "iat.dim_amend_action")


@query("q_psc_dim_cost_rate_type", _CR_SQL)
def q_psc_dim_cost_rate_type(t):
    """Cost rate types of the labour plans with the actual-rate flag."""
    return _build(t, "psc.dim_cost_rate_type")


PIID_SQL = (f"CASE WHEN o.o_orderkey % 10 = 0 THEN '47QA' || CAST(o.o_orderkey AS VARCHAR) "
            f"ELSE '47QA' || {_pad('o.o_orderkey', 9)} END")


def _nb(x: str) -> str:
    """blank → NULL, as the library's blank_to_null."""
    return f"NULLIF(trim({x}), '')"


DP1_DIMS_SQL = f"""d_loa_src AS (
  SELECT s_suppkey AS loa_id, s_suppkey + 1000 AS tracking_num, 'L' || CAST(s_suppkey % 3 AS VARCHAR) AS loa_status_cd,
         'AG-' || CAST(s_suppkey % 17 AS VARCHAR) AS agreement_number,
         CAST(CAST(s_suppkey % 9 AS INTEGER) AS VARCHAR) AS agreement_line_num,
         {_pad('s_nationkey % 5', 2)} || {_pad('s_nationkey', 2)} AS req,
         CASE WHEN s_suppkey % 2 = 0 THEN 'X' END AS avail, {_pad('s_suppkey % 100', 4)} AS appropriation,
         CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '001' END AS sub_account,
         'F' || CAST(s_suppkey % 4 AS VARCHAR) AS fund_cd, s_name AS org_code
  FROM supplier WHERE NOT (s_suppkey % 50 = 49)),
d_loa AS (
  SELECT ROW_NUMBER() OVER (ORDER BY l.loa_id) AS loa_sk, l.loa_id, l.tracking_num, l.loa_status_cd,
         'Code ' || l.loa_status_cd AS loa_status_desc, l.agreement_number, l.agreement_line_num,
         NULLIF(concat_ws('-', {_nb("'047'")}, {_nb('l.req')},
                          {_nb("COALESCE(l.avail, '') || COALESCE(l.appropriation, '')")}, {_nb('l.sub_account')}), '')
           AS treasury_account_symbol,
         l.fund_cd, 'T1' AS fund_type_cd, CAST(NULL AS VARCHAR) AS object_class_cd,
         CAST(NULL AS VARCHAR) AS program_activity_cd, CAST(NULL AS VARCHAR) AS budget_activity_cd, l.org_code,
         CAST(NULL AS VARCHAR) AS cost_center, CAST(NULL AS VARCHAR) AS project_code, 2000 AS bbfy, 2002 AS ebfy,
         CAST(NULL AS TIMESTAMP) AS agreement_end_dt, CAST(NULL AS TIMESTAMP) AS transmitted_dt, a.agency_sk,
         {SCD_COLS_SQL}
  FROM d_loa_src l
  LEFT JOIN (SELECT agency_code, MIN(agency_sk) AS agency_sk FROM g_agency GROUP BY 1) a
         ON a.agency_code = substr(l.req, 1, 2)),
d_award AS (
  SELECT ROW_NUMBER() OVER (ORDER BY o.o_orderkey) AS award_sk, o.o_orderkey AS award_id,
         {PIID_SQL} AS award_piid, 'P01' AS award_mod_num, o.o_orderkey * 10 + 1 AS award_mod_id,
         o.o_orderpriority AS fin_code, o.o_orderstatus AS award_status_cd,
         COALESCE(o.o_orderstatus, 'UNKNOWN') AS award_status_desc, CAST(NULL AS VARCHAR) AS contract_type_cd,
         CAST(NULL AS VARCHAR) AS contract_type_desc, CAST(NULL AS VARCHAR) AS vehicle_type_cd,
         CAST(NULL AS VARCHAR) AS vehicle_type_desc, COALESCE(gi.ia_sk, -1) AS ia_sk, COALESCE(ga.agency_sk, -1) AS agency_sk,
         o.o_orderdate + INTERVAL 30 DAY AS award_start_dt, CAST(NULL AS TIMESTAMP) AS award_end_dt,
         o.o_orderdate AS base_award_dt, o.o_orderdate + INTERVAL 31 DAY AS last_mod_dt, 2 AS total_mods_count,
         {SCD_COLS_SQL}
  FROM orders o
  LEFT JOIN g_ia gi ON gi.ia_id = o.o_custkey
  LEFT JOIN g_agency ga ON ga.activity_address_cd = 'AAC' || {_pad('o.o_custkey % 25', 3)}),
d_funded AS (SELECT o_custkey AS funding_id, SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS amt FROM orders GROUP BY 1),
d_funding AS (
  SELECT ROW_NUMBER() OVER (ORDER BY c.c_custkey) AS funding_sk, c.c_custkey AS funding_id,
         c.c_custkey * 10 AS funding_amendment_id, 'FS' || CAST(c.c_custkey % 3 AS VARCHAR) AS fund_status_cd,
         'Code FS' || CAST(c.c_custkey % 3 AS VARCHAR) AS fund_status_desc,
         upper(substr(c.c_mktsegment, 1, 2)) AS fund_category_cd, 'Code ' || upper(substr(c.c_mktsegment, 1, 2)) AS fund_category_desc,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'DIRECT' ELSE 'REIMB' END AS billing_type_cd,
         'Code ' || CASE WHEN c.c_custkey % 2 = 0 THEN 'DIRECT' ELSE 'REIMB' END AS billing_type_desc,
         CAST(NULL AS VARCHAR) AS fund_type_cd, CAST(NULL AS VARCHAR) AS fund_type_desc,
         COALESCE(gi.ia_sk, -1) AS ia_sk, COALESCE(gi.servicing_agency_sk, -1) AS agency_sk,
         CAST(COALESCE(f.amt, 0) AS DECIMAL(15,2)) AS total_funded_amt, CAST(NULL AS INTEGER) AS fiscal_year,
         {SCD_COLS_SQL}
  FROM customer c
  LEFT JOIN g_ia gi ON gi.ia_id = c.c_custkey
  LEFT JOIN d_funded f ON f.funding_id = c.c_custkey),
d_lines AS (SELECT l_orderkey, l_linenumber, l_orderkey * 100 + l_linenumber AS lia, MIN(l_partkey) AS part,
                   SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS total, MIN(l_shipdate) AS start_dt,
                   MAX(l_shipdate) AS end_dt, MIN(l_linestatus) AS status
            FROM lineitem GROUP BY l_orderkey, l_linenumber),
d_line_item AS (
  SELECT ROW_NUMBER() OVER (ORDER BY l.lia) AS line_item_sk, l.lia AS line_item_id, l.lia AS line_item_accepted_id,
         'T' || CAST(l.lia AS VARCHAR) AS li_tracking_num, COALESCE(ga.award_sk, -1) AS award_sk,
         {_pad('l.l_linenumber', 4)} || 'AA' AS clin_num, 'AA' AS slin_num, l.status AS line_item_type_cd,
         CASE WHEN l.status = 'F' THEN 'Fulfilled' ELSE l.status END AS line_item_type_desc,
         p.p_brand AS psc_cd, CAST(NULL AS VARCHAR) AS unit_of_measure_cd, p.p_type AS contract_type_cd,
         CAST(NULL AS VARCHAR) AS severability_type_cd, l.start_dt AS li_pop_start_dt, l.end_dt AS li_pop_end_dt,
         CAST(l.total AS DECIMAL(15,2)) AS obligated_ceiling_amt, l.l_linenumber % 2 = 0 AS exercise_this_yn,
         CAST(NULL AS INTEGER) AS bona_fide_need_fy, CAST(year(l.end_dt) AS INTEGER) AS budget_fy,
         {SCD_COLS_SQL}
  FROM d_lines l
  LEFT JOIN g_award ga ON ga.award_id = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.part)"""


_DIMS_WITH = f"WITH {SILVER_DIM_SQL}, {FACT_SQL}, {DP1_DIMS_SQL}"


@query("q_dp1_dim_loa", f"{_DIMS_WITH} SELECT * FROM d_loa")
def q_dp1_dim_loa(t):
    """LOA dimension: composed treasury symbol (blank parts skipped), status decode, agency by the
    2-character prefix through a lookup made unique first (no fan-out)."""
    return _build(t, "common.dim_loa")


@query("q_dp1_dim_award", f"{_DIMS_WITH} SELECT * FROM d_award")
def q_dp1_dim_award(t):
    """Award dimension: latest modification, base award date, IA through the bridge (smallest, D-7)."""
    return _build(t, "common.dim_award")


@query("q_dp1_dim_funding", f"{_DIMS_WITH} SELECT * FROM d_funding")
def q_dp1_dim_funding(t):
    """Funding dimension: three decodes, IA key and its servicing agency from one lookup, funded total."""
    return _build(t, "common.dim_funding")


@query("q_dp1_dim_line_item", f"{_DIMS_WITH} SELECT * FROM d_line_item")
def q_dp1_dim_line_item(t):
    """Line item dimension: latest accepted version, award key, type decode, deliverable attributes."""
    return _build(t, "common.dim_line_item")


WPR_SMI_SQL = f"""d_user AS (
  SELECT ROW_NUMBER() OVER (ORDER BY CAST(user_id AS VARCHAR)) AS user_sk, CAST(user_id AS VARCHAR) AS user_id,
         first_name, last_name,
         concat_ws(' ', {_nb('first_name')}, {_nb('middle_initial')}, {_nb('last_name')}) AS full_name, email,
         CASE WHEN {_nb('phone_ext')} IS NOT NULL THEN phone || ' x' || trim(phone_ext) ELSE phone END AS phone,
         CAST(NULL AS VARCHAR) AS org_code, CAST(NULL AS VARCHAR) AS org_name, CAST(NULL AS VARCHAR) AS region_cd,
         reg_status = 'ACTIVE' AND inactive_date IS NULL AS is_active_flag, okta AS procurement_system_id,
         COALESCE(activation_date, creation_date, TIMESTAMP '{AS_OF}') AS eff_start_dt,
         CAST(NULL AS TIMESTAMP) AS eff_end_dt, TRUE AS is_current_flag
  FROM (SELECT user_id, CASE WHEN user_id % 11 <> 0 THEN 'User' END AS first_name,
               CASE WHEN user_id % 2 = 0 THEN 'Q' ELSE ' ' END AS middle_initial,
               'N' || CAST(user_id AS VARCHAR) AS last_name,
               CASE WHEN user_id % 5 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS reg_status,
               CASE WHEN user_id % 10 = 3 THEN TIMESTAMP '2001-01-01' END AS inactive_date,
               CASE WHEN user_id % 7 <> 0 THEN 'user' || CAST(user_id AS VARCHAR) || '@agency.gov' END AS email,
               '555-' || {_pad('user_id', 4)} AS phone,
               CASE WHEN user_id % 3 = 0 THEN ' 12 ' WHEN user_id % 3 = 1 THEN '' END AS phone_ext,
               'OK' || CAST(user_id AS VARCHAR) AS okta,
               CASE WHEN user_id % 4 <> 0 THEN CAST(DATE '2020-01-01' + CAST(user_id AS INTEGER) AS TIMESTAMP) END
                 AS activation_date,
               CAST(DATE '2019-01-01' + CAST(user_id AS INTEGER) AS TIMESTAMP) AS creation_date,
               CASE WHEN user_id % 13 = 0 THEN ' y ' WHEN user_id % 13 = 1 THEN 'N' END AS delete_flag
        FROM (SELECT DISTINCT user_id FROM events))
  WHERE delete_flag IS NULL OR upper(trim(delete_flag)) <> 'Y'),
d_piid AS (
  SELECT ROW_NUMBER() OVER (ORDER BY o.o_orderkey) AS piid_sk, o.o_orderkey AS piid_id, {PIID_SQL} AS piid_value,
         {PIID_SQL} AS base_piid, CASE WHEN o.o_orderkey % 6 <> 0 THEN 'P0001' END AS piid_ext,
         CASE WHEN length(trim({PIID_SQL})) >= 13 THEN substr(trim({PIID_SQL}), 1, 6) END AS aac,
         CASE WHEN length(trim({PIID_SQL})) >= 13 THEN substr(trim({PIID_SQL}), 9, 1) END AS instrument_type_cd,
         CASE WHEN length(trim({PIID_SQL})) >= 13 THEN substr(trim({PIID_SQL}), 10, 4) END AS sequence_num,
         CASE WHEN length(trim({PIID_SQL})) >= 13 AND regexp_matches(substr(trim({PIID_SQL}), 7, 2), '^[0-9]{{2}}$')
              THEN CAST(substr(trim({PIID_SQL}), 7, 2) AS INTEGER) + 2000 END AS piid_fiscal_year
  FROM orders o)"""


@query("q_wpr_dim_user", f"WITH {WPR_SMI_SQL} SELECT * FROM d_user")
def q_wpr_dim_user(t):
    """User dimension: character delete flag, composed name and phone, version starts at activation."""
    return _build(t, "wpr.dim_user")


@query("q_smi_dim_piid", f"WITH {WPR_SMI_SQL} SELECT * FROM d_piid")
def q_smi_dim_piid(t):
    """PIID dimension: positional parts of full-length PIIDs, extension of the latest modification."""
    return _build(t, "smi.dim_piid")


ACQ_SQL = f"""a_src AS (
  SELECT o_orderkey AS acquisition_id, 'AAC' || {_pad('o_custkey % 25', 3)} AS aac,
         CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'AWARDED' END AS status_cd,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'NEW' ELSE 'FOLLOW_ON' END AS type_cd,
         'PT' || CAST(o_orderkey % 3 AS VARCHAR) AS performance_type_cd
  FROM orders),
a_plan AS (
  SELECT * FROM (
    SELECT l_orderkey AS acquisition_id, end_dt AS created_dt, 'CT' || CAST(l_linenumber AS VARCHAR) AS contract_type_cd,
           CASE l_linenumber % 3 WHEN 0 THEN 'FULL' WHEN 1 THEN 'SOLE' ELSE 'LIMITED' END AS competition_type_cd,
           CASE WHEN part % 2 = 0 THEN 'COMM' ELSE 'NONCOMM' END AS commercial_type_cd,
           CASE WHEN status = 'F' THEN 'STD' ELSE 'FAST' END AS processing_speed_cd,
           CASE WHEN l_linenumber = 1 THEN 'EXP' END AS expedited_type_cd,
           CASE WHEN part % 5 = 0 THEN 'Y' ELSE 'N' END AS emergency_acq_cd,
           'COR' || CAST(part % 3 AS VARCHAR) AS cor_delegation_cd,
           CASE WHEN part % 7 = 0 THEN 'HIGH' END AS supply_chain_risk_cd,
           'S' || CAST(l_linenumber % 4 AS VARCHAR) AS surveillance_spec_cd,
           CASE WHEN l_orderkey % 9 = 0 THEN 'IC' END AS intel_community_cd,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY end_dt DESC NULLS LAST,
                              'CT' || CAST(l_linenumber AS VARCHAR) ASC NULLS LAST) AS rn
    FROM d_lines WHERE l_linenumber <> 7) WHERE rn = 1),
a_ia AS (SELECT o_orderkey - o_orderkey % 4 AS acquisition_id, MIN(o_custkey) AS ia_id FROM orders GROUP BY 1),
d_acquisition AS (
  SELECT ROW_NUMBER() OVER (ORDER BY a.acquisition_id) AS acquisition_sk, a.acquisition_id,
         a.status_cd AS acquisition_status_cd,
         CASE WHEN a.status_cd = 'AWARDED' THEN a.status_cd ELSE 'Code ' || a.status_cd END AS acquisition_status_desc,
         a.type_cd AS acquisition_type_cd, 'Code ' || a.type_cd AS acquisition_type_desc,
         p.competition_type_cd,
         CASE WHEN p.competition_type_cd IN ('FULL', 'SOLE') THEN 'Code ' || p.competition_type_cd
              ELSE p.competition_type_cd END AS competition_type_desc,
         p.commercial_type_cd, p.processing_speed_cd, p.expedited_type_cd, p.emergency_acq_cd, p.cor_delegation_cd,
         p.contract_type_cd AS consolidated_contract_cd, p.supply_chain_risk_cd, p.surveillance_spec_cd,
         p.intel_community_cd, CAST(NULL AS DECIMAL(15,2)) AS igce_amt, CAST(NULL AS VARCHAR) AS igce_source,
         a.performance_type_cd, COALESCE(gi.ia_sk, -1) AS ia_sk, COALESCE(ga.agency_sk, -1) AS agency_sk,
         p.created_dt, {SCD_COLS_SQL}
  FROM a_src a
  LEFT JOIN a_plan p ON p.acquisition_id = a.acquisition_id
  LEFT JOIN a_ia ai ON ai.acquisition_id = a.acquisition_id
  LEFT JOIN g_ia gi ON gi.ia_id = ai.ia_id
  LEFT JOIN g_agency ga ON ga.activity_address_cd = a.aac)"""


@query("q_alt_dim_acquisition", f"{_DIMS_WITH}, {ACQ_SQL} SELECT * FROM d_acquisition")
def q_alt_dim_acquisition(t):
    """Acquisition dimension: latest live plan per acquisition (keep-one), three decodes, IA as the
    smallest over the acquisition's awards (D-18), agency by address code."""
    return _build(t, "alt.dim_acquisition")


SOL_SQL = f"""s_sol AS (
  SELECT o_orderkey AS solicit_id, o_orderkey AS acquisition_id, CAST(o_orderkey % 6 AS INTEGER) AS bid_cnt,
         'SOL_' || o_orderstatus AS sol_status_cd,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'Solicitation ' || CAST(o_orderkey AS VARCHAR) END AS descr,
         'AAC' || {_pad('o_custkey % 26', 3)} AS aac
  FROM orders WHERE o_orderkey % 2 = 0),
s_amend AS (
  SELECT lia AS id, l_orderkey AS solicit_id, start_dt AS created_dt,
         CASE WHEN l_linenumber <> 2 THEN end_dt END AS close_dt,
         CASE l_linenumber % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'LIMITED' ELSE 'UNKNOWN' END AS posting_cd
  FROM d_lines WHERE l_linenumber <> 6),
s_amend_latest AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY solicit_id ORDER BY created_dt DESC NULLS LAST, id DESC) AS rn
                 FROM s_amend) WHERE rn = 1),
s_resp AS (
  SELECT l_orderkey AS solicit_id, COUNT(*) AS n,
         MAX(CASE WHEN status = 'F' AND l_linenumber = 1 THEN lia END) AS winner
  FROM d_lines GROUP BY 1),
d_solicitation AS (
  SELECT ROW_NUMBER() OVER (ORDER BY s.solicit_id) AS solicitation_sk, s.solicit_id,
         CAST(s.bid_cnt AS VARCHAR) AS solicit_num, s.sol_status_cd, COALESCE(s.descr, s.sol_status_cd) AS sol_status_desc,
         la.posting_cd AS sol_posting_type_cd,
         CASE WHEN la.posting_cd IN ('OPEN', 'LIMITED') THEN 'Code ' || la.posting_cd ELSE la.posting_cd END
           AS sol_posting_type_desc,
         la.created_dt AS open_dt, la.close_dt,
         COALESCE(an.n, 0) AS total_amendments,
         COALESCE(r.n, 0) AS total_responses, r.winner AS winning_response_id,
         COALESCE(acq.acquisition_sk, -1) AS acquisition_sk, COALESCE(ga.agency_sk, -1) AS agency_sk
  FROM s_sol s
  LEFT JOIN s_amend_latest la ON la.solicit_id = s.solicit_id
  LEFT JOIN (SELECT solicit_id, COUNT(*) AS n FROM s_amend GROUP BY 1) an ON an.solicit_id = s.solicit_id
  LEFT JOIN s_resp r ON r.solicit_id = s.solicit_id
  LEFT JOIN d_acquisition acq ON acq.acquisition_id = s.acquisition_id
  LEFT JOIN g_agency ga ON ga.activity_address_cd = s.aac)"""


@query("q_alt_dim_solicitation", f"{_DIMS_WITH}, {ACQ_SQL}, {SOL_SQL} SELECT * FROM d_solicitation")
def q_alt_dim_solicitation(t):
    """Solicitation dimension: amendment and response counts aggregated before the join, latest
    amendment by keep-one, posting decode, acquisition and agency keys."""
    return _build(t, "alt.dim_solicitation")


def _contractor_sql():
    from gildhall.plans.domain.alt_fre import BUSINESS_FLAGS, COMPLETION_CODES
    flags = "".join(f", {_like_any_sql("COALESCE(c.business_type_cd, '')", pats)} AS {name}"
                    for name, pats in BUSINESS_FLAGS.items())
    done = ", ".join(f"'{c}'" for c in COMPLETION_CODES)
    return f"""c_co AS (
  SELECT o_orderkey AS id, 'UEI' || CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderkey % 5 = 0 THEN 'B' ELSE '' END AS uei,
         {_pad('o_custkey', 9)} AS duns, 'Company ' || CAST(o_custkey AS VARCHAR) AS company_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'SMALL_BUSINESS' WHEN '2-HIGH' THEN 'WOMEN_OWNED_SMALL_BUSINESS'
              WHEN '3-MEDIUM' THEN 'HUBZONE' WHEN '4-NOT SPECIFIED' THEN 'SERVICE_DISABLED_VETERAN_OWNED' END
           AS business_type_cd,
         o_custkey % 100 AS ipartner_id
  FROM orders),
c_ip AS (
  SELECT s_suppkey AS ipartner_id, 'C' || {_pad('s_suppkey', 4)} AS cage, 'P' || CAST(s_nationkey AS VARCHAR) AS puei,
         s_name AS pname, 'City' || CAST(s_nationkey AS VARCHAR) AS city, 'S' || CAST(s_suppkey % 50 AS VARCHAR) AS st,
         {_pad('s_suppkey', 5)} AS zip FROM supplier),
d_contractor AS (
  SELECT ROW_NUMBER() OVER (ORDER BY c.id) AS contractor_sk, c.id AS award_mod_company_id, c.uei, c.duns AS duns_num,
         ip.cage AS cage_code, c.company_name, CAST(NULL AS VARCHAR) AS dba_name, ip.puei AS parent_uei,
         ip.pname AS parent_company_name, c.business_type_cd{flags}, ip.city, ip.st AS state_cd,
         CASE WHEN ip.ipartner_id IS NOT NULL THEN 'US' END AS country_cd, ip.zip AS zip_code,
         CAST(NULL AS VARCHAR) AS congressional_district, {SCD_COLS_SQL}
  FROM c_co c LEFT JOIN c_ip ip ON ip.ipartner_id = c.ipartner_id),
c_close AS (
  SELECT o_orderkey AS acquisition_id, CAST(CAST(o_orderdate AS DATE) + 100 AS TIMESTAMP) AS co_cert_dt,
         CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 120 AS TIMESTAMP) END AS fma_cert_dt,
         CASE o_orderkey % 3 WHEN 0 THEN 'y' WHEN 1 THEN 'N' END AS reconciled,
         CASE WHEN o_orderkey % 4 = 0 THEN CAST(0 AS DECIMAL(15,2)) ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS ytd,
         CASE WHEN o_orderkey % 7 = 0 THEN 'P1' END AS prohibition_cd
  FROM orders WHERE o_orderstatus = 'F'),
c_check AS (
  SELECT l_orderkey AS id, COUNT(*) AS total,
         COUNT(*) FILTER (WHERE upper(COALESCE(CASE WHEN l_linenumber = 3 THEN NULL WHEN status = 'F' THEN 'yes'
                                                    ELSE 'no' END, '')) IN ({done})) AS done
  FROM d_lines WHERE l_linenumber <> 5 GROUP BY 1),
d_closeout AS (
  SELECT ROW_NUMBER() OVER (ORDER BY c.acquisition_id) AS closeout_sk, c.acquisition_id, c.co_cert_dt, c.fma_cert_dt,
         CAST(NULL AS TIMESTAMP) AS client_cert_dt, CAST(NULL AS TIMESTAMP) AS final_invoice_dt,
         CAST(NULL AS TIMESTAMP) AS closeout_complete_dt, COALESCE(k.total, 0) AS checklist_total_items,
         COALESCE(k.done, 0) AS checklist_complete_items,
         COALESCE(CAST(round(CAST(100.0 AS DOUBLE) * k.done / NULLIF(k.total, 0), 2) AS DECIMAL(5,2)),
                  CAST(0 AS DECIMAL(5,2))) AS checklist_completion_pct,
         upper(COALESCE(c.reconciled, 'N')) = 'N' AS has_open_udo_flag, COALESCE(c.ytd, 0) > 0 AS has_open_invoice_flag,
         c.prohibition_cd AS closeout_prohibition_cds
  FROM c_close c LEFT JOIN c_check k ON k.id = c.acquisition_id)"""


CONTRACTOR_SQL = _contractor_sql()


@query("q_alt_dim_contractor", f"{_DIMS_WITH}, {CONTRACTOR_SQL} SELECT * FROM d_contractor")
def q_alt_dim_contractor(t):
    """Contractor dimension: latest ingestion per company (keep-one, D-12), latest partner record,
    socio-economic flags from the business type patterns."""
    return _build(t, "alt.dim_contractor")


@query("q_alt_dim_closeout", f"{_DIMS_WITH}, {CONTRACTOR_SQL} SELECT * FROM d_closeout")
def q_alt_dim_closeout(t):
    """Closeout dimension: checklist counts and completion percentage aggregated before the join."""
    return _build(t, "alt.dim_closeout")


def _lifecycle_phase_sql(c: str, i: int) -> str:
    from gildhall.plans.domain.alt_facts import DEFAULT_PHASE, PHASES
    cond = " ".join(f"WHEN {_like_any_sql(c, pats)} THEN '{labels[i]}'" for labels, pats in PHASES)
    return f"CASE {cond} ELSE '{DEFAULT_PHASE[i]}' END"


def _award_lifecycle_sql():
    from gildhall.plans.domain.alt_facts import CLOSED_INVOICE_STATUSES
    closed = ", ".join(f"'{c}'" for c in CLOSED_INVOICE_STATUSES)
    st = "COALESCE(upper(acq.acquisition_status_cd), '')"
    return f"""al_acq AS (
  SELECT o_orderkey - o_orderkey % 4 AS acquisition_id, 2 * COUNT(*) AS mods_count,
         MAX(o_orderdate + INTERVAL 30 DAY) AS last_mod_signed, MIN(o_orderkey) AS company_id
  FROM orders GROUP BY 1),
al_inv AS (
  SELECT i.lia, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE NOT (CASE o.o_orderstatus WHEN 'F' THEN 'ACCEPTED' WHEN 'O' THEN 'SUBMITTED'
                                     ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'REJECTED' END END) IN ({closed})) AS pending
  FROM (SELECT DISTINCT lia, l_orderkey FROM s_lineitem_ids WHERE l_returnflag = 'A') i
  JOIN orders o ON o.o_orderkey = i.l_orderkey GROUP BY 1),
al_accepted AS (SELECT lia, SUM({DMUL("l_extendedprice", "0.9")}) AS amt FROM s_lineitem_ids
                WHERE l_linestatus = 'F' GROUP BY 1),
al_sol AS (SELECT acquisition_sk, MIN(solicitation_sk) AS solicitation_sk FROM d_solicitation GROUP BY 1),
award_lifecycle AS (
  SELECT COALESCE(li.line_item_sk, -1) AS line_item_sk, COALESCE(aw.award_sk, -1) AS award_sk,
         COALESCE(acq.acquisition_sk, -1) AS acquisition_sk, so.solicitation_sk, ct.contractor_sk, co.closeout_sk,
         COALESCE(gi.ia_sk, -1) AS ia_sk, COALESCE(acq.agency_sk, -1) AS agency_sk,
         CAST(strftime(aw.award_start_dt, '%Y%m%d') AS INTEGER) AS award_date_sk,
         CAST(strftime(pa.last_mod_signed, '%Y%m%d') AS INTEGER) AS last_mod_date_sk,
         {_lifecycle_phase_sql(st, 0)} AS current_proc_phase_cd, {_lifecycle_phase_sql(st, 1)} AS current_proc_phase_desc,
         date_diff('day', CAST(acq.created_dt AS DATE), CAST(aw.award_start_dt AS DATE)) AS days_in_pre_award,
         date_diff('day', CAST(pa.last_mod_signed AS DATE), DATE '{AS_OF}') AS days_since_last_mod,
         date_diff('day', DATE '{AS_OF}', CAST(li.li_pop_end_dt AS DATE)) AS days_to_pop_end,
         CAST(COALESCE(pa.mods_count, 0) AS INTEGER) AS mods_count,
         CAST(COALESCE(inv.n, 0) AS INTEGER) AS total_invoices_count,
         CAST(COALESCE(inv.pending, 0) AS INTEGER) AS pending_invoices_count,
         CAST(0 AS DECIMAL(15,2)) AS base_award_amt,
         CAST(COALESCE(li.obligated_ceiling_amt, 0) AS DECIMAL(15,2)) AS current_obligated_amt,
         CAST(COALESCE(ac.amt, 0) AS DECIMAL(15,2)) AS current_accepted_amt,
         CAST(greatest(COALESCE(li.obligated_ceiling_amt, 0) - COALESCE(ac.amt, 0), 0) AS DECIMAL(15,2)) AS current_udo_amt,
         CAST(CASE WHEN l.l_linenumber = 6 THEN {DMUL("l.total", "0.1")} ELSE {DMUL("l.total", "0.2")} END
              AS DECIMAL(15,2)) AS accrual_holdback_amt
  FROM d_lines l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN al_acq pa ON pa.acquisition_id = l.l_orderkey - l.l_orderkey % 4
  LEFT JOIN al_inv inv ON inv.lia = l.lia
  LEFT JOIN al_accepted ac ON ac.lia = l.lia
  LEFT JOIN d_line_item li ON li.line_item_accepted_id = l.lia
  LEFT JOIN d_award aw ON aw.award_mod_id = l.l_orderkey * 10 + 1
  LEFT JOIN d_acquisition acq ON acq.acquisition_id = l.l_orderkey - l.l_orderkey % 4
  LEFT JOIN al_sol so ON so.acquisition_sk = acq.acquisition_sk
  LEFT JOIN d_closeout co ON co.acquisition_id = l.l_orderkey - l.l_orderkey % 4
  LEFT JOIN d_contractor ct ON ct.award_mod_company_id = pa.company_id
  LEFT JOIN g_ia gi ON gi.ia_id = o.o_custkey)"""


@query("q_alt_fact_award_lifecycle", f"""{_DIMS_WITH}, {ACQ_SQL}, {SOL_SQL}, {CONTRACTOR_SQL}, {_award_lifecycle_sql()}
SELECT * FROM award_lifecycle""")
def q_alt_fact_award_lifecycle(t):
    """Award lifecycle fact, one row per accepted line: modifications per acquisition, invoices
    through the line's invoice items (D-10), latest accrual by keep-one, IA through the bridge
    (D-18), contractor and solicitation reduced to one before joining, seven dimension keys."""
    return _build(t, "alt.fact_award_lifecycle")


def _fre_sql():
    from gildhall.plans.domain.alt_fre import SERVICE_PSC_PATTERNS
    service = _like_any_sql("COALESCE(psc_type, '')", SERVICE_PSC_PATTERNS)
    return f"""d_fpds_contractor AS (
  SELECT ROW_NUMBER() OVER (ORDER BY award_mod_company_id, eff_start_dt) AS fpds_contractor_sk, award_mod_company_id,
         uei, duns_num, cage_code, company_name, parent_uei, parent_company_name, business_type_cd AS bus_type_cd, city,
         state_cd, country_cd, congressional_district, eff_start_dt, eff_end_dt, is_current_flag,
         CAST(NULL AS VARCHAR) AS sba_program_cd
  FROM d_contractor),
f_psc AS (
  SELECT p_brand AS psc_code, CASE WHEN right(p_brand, 1) = '1' THEN '  ' ELSE 'Full ' || p_brand END AS psc_full_name,
         ' ' || MIN(p_type) AS psc_name,
         CASE WHEN right(p_brand, 1) IN ('1', '3', '5') THEN 'SERVICE' WHEN right(p_brand, 1) = '2' THEN 'R&D'
              ELSE 'PRODUCT' END AS psc_type,
         'L1 ' || MAX(p_type) AS l1, 'L2 size ' || CAST(MAX(p_size) AS VARCHAR) AS l2, substr(p_brand, 1, 7) AS parent
  FROM part GROUP BY p_brand),
d_fpds_psc AS (
  SELECT ROW_NUMBER() OVER (ORDER BY psc_code) AS psc_sk, psc_code AS psc_cd,
         COALESCE({_nb('psc_full_name')}, {_nb('psc_name')}) AS psc_description, psc_type AS psc_category,
         CASE WHEN NOT {service} THEN l1 END AS supply_category, CASE WHEN {service} THEN l2 END AS service_category,
         parent AS naics_crosswalk
  FROM f_psc)"""


FRE_SQL = _fre_sql()


@query("q_fre_dim_fpds_contractor", f"{_DIMS_WITH}, {CONTRACTOR_SQL}, {FRE_SQL} SELECT * FROM d_fpds_contractor")
def q_fre_dim_fpds_contractor(t):
    """FPDS contractor: the contractor dimension extended by a left join on its key (row count kept)."""
    return _build(t, "fre.dim_fpds_contractor")


@query("q_fre_dim_fpds_psc", f"{_DIMS_WITH}, {CONTRACTOR_SQL}, {FRE_SQL} SELECT * FROM d_fpds_psc")
def q_fre_dim_fpds_psc(t):
    """FPDS product / service codes: first non-blank description, supply or service category by type pattern."""
    return _build(t, "fre.dim_fpds_psc")


def _fpds_txn_sql():
    from gildhall.plans.domain.fre_facts import BASE_MOD_NUMS, TERMINATION_PATTERN, TERMINATION_REASON
    base = ", ".join(f"'{c}'" for c in BASE_MOD_NUMS)
    return f"""fr_mods AS (
  SELECT o_orderkey * 10 AS id, o_orderkey AS award_id, '0' AS mod_num, o_orderdate AS co_signature_dt,
         CAST(NULL AS VARCHAR) AS sf30, CAST(NULL AS VARCHAR) AS reason, 'DRAFT' AS car FROM orders
  UNION ALL
  SELECT o_orderkey * 10 + 1, o_orderkey, 'P01', o_orderdate + INTERVAL 31 DAY,
         CASE o_orderkey % 7 WHEN 0 THEN 'TERMINATE' WHEN 1 THEN 'ADMIN' ELSE 'FUNDING' END,
         CASE WHEN o_orderkey % 11 = 0 THEN 'd' ELSE 'A' END, 'FINAL' FROM orders),
fr_led AS (
  SELECT (sl.line_item_accepted_id // 100) * 10 + 1 AS award_mod_id, SUM(COALESCE(sl.obligated, 0)) AS obligated,
         MIN(su.s_suppkey + 1000) AS po_tracking_num, MIN(sl.loa_id) AS first_loa_id,
         MIN('AAC' || {_pad('su.s_suppkey % 30', 3)}) AS funding_aac, MIN(sl.ia_id) AS ia_id
  FROM s_ledger sl JOIN supplier su ON su.s_suppkey = sl.loa_id AND NOT (su.s_suppkey % 50 = 49)
  WHERE {LIVE.replace("is_deleted", "sl.is_deleted")} GROUP BY 1),
fr_psc AS (
  SELECT award_mod_id, p.p_brand AS psc_cd FROM (
    SELECT l_orderkey * 10 + 1 AS award_mod_id, part,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {_pad('l_linenumber', 4)} || 'AA', lia) AS rn
    FROM d_lines) x JOIN part p ON p.p_partkey = x.part WHERE rn = 1),
fr_company AS (
  SELECT o_orderkey * 10 + 1 AS award_mod_id, o_orderkey AS company_id FROM orders
  UNION ALL SELECT o_orderkey * 10, o_orderkey FROM orders WHERE o_orderkey % 5 = 0),
fr_plan AS (
  SELECT acquisition_id, competition_type_cd FROM (
    SELECT l_orderkey AS acquisition_id,
           CASE l_linenumber % 3 WHEN 0 THEN 'FULL' WHEN 1 THEN 'SOLE' ELSE 'LIMITED' END AS competition_type_cd,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY end_dt DESC NULLS LAST,
                              CASE l_linenumber % 3 WHEN 0 THEN 'FULL' WHEN 1 THEN 'SOLE' ELSE 'LIMITED' END
                              ASC NULLS LAST) AS rn
    FROM d_lines WHERE l_linenumber <> 7) WHERE rn = 1),
fr_offers AS (SELECT l_orderkey AS solicit_id, COUNT(*) AS n FROM d_lines GROUP BY 1),
fr_aac AS (SELECT ROW_NUMBER() OVER (ORDER BY cd) AS fpds_agency_sk, cd FROM s_aac),
fpds_txn AS (
  SELECT COALESCE(ga.award_sk, -1) AS fpds_award_sk, COALESCE(fc.fpds_contractor_sk, -1) AS fpds_contractor_sk,
         COALESCE(lead.fpds_agency_sk, -1) AS fpds_agency_sk, COALESCE(fund.fpds_agency_sk, -1) AS funding_agency_sk,
         ps.psc_sk, COALESCE(ga.award_sk, -1) AS award_sk, COALESCE(gi.ia_sk, -1) AS ia_sk, lo.loa_sk,
         CAST(strftime(m.co_signature_dt, '%Y%m%d') AS INTEGER) AS action_date_sk, m.id AS award_mod_id, m.mod_num,
         m.sf30 AS sf30_mod_type_cd, m.reason AS fpds_reason_cd,
         CASE WHEN upper(COALESCE(m.mod_num, '')) IN ({base}) THEN 'A'
              WHEN upper(COALESCE(m.sf30, '')) LIKE '{TERMINATION_PATTERN}'
                   OR upper(COALESCE(m.reason, '')) = '{TERMINATION_REASON}' THEN 'D' ELSE 'C' END AS action_type_cd,
         m.car AS car_status_cd, m.co_signature_dt AS car_submitted_dt, CAST(NULL AS TIMESTAMP) AS car_accepted_dt,
         fl.po_tracking_num, CAST(COALESCE(fl.obligated, 0) AS DECIMAL(15,2)) AS action_obligation_amt,
         CAST(CASE WHEN m.mod_num = 'P01' THEN {DMUL("o.o_totalprice", "0.6")} ELSE 0 END AS DECIMAL(15,2))
           AS base_exercised_opts_amt,
         CAST(CASE WHEN m.mod_num = 'P01' THEN {DMUL("o.o_totalprice", "0.8")} ELSE 0 END AS DECIMAL(15,2))
           AS base_all_opts_amt,
         CAST(CASE WHEN m.mod_num = 'P01' THEN {DMUL("o.o_totalprice", "0.3")} ELSE 0 END AS DECIMAL(15,2))
           AS current_total_value_amt,
         CAST(CASE WHEN m.mod_num = 'P01' THEN {DMUL("o.o_totalprice", "0.9")} ELSE 0 END AS DECIMAL(15,2))
           AS ultimate_contract_value,
         COALESCE(ct.small_business_flag, FALSE) AS is_small_business_flag, pl.competition_type_cd,
         CAST(NULL AS VARCHAR) AS reason_not_competed_cd,
         CAST(CASE WHEN m.award_id % 2 = 0 THEN COALESCE(off.n, 0) END AS BIGINT) AS number_of_offers
  FROM fr_mods m
  JOIN orders o ON o.o_orderkey = m.award_id
  LEFT JOIN fr_led fl ON fl.award_mod_id = m.id
  LEFT JOIN fr_psc fp ON fp.award_mod_id = m.id
  LEFT JOIN d_fpds_psc ps ON ps.psc_cd = fp.psc_cd
  LEFT JOIN (SELECT award_mod_id, MIN(company_id) AS company_id FROM fr_company GROUP BY 1) co ON co.award_mod_id = m.id
  LEFT JOIN d_fpds_contractor fc ON fc.award_mod_company_id = co.company_id
  LEFT JOIN d_contractor ct ON ct.award_mod_company_id = co.company_id
  LEFT JOIN fr_plan pl ON pl.acquisition_id = m.award_id - m.award_id % 4
  LEFT JOIN fr_offers off ON off.solicit_id = m.award_id
  LEFT JOIN g_award ga ON ga.award_id = m.award_id
  LEFT JOIN fr_aac lead ON lead.cd = 'AAC' || {_pad('o.o_custkey % 25', 3)}
  LEFT JOIN fr_aac fund ON fund.cd = fl.funding_aac
  LEFT JOIN g_ia gi ON gi.ia_id = fl.ia_id
  LEFT JOIN d_loa lo ON lo.loa_id = fl.first_loa_id)"""


@query("q_fre_fact_fpds_transaction", f"""{_DIMS_WITH}, {CONTRACTOR_SQL}, {FRE_SQL}, {_fpds_txn_sql()}
SELECT * FROM fpds_txn""")
def q_fre_fact_fpds_transaction(t):
    """FPDS transaction fact, one row per award modification: ledger, companies, plans, snapshots and
    offers each reduced to one row per key before joining; first line's PSC by keep-one; eight keys."""
    return _build(t, "fre.fact_fpds_transaction")


FPDS_AWARD_SQL = f"""d_fpds_award AS (
  SELECT ROW_NUMBER() OVER (ORDER BY o.o_orderkey) AS fpds_award_sk, o.o_orderkey AS award_id, {PIID_SQL} AS piid,
         CAST(NULL AS VARCHAR) AS idv_piid, CAST(NULL AS VARCHAR) AS idv_agency_id,
         CAST(NULL AS VARCHAR) AS referenced_idv_type_cd, ap.contract_type_cd, CAST(NULL AS VARCHAR) AS bundled_contract_cd,
         CAST(NULL AS VARCHAR) AS consolidated_contract_cd, CAST(NULL AS VARCHAR) AS multi_year_contract_cd,
         CAST(NULL AS VARCHAR) AS performance_type_cd, CAST(NULL AS VARCHAR) AS who_can_use_cd,
         'FINAL' AS fpds_car_status_cd,
         CASE WHEN o.o_orderkey % 2 = 0 THEN CAST(CAST(o.o_orderdate AS DATE) + 2 AS TIMESTAMP) END AS last_submitted_dt
  FROM orders o LEFT JOIN a_plan ap ON ap.acquisition_id = o.o_orderkey - o.o_orderkey % 4)"""


@query("q_fre_dim_fpds_award", f"{_DIMS_WITH}, {ACQ_SQL}, {FPDS_AWARD_SQL} SELECT * FROM d_fpds_award")
def q_fre_dim_fpds_award(t):
    """FPDS award: latest modification's CAR status, latest acquisition plan (keep-one), last
    transmittal date per PIID aggregated before the join."""
    return _build(t, "fre.dim_fpds_award")


def _posting_sql():
    from gildhall.plans.domain.iat_smi import POSTING_DIRECT, POSTING_DIRECT_CONNECT, POSTING_INFORMAL, POSTING_OPEN

    def pick(i):
        return (f"CASE WHEN pd.id IS NOT NULL AND pd.ext IS NOT NULL THEN '{POSTING_DIRECT_CONNECT[i]}' "
                f"WHEN pd.id IS NOT NULL THEN '{POSTING_DIRECT[i]}' WHEN pc.id IS NOT NULL THEN '{POSTING_OPEN[i]}' "
                f"ELSE '{POSTING_INFORMAL[i]}' END")
    return f"""p_direct AS (
  SELECT l_orderkey AS solicit_id, MIN(lia) AS id, MIN('R' || CAST(l_orderkey % 5 AS VARCHAR)) AS reason,
         MIN(CASE WHEN l_orderkey % 9 = 0 THEN 'EXT' || CAST(l_orderkey AS VARCHAR) END) AS ext, MIN(start_dt) AS open_dt
  FROM d_lines WHERE l_linenumber = 1 AND l_orderkey % 3 = 0 GROUP BY 1),
p_connect AS (
  SELECT l_orderkey AS solicit_id, MIN(lia) AS id, MIN(l_orderkey % 50) AS pm, MIN(end_dt) AS open_dt
  FROM d_lines WHERE l_linenumber = 2 AND l_orderkey % 4 = 0 GROUP BY 1),
d_posting_type AS (
  SELECT ROW_NUMBER() OVER (ORDER BY o.o_orderkey) AS posting_type_sk, o.o_orderkey AS solicit_id,
         {pick(0)} AS posting_type_cd, {pick(1)} AS posting_type_desc, COALESCE(pd.open_dt, pc.open_dt) AS open_dt,
         pc.pm AS pm_responsible_user_id, pd.reason AS ja_reason_cd, pd.ext AS external_source_ref
  FROM orders o LEFT JOIN p_direct pd ON pd.solicit_id = o.o_orderkey
  LEFT JOIN p_connect pc ON pc.solicit_id = o.o_orderkey
  WHERE o.o_orderkey % 2 = 0)"""


POSTING_SQL = _posting_sql()


@query("q_smi_dim_posting_type", f"{_DIMS_WITH}, {POSTING_SQL} SELECT * FROM d_posting_type")
def q_smi_dim_posting_type(t):
    """Posting type per solicitation: direct and connect postings aggregated to the solicitation
    before the join, type by the first matching rule."""
    return _build(t, "smi.dim_posting_type")


SMI_FACT_SQL = f"""sm_resp AS (
  SELECT lia AS id, l_orderkey AS solicit_id, l_linenumber, part, end_dt,
         status = 'F' AND l_linenumber = 1 AS win, l_orderkey % 2 = 0 AND l_linenumber = 1 AS has_award,
         CASE WHEN l_linenumber <> 5 THEN part % 120 END AS ipartner_id, {_pad('part % 1000', 9)} AS duns
  FROM d_lines),
sm_first_amc AS (SELECT o_custkey % 100 AS ipartner_id, MIN(o_orderkey) AS amc_id FROM orders GROUP BY 1),
sm_duns AS (SELECT duns_num, MIN(contractor_sk) AS c2, arg_min(small_business_flag, contractor_sk) AS sb2
            FROM d_contractor WHERE duns_num IS NOT NULL GROUP BY 1),
smi_fact AS (
  SELECT COALESCE(so.solicitation_sk, -1) AS solicitation_sk, COALESCE(acq.acquisition_sk, -1) AS acquisition_sk,
         COALESCE(c1.contractor_sk, d.c2, -1) AS contractor_sk, COALESCE(pt.posting_type_sk, -1) AS posting_type_sk,
         CASE WHEN r.has_award THEN pi.piid_sk END AS piid_sk,
         CASE WHEN o.o_orderkey % 2 = 0 THEN COALESCE(ga.agency_sk, -1) ELSE -1 END AS agency_sk,
         CASE WHEN r.has_award THEN COALESCE(gi.ia_sk, -1) ELSE -1 END AS ia_sk,
         CAST(strftime(r.end_dt, '%Y%m%d') AS INTEGER) AS response_date_sk,
         CASE WHEN r.has_award THEN CAST(strftime(o.o_orderdate + INTERVAL 31 DAY, '%Y%m%d') AS INTEGER) END
           AS award_date_sk,
         r.id AS source_response_id,
         CASE WHEN r.win THEN 'AWARDED' WHEN r.l_linenumber = 3 THEN 'NO_RESPONSE' ELSE 'SUBMITTED' END
           AS response_status_cd,
         r.win AS is_winner_flag, COALESCE(c1.small_business_flag, d.sb2, FALSE) AS is_small_business_flag,
         CAST(NULL AS DECIMAL(15,2)) AS bid_total_amt, CAST(NULL AS INTEGER) AS bid_clin_count,
         CASE WHEN r.win THEN CAST(CASE WHEN r.has_award THEN {DMUL("o.o_totalprice", "0.3")} ELSE 0 END AS DECIMAL(15,2))
           END AS award_total_amt,
         CAST(NULL AS DECIMAL(15,2)) AS bid_vs_award_variance, CAST(NULL AS INTEGER) AS competition_rank
  FROM sm_resp r
  JOIN orders o ON o.o_orderkey = r.solicit_id
  LEFT JOIN sm_first_amc fa ON fa.ipartner_id = r.ipartner_id
  LEFT JOIN d_contractor c1 ON c1.award_mod_company_id = fa.amc_id
  LEFT JOIN sm_duns d ON d.duns_num = r.duns
  LEFT JOIN d_solicitation so ON so.solicit_id = r.solicit_id
  LEFT JOIN d_acquisition acq ON acq.acquisition_id = r.solicit_id AND r.solicit_id % 2 = 0
  LEFT JOIN d_posting_type pt ON pt.solicit_id = r.solicit_id
  LEFT JOIN d_piid pi ON pi.piid_id = o.o_orderkey
  LEFT JOIN g_agency ga ON ga.activity_address_cd = 'AAC' || {_pad('o.o_custkey % 25', 3)}
  LEFT JOIN g_ia gi ON gi.ia_id = o.o_custkey)"""


@query("q_smi_fact_solicitation_response", f"""{_DIMS_WITH}, {ACQ_SQL}, {SOL_SQL}, {CONTRACTOR_SQL}, {POSTING_SQL},
{WPR_SMI_SQL}, {SMI_FACT_SQL} SELECT * FROM smi_fact""")
def q_smi_fact_solicitation_response(t):
    """Solicitation response fact: one award per response (smallest), contractor by partner then
    DUNS (first hit), seven dimension keys, response status from the Y/N flags."""
    return _build(t, "smi.fact_solicitation_response")


@query("q_tpp_dim_receiving_report", f"""SELECT ROW_NUMBER() OVER (ORDER BY o.o_orderkey) AS receiving_report_sk,
       o.o_orderkey AS rr_summary_id, 'PG' || CAST(o.o_orderkey AS VARCHAR) AS pegasys_invoice_num,
       CAST(CAST(o.o_orderdate AS DATE) + 20 AS TIMESTAMP) AS rr_acceptance_dt,
       CAST(o.o_totalprice AS DECIMAL(15,2)) AS total_rr_amt, CAST(o.o_orderkey % 7 + 1 AS INTEGER) AS rr_line_count,
       CAST(COALESCE(d.amt, 0) AS DECIMAL(15,2)) AS mdl_amt
FROM orders o
LEFT JOIN (SELECT l_orderkey, SUM({DMUL("l_extendedprice", "1 - l_discount")}) AS amt FROM lineitem
           WHERE NOT (l_returnflag = 'R') GROUP BY 1) d ON d.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F'""")
def q_tpp_dim_receiving_report(t):
    """Receiving reports with their detail amounts aggregated before the join."""
    return _build(t, "tpp.dim_receiving_report")


_TTYPE = "upper(replace(substr(o_orderpriority, 3, 20), ' ', '_'))"


@query("q_tpp_dim_transmittal_type", f"""SELECT ROW_NUMBER() OVER (ORDER BY t.cd) AS transmittal_type_sk,
       t.cd AS transmittal_type_cd, 'Type ' || t.cd AS transmittal_type_desc,
       CASE WHEN t.cd <> 'LOW' THEN 'FF_' || substr(t.cd, 1, 3) END AS flat_file_code, v.spec_version,
       CAST(NULL AS VARCHAR) AS envelope_format, CAST(NULL AS VARCHAR) AS poc_name, CAST(NULL AS VARCHAR) AS poc_email
FROM (SELECT DISTINCT {_TTYPE} AS cd FROM orders) t
LEFT JOIN (SELECT {_TTYPE} AS cd, MAX(CAST(year(o_orderdate) AS VARCHAR)) AS spec_version FROM orders
           WHERE NOT (o_orderstatus = 'P') GROUP BY 1) v ON v.cd = t.cd""")
def q_tpp_dim_transmittal_type(t):
    """Transmittal types with their latest spec version aggregated before the join."""
    return _build(t, "tpp.dim_transmittal_type")


@query("q_wpr_dim_industry_partner", f"""SELECT ROW_NUMBER() OVER (ORDER BY s_suppkey) AS industry_partner_sk,
       s_suppkey AS partner_id, 'Partner ' || s_name AS company_name,
       CASE WHEN s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS contract_status_cd, {_pad('s_suppkey', 9)} AS ftin,
       'City' || CAST(s_nationkey AS VARCHAR) AS address_city, 'S' || CAST(s_suppkey % 50 AS VARCHAR) AS address_state_cd,
       'US' AS address_country_cd, {SCD_COLS_SQL}
FROM supplier""")
def q_wpr_dim_industry_partner(t):
    """Industry partners: rows retired by the character delete flag dropped, then keyed."""
    return _build(t, "wpr.dim_industry_partner")
