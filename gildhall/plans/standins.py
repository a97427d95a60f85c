"""Stand-in warehouse tables derived from the test tables, Spark and SQL side
by side.

ledger = lineitem (line = l_orderkey, LOA = l_suppkey, date = l_shipdate,
deleted = returnflag 'R', flag NULL where quantity = 1); award = orders;
IA = customer; agency = nation; LOA/contractor = supplier; PSC = part;
chronology = events; collab = conversations. ``AS_OF`` is fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import fiscal_month, fiscal_year
from gildhall.sources.tables import Tables

AS_OF = "2002-01-01"


def money_sum(c) -> F.Column:
    """SUM of money cast to DECIMAL(15,2), widened to DECIMAL(38,2)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast("decimal(15,2)")).cast("decimal(38,2)")


def dmul(a, b) -> F.Column:
    """Exact money product: both sides as DECIMAL(15,2), rounded half-up to cents."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.round(ca.cast("decimal(15,2)") * cb.cast("decimal(15,2)"), 2).cast("decimal(15,2)")


def ledger(t: Tables) -> DataFrame:
    li = t["lineitem"]
    deleted = F.when(F.col("l_quantity") == 1, F.lit(None).cast("boolean")).otherwise(F.col("l_returnflag") == "R")
    return li.withColumn("is_deleted", deleted)


def ia_dim(t: Tables) -> DataFrame:
    """Customer as the IA dimension: sk = custkey, keys divisible by 10 are
    missing (blanked) so unresolved keys exist; all rows current."""
    c = t["customer"]
    return (c.filter(F.col("c_custkey") % 10 != 0)
             .withColumn("ia_sk", F.col("c_custkey"))
             .withColumn("is_current_flag", F.lit(True)))


def ledger_fact(t: Tables) -> DataFrame:
    from gildhall.functions import all_zero
    from gildhall.operators import preagg_join, resolve_sk
    from gildhall.sources import live

    led = ledger(t)
    d = F.col("l_shipdate")
    g = live(led).groupBy(
        F.col("l_orderkey").alias("order_key"), F.col("l_suppkey").alias("supp_key"),
        fiscal_year(d).alias("fiscal_year"), fiscal_month(d).alias("fiscal_month"),
    ).agg(
        F.count(F.lit(1)).alias("line_cnt"),
        money_sum("l_quantity").alias("qty"),
        money_sum("l_extendedprice").alias("obligated_amt"),
        money_sum(dmul("l_extendedprice", "l_discount")).alias("discount_amt"),
        money_sum(dmul("l_extendedprice", "l_tax")).alias("tax_amt"),
        F.max("l_linestatus").alias("max_linestatus"),
    )
    # order-level returned amount over all ledger rows: aggregate first, then join (JON-7)
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice").cast("decimal(15,2)"))
    g = preagg_join(g, led, on="order_key", right_on="l_orderkey",
                    aggs=[F.coalesce(F.sum(returned), F.lit(0)).cast("decimal(38,2)").alias("returned_amt")])
    g = g.withColumn("returned_amt", F.coalesce("returned_amt", F.lit(0).cast("decimal(38,2)")))
    orders = t["orders"].select(F.col("o_orderkey").alias("order_key"), "o_custkey")
    g = g.join(orders, "order_key", "left")
    g = resolve_sk(g, ia_dim(t), {"o_custkey": "c_custkey"}, sk="ia_sk")
    g = g.filter(~all_zero(["discount_amt", "tax_amt", "returned_amt"]))
    return g.select(
        "order_key", "supp_key", "fiscal_year", "fiscal_month", "ia_sk", "line_cnt", "qty",
        "obligated_amt", "discount_amt", "tax_amt", "returned_amt",
        (F.col("obligated_amt") - F.col("discount_amt")).cast("decimal(38,2)").alias("net_amt"),
        "max_linestatus")


# --- SQL side (DuckDB) ----------------------------------------------------

def FY(d: str) -> str:
    return f"CAST(year({d}) + CASE WHEN month({d}) >= 10 THEN 1 ELSE 0 END AS INTEGER)"


def FM(d: str) -> str:
    return f"CAST(((month({d}) + 2) % 12) + 1 AS INTEGER)"


def DMUL(a: str, b: str) -> str:
    return f"round(CAST({a} AS DECIMAL(15,2)) * CAST({b} AS DECIMAL(15,2)), 2)"


def MS(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(15,2))) AS DECIMAL(38,2))"


LEDGER_SQL = """ledger AS (
  SELECT *, CASE WHEN l_quantity = 1 THEN NULL ELSE l_returnflag = 'R' END AS is_deleted FROM lineitem)"""

IA_DIM_SQL = """ia_dim AS (
  SELECT *, c_custkey AS ia_sk, TRUE AS is_current_flag FROM customer WHERE c_custkey % 10 <> 0)"""

LEDGER_FACT_SQL = f"""{LEDGER_SQL},
{IA_DIM_SQL},
g AS (
  SELECT l_orderkey AS order_key, l_suppkey AS supp_key,
         {FY('l_shipdate')} AS fiscal_year, {FM('l_shipdate')} AS fiscal_month,
         COUNT(*) AS line_cnt, {MS('l_quantity')} AS qty, {MS('l_extendedprice')} AS obligated_amt,
         {MS(DMUL('l_extendedprice', 'l_discount'))} AS discount_amt,
         {MS(DMUL('l_extendedprice', 'l_tax'))} AS tax_amt,
         MAX(l_linestatus) AS max_linestatus
  FROM ledger WHERE is_deleted IS NULL OR is_deleted = FALSE
  GROUP BY 1, 2, 3, 4),
r AS (
  SELECT l_orderkey AS order_key,
         CAST(COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END), 0) AS DECIMAL(38,2)) AS returned_amt
  FROM ledger GROUP BY 1),
ledger_fact AS (
  SELECT g.order_key, g.supp_key, g.fiscal_year, g.fiscal_month,
         CASE WHEN o.o_custkey IS NULL THEN -1 ELSE COALESCE(d.ia_sk, -1) END AS ia_sk,
         g.line_cnt, g.qty, g.obligated_amt, g.discount_amt, g.tax_amt,
         COALESCE(r.returned_amt, 0) AS returned_amt,
         CAST(g.obligated_amt - g.discount_amt AS DECIMAL(38,2)) AS net_amt, g.max_linestatus
  FROM g LEFT JOIN r ON r.order_key = g.order_key
         LEFT JOIN orders o ON o.o_orderkey = g.order_key
         LEFT JOIN ia_dim d ON d.c_custkey = o.o_custkey
  WHERE NOT (g.discount_amt = 0 AND g.tax_amt = 0 AND COALESCE(r.returned_amt, 0) = 0))"""


def cust_history(t: Tables) -> DataFrame:
    """Customer as an SCD2 dimension with history: keys divisible by 7 have
    a closed first version and a current second one (balance + 100)."""
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    changed = F.col("c_custkey") % 7 == 0
    v1 = c.select("*",
                  F.lit("1995-01-01").cast("timestamp_ntz").alias("eff_start_dt"),
                  F.when(changed, F.lit(AS_OF).cast("timestamp_ntz")).alias("eff_end_dt"),
                  (~changed).alias("is_current_flag"))
    v2 = c.filter(changed).select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 100).alias("c_acctbal"), "c_mktsegment",
        F.lit(AS_OF).cast("timestamp_ntz").alias("eff_start_dt"),
        F.lit(None).cast("timestamp_ntz").alias("eff_end_dt"), F.lit(True).alias("is_current_flag"))
    return v1.unionByName(v2)


CUST_HISTORY_SQL = f"""cust_history AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TIMESTAMP '1995-01-01' AS eff_start_dt,
         CASE WHEN c_custkey % 7 = 0 THEN TIMESTAMP '{AS_OF}' END AS eff_end_dt, c_custkey % 7 <> 0 AS is_current_flag
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment, TIMESTAMP '{AS_OF}', CAST(NULL AS TIMESTAMP), TRUE
  FROM customer WHERE c_custkey % 7 = 0)"""


def supp_dim(t: Tables) -> DataFrame:
    """Supplier as the LOA/contractor dimension; keys divisible by 10 are missing."""
    return (t["supplier"].filter(F.col("s_suppkey") % 10 != 0)
            .withColumn("supp_sk", F.col("s_suppkey")).withColumn("is_current_flag", F.lit(True)))
