"""SCD2, snapshots and change data capture (§2.10, JON-13/15/21).

v1 = customer; v2 raises the balance where key % 7 = 0 (tracked), renames
the segment where key % 11 = 0 (in place) and adds key + 1,000,000 where
key % 50 = 0 (net-new). The dimension starts at 2001-01-01 and the change
is applied as of 2002-01-01.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.functions import date_sk
from gildhall.operators import (
    affected_grains, change_window, changed_keys, latest_snapshot, net_new, profile, reaggregate,
    scd2_apply, scd2_asof, scd2_initial, scd2_stats,
)
from gildhall.operators import quality as Q
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF, LEDGER_FACT_SQL, LEDGER_SQL, ledger, ledger_fact, money_sum
from gildhall.sources import live

START = "2001-01-01"
TRACKED = ["c_acctbal", "c_nationkey"]
INPLACE = ["c_mktsegment", "c_name"]
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def v1(t):
    return t["customer"].select(*CUST_COLS)


def v2(t):
    c = v1(t)
    k = F.col("c_custkey")
    changed = c.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(k % 7 == 0, F.col("c_acctbal") + 10).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 11 == 0, F.lit("RESEGMENTED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    new = c.filter(k % 50 == 0).select((k + 1000000).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal",
                                       "c_mktsegment")
    return changed.unionByName(new)


def applied(t):
    return scd2_apply(scd2_initial(v1(t), START), v2(t), ["c_custkey"], TRACKED, INPLACE, AS_OF, batch_id="b2")


V_SQL = f"""v1 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
v2 AS (SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 10 ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 11 = 0 THEN 'RESEGMENTED' ELSE c_mktsegment END AS c_mktsegment FROM v1
       UNION ALL
       SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v1 WHERE c_custkey % 50 = 0),
j AS (SELECT v1.c_custkey AS k1, v2.c_custkey AS k2,
         v1.c_name AS n1, v1.c_nationkey AS nk1, v1.c_acctbal AS b1, v1.c_mktsegment AS s1,
         v2.c_name AS n2, v2.c_nationkey AS nk2, v2.c_acctbal AS b2, v2.c_mktsegment AS s2,
         CASE WHEN v2.c_custkey IS NULL THEN 'kept' WHEN v1.c_custkey IS NULL THEN 'new'
              WHEN v1.c_acctbal IS DISTINCT FROM v2.c_acctbal OR v1.c_nationkey IS DISTINCT FROM v2.c_nationkey THEN 'closed'
              WHEN v1.c_mktsegment IS DISTINCT FROM v2.c_mktsegment OR v1.c_name IS DISTINCT FROM v2.c_name THEN 'updated'
              ELSE 'unchanged' END AS a
       FROM v1 FULL OUTER JOIN v2 ON v1.c_custkey = v2.c_custkey),
applied AS (
  SELECT k1 AS c_custkey, n1 AS c_name, nk1 AS c_nationkey, b1 AS c_acctbal, s1 AS c_mktsegment,
         TIMESTAMP '{START}' AS eff_start_dt, TIMESTAMP '{AS_OF}' AS eff_end_dt, FALSE AS is_current_flag, 'closed' AS _action
  FROM j WHERE a = 'closed'
  UNION ALL
  SELECT k2, n2, nk2, b2, s2, TIMESTAMP '{AS_OF}', CAST(NULL AS TIMESTAMP), TRUE, 'inserted' FROM j WHERE a = 'closed'
  UNION ALL
  SELECT k2, n2, nk2, b2, s2, TIMESTAMP '{AS_OF}', CAST(NULL AS TIMESTAMP), TRUE, 'new' FROM j WHERE a = 'new'
  UNION ALL
  SELECT k1, n2, nk1, b1, s2, TIMESTAMP '{START}', CAST(NULL AS TIMESTAMP), TRUE, 'updated' FROM j WHERE a = 'updated'
  UNION ALL
  SELECT k1, n1, nk1, b1, s1, TIMESTAMP '{START}', CAST(NULL AS TIMESTAMP), TRUE, a FROM j WHERE a IN ('kept', 'unchanged'))"""


@query("q_scd2_initial", f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  TIMESTAMP '{START}' AS eff_start_dt, CAST(NULL AS TIMESTAMP) AS eff_end_dt, TRUE AS is_current_flag FROM customer""")
def q_scd2_initial(t):
    """Initial load: all rows current, no end date (SCD-2f)."""
    return scd2_initial(v1(t), START)


@query("q_scd2_apply", f"WITH {V_SQL} SELECT * FROM applied")
def q_scd2_apply(t):
    """One classifying full join: close + insert, in-place, new, unchanged (SCD-2a..d)."""
    return applied(t)


@query("q_scd2_closed", f"WITH {V_SQL} SELECT * FROM applied WHERE _action = 'closed'")
def q_scd2_closed(t):
    return applied(t).filter(F.col("_action") == "closed")


@query("q_scd2_inplace", f"WITH {V_SQL} SELECT * FROM applied WHERE _action = 'updated'")
def q_scd2_inplace(t):
    return applied(t).filter(F.col("_action") == "updated")


REJECT_SQL = f"""{V_SQL},
batch AS (
  SELECT c_custkey, c_nationkey AS part, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v2
  UNION ALL SELECT NULL, c_nationkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v2 WHERE c_custkey % 13 = 0
  UNION ALL SELECT c_custkey, NULL, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v2 WHERE c_custkey % 19 = 0
  UNION ALL SELECT c_custkey, c_nationkey, c_name, c_nationkey, c_acctbal + 5, c_mktsegment FROM v2 WHERE c_custkey % 17 = 0),
flagged AS (
  SELECT *, CASE WHEN c_custkey IS NULL OR part IS NULL THEN 'null_key'
                 WHEN COUNT(*) OVER (PARTITION BY c_custkey, part) > 1 THEN 'repeated_key' END AS reason FROM batch),
rj AS (
  SELECT a.c_custkey AS k1, b.c_custkey AS k2, a.c_nationkey AS p1, b.part AS p2, a.c_name AS n1, b.c_name AS n2,
         a.c_acctbal AS b1, b.c_acctbal AS b2, a.c_mktsegment AS s1, b.c_mktsegment AS s2,
         CASE WHEN b.c_custkey IS NULL THEN 'kept' WHEN a.c_custkey IS NULL THEN 'new'
              WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal THEN 'closed'
              WHEN a.c_mktsegment IS DISTINCT FROM b.c_mktsegment OR a.c_name IS DISTINCT FROM b.c_name THEN 'updated'
              ELSE 'unchanged' END AS a
  FROM v1 a FULL OUTER JOIN (SELECT * FROM flagged WHERE reason IS NULL) b
    ON a.c_custkey = b.c_custkey AND a.c_nationkey = b.part)"""


@query("q_scd2_rejects", f"""WITH {REJECT_SQL}
SELECT k1 AS c_custkey, p1 AS part, n1 AS c_name, b1 AS c_acctbal, s1 AS c_mktsegment, TIMESTAMP '{START}' AS eff_start_dt,
       TIMESTAMP '{AS_OF}' AS eff_end_dt, FALSE AS is_current_flag, 'closed' AS _action, CAST(NULL AS VARCHAR) AS _reason
FROM rj WHERE a = 'closed'
UNION ALL
SELECT k2, p2, n2, b2, s2, TIMESTAMP '{AS_OF}', NULL, TRUE, CASE a WHEN 'closed' THEN 'inserted' ELSE a END, NULL
FROM rj WHERE a IN ('closed', 'new')
UNION ALL
SELECT k1, p1, n2, b1, s2, TIMESTAMP '{START}', NULL, TRUE, a, NULL FROM rj WHERE a = 'updated'
UNION ALL
SELECT k1, p1, n1, b1, s1, TIMESTAMP '{START}', NULL, TRUE, a, NULL FROM rj WHERE a IN ('kept', 'unchanged')
UNION ALL
SELECT c_custkey, part, c_name, c_acctbal, c_mktsegment, NULL, NULL, NULL, 'rejected', reason FROM flagged WHERE reason IS NOT NULL""")
def q_scd2_rejects(t):
    """A batch with a two-part key, parts of it NULL or the whole key repeated: the bad rows come back
    beside the applied ones and change nothing (SCD-2a, SCD-2b, SCD-2d)."""
    cols = ["c_custkey", "part", "c_name", "c_acctbal", "c_mktsegment"]
    rows = v2(t).withColumn("part", F.col("c_nationkey"))
    k = F.col("c_custkey")
    batch = (rows.unionByName(rows.filter(k % 13 == 0).withColumn("c_custkey", F.lit(None).cast("long")))
             .unionByName(rows.filter(k % 19 == 0).withColumn("part", F.lit(None).cast("int")))
             .unionByName(rows.filter(k % 17 == 0).withColumn("c_acctbal", F.col("c_acctbal") + 5))).select(*cols)
    current = scd2_initial(v1(t).withColumn("part", F.col("c_nationkey")).select(*cols), START)
    return scd2_apply(current, batch, ["c_custkey", "part"], ["c_acctbal"], INPLACE, AS_OF, on_duplicate="reject", rejects=True)


@query("q_scd2_stats", f"WITH {V_SQL} SELECT _action, COUNT(*) AS n_rows FROM applied GROUP BY 1")
def q_scd2_stats(t):
    """Change counts by action from the classified rows (SCD-2e, fix for D-1)."""
    return scd2_stats(applied(t))


@query("q_scd2_invariants", f"""WITH {V_SQL},
k AS (SELECT c_custkey, COUNT(*) FILTER (WHERE is_current_flag) AS cur,
        COUNT(*) FILTER (WHERE is_current_flag AND eff_end_dt IS NOT NULL) AS bad_end FROM applied GROUP BY 1)
SELECT * FROM (VALUES
  ('n_keys', (SELECT CAST(COUNT(*) AS DECIMAL(38,2)) FROM k), CAST(NULL AS BOOLEAN)),
  ('keys_not_one_current', (SELECT CAST(COUNT(*) AS DECIMAL(38,2)) FROM k WHERE cur <> 1), (SELECT COUNT(*) = 0 FROM k WHERE cur <> 1)),
  ('current_with_end_date', (SELECT CAST(COALESCE(SUM(bad_end), 0) AS DECIMAL(38,2)) FROM k), (SELECT COALESCE(SUM(bad_end), 0) = 0 FROM k)),
  ('history_rows', (SELECT CAST(COUNT(*) AS DECIMAL(38,2)) FROM applied WHERE NOT is_current_flag), CAST(NULL AS BOOLEAN))
) AS v("check", value, ok)""")
def q_scd2_invariants(t):
    """One current row per key, no end date on a current row (CHK-5), as a
    one-pass profile over the per-key counts."""
    a = applied(t)
    per_key = a.groupBy("c_custkey").agg(
        F.count_if(F.col("is_current_flag")).alias("cur"),
        F.count_if(F.col("is_current_flag") & F.col("eff_end_dt").isNotNull()).alias("bad_end"),
        F.count_if(~F.col("is_current_flag")).alias("hist"))
    return profile(per_key, {
        "n_keys": (F.count(F.lit(1)), None),
        "keys_not_one_current": (F.count_if(F.col("cur") != 1), Q.eq(0)),
        "current_with_end_date": (F.coalesce(F.sum("bad_end"), F.lit(0)), Q.eq(0)),
        "history_rows": (F.sum("hist"), None),
    })


@query("q_scd2_asof", f"""WITH {V_SQL}
SELECT o.o_orderkey, a1.c_acctbal AS balance_2001_06, a2.c_acctbal AS balance_2002_06
FROM orders o
LEFT JOIN applied a1 ON a1.c_custkey = o.o_custkey AND a1.eff_start_dt <= TIMESTAMP '2001-06-01'
     AND (a1.eff_end_dt IS NULL OR TIMESTAMP '2001-06-01' < a1.eff_end_dt)
LEFT JOIN applied a2 ON a2.c_custkey = o.o_custkey AND a2.eff_start_dt <= TIMESTAMP '2002-06-01'
     AND (a2.eff_end_dt IS NULL OR TIMESTAMP '2002-06-01' < a2.eff_end_dt)""")
def q_scd2_asof(t):
    """Version valid at two dates: equi-join plus interval residual (SCD-2g)."""
    dim = applied(t).select(*CUST_COLS, "eff_start_dt", "eff_end_dt")
    o = t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                           F.lit("2001-06-01").cast("timestamp_ntz").alias("t1"),
                           F.lit("2002-06-01").cast("timestamp_ntz").alias("t2"))
    a = scd2_asof(dim, o, ["c_custkey"], "t1", ["c_acctbal"]).withColumnRenamed("c_acctbal", "balance_2001_06")
    a = scd2_asof(dim, a, ["c_custkey"], "t2", ["c_acctbal"]).withColumnRenamed("c_acctbal", "balance_2002_06")
    return a.select("o_orderkey", "balance_2001_06", "balance_2002_06")


@query("q_net_new", f"""WITH {V_SQL}
SELECT * FROM v2 WHERE c_custkey NOT IN (SELECT c_custkey FROM v1)""")
def q_net_new(t):
    """Incoming keys absent from the dimension (JON-13, SCD-2d)."""
    return net_new(v2(t), v1(t), "c_custkey")


W_LO, W_HI = "1998-01-01", "1998-03-01"


@query("q_changed_keys", f"""WITH c AS (SELECT c_custkey, CAST(DATE '1995-01-01' + CAST(c_custkey % 2500 AS INTEGER) AS TIMESTAMP) AS updated_dt
  FROM customer)
SELECT DISTINCT c_custkey FROM (
  SELECT c_custkey FROM c WHERE updated_dt >= TIMESTAMP '{W_LO}' AND updated_dt < TIMESTAMP '{W_HI}'
  UNION ALL
  SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{W_LO}' AND o_orderdate < TIMESTAMP '{W_HI}')
WHERE c_custkey IS NOT NULL""")
def q_changed_keys(t):
    """Customers changed directly or through their orders: one union of key
    sets, computed once, ready for a semi-join (JON-15, CDC-3)."""
    c = t["customer"].withColumn(
        "updated_dt", F.date_add(F.to_date(F.lit("1995-01-01")), (F.col("c_custkey") % 2500).cast("int"))
        .cast("timestamp_ntz"))
    win = lambda col: (F.col(col) >= F.lit(W_LO).cast("timestamp_ntz")) & (F.col(col) < F.lit(W_HI).cast("timestamp_ntz"))
    return changed_keys([(c, "c_custkey", win("updated_dt")), (t["orders"], "o_custkey", win("o_orderdate"))],
                        out="c_custkey")


@query("q_change_window", """WITH o AS (SELECT o_orderstatus, o_orderdate AS created_dt,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS updated_dt FROM orders)
SELECT o_orderstatus, updated_dt IS NULL AS used_fallback, COUNT(*) AS n_rows FROM o
WHERE (updated_dt >= TIMESTAMP '1998-01-01' AND updated_dt < TIMESTAMP '1998-04-01')
   OR (updated_dt IS NULL AND created_dt >= TIMESTAMP '1998-01-01' AND created_dt < TIMESTAMP '1998-04-01')
GROUP BY 1, 2""")
def q_change_window(t):
    """Half-open window with fallback to the creation date (FLT-5, CDC-2)."""
    o = t["orders"].select(
        "o_orderstatus", F.col("o_orderdate").alias("created_dt"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("o_orderdate") + F.expr("interval 30 days")).alias("updated_dt"))
    w = o.filter(change_window("updated_dt", "created_dt", "1998-01-01", "1998-04-01"))
    return w.groupBy("o_orderstatus", F.col("updated_dt").isNull().alias("used_fallback")).agg(
        F.count(F.lit(1)).alias("n_rows"))


A_LO, A_HI = "1998-01-01", "1998-02-01"
AFFECTED_SQL = f"""affected AS (
  SELECT DISTINCT order_key, supp_key FROM (
    SELECT l_orderkey AS order_key, l_suppkey AS supp_key FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '{A_LO}' AND l_shipdate < TIMESTAMP '{A_HI}'
    UNION ALL
    SELECT l.l_orderkey, l.l_suppkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderdate >= TIMESTAMP '{A_LO}' AND o.o_orderdate < TIMESTAMP '{A_HI}'))"""


def affected(t):
    li = t["lineitem"]
    lo, hi = F.lit(A_LO).cast("timestamp_ntz"), F.lit(A_HI).cast("timestamp_ntz")
    lines_in = li.filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi))
    orders_in = t["orders"].filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)) \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    via_orders = li.join(orders_in, "l_orderkey", "left_semi")
    return affected_grains([(lines_in, ["l_orderkey", "l_suppkey"]), (via_orders, ["l_orderkey", "l_suppkey"])],
                           ["order_key", "supp_key"])


@query("q_affected_keys", f"WITH {AFFECTED_SQL} SELECT * FROM affected")
def q_affected_keys(t):
    """Grains touched by changed lines or changed orders, distinct on the 2-column grain (CDC-4, fix for D-4)."""
    return affected(t)


@query("q_affected_reagg", f"""WITH {LEDGER_SQL}, {AFFECTED_SQL}
SELECT l_orderkey AS order_key, l_suppkey AS supp_key, COUNT(*) AS line_cnt,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS obligated_amt
FROM ledger WHERE (is_deleted IS NULL OR is_deleted = FALSE)
  AND (l_orderkey, l_suppkey) IN (SELECT order_key, supp_key FROM affected)
GROUP BY 1, 2""")
def q_affected_reagg(t):
    """All live rows of the affected grains re-aggregated, not only the changed ones (CDC-5, JON-21)."""
    led = live(ledger(t)).select(F.col("l_orderkey").alias("order_key"), F.col("l_suppkey").alias("supp_key"),
                                 "l_extendedprice")
    return reaggregate(led, affected(t), ["order_key", "supp_key"],
                       [F.count(F.lit(1)).alias("line_cnt"), money_sum("l_extendedprice").alias("obligated_amt")])


@query("q_latest_snapshot", f"""WITH {LEDGER_FACT_SQL},
snaps AS (
  SELECT order_key, supp_key, fiscal_year, fiscal_month, 20011231 AS snapshot_date_sk, obligated_amt FROM ledger_fact
  UNION ALL
  SELECT order_key, supp_key, fiscal_year, fiscal_month, 20020131, CAST(obligated_amt + 1 AS DECIMAL(38,2)) FROM ledger_fact
  WHERE fiscal_year >= 2000)
SELECT order_key, supp_key, fiscal_year, fiscal_month, CAST(snapshot_date_sk AS INTEGER) AS snapshot_date_sk, obligated_amt
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_key, supp_key, fiscal_year, fiscal_month
      ORDER BY snapshot_date_sk DESC) AS rn FROM snaps) WHERE rn = 1""")
def q_latest_snapshot(t):
    """Two appended snapshots of the ledger fact; the newest per grain wins (SNP-1, fix for D-6)."""
    f = ledger_fact(t).select("order_key", "supp_key", "fiscal_year", "fiscal_month", "obligated_amt")
    s1 = f.withColumn("snapshot_date_sk", date_sk(F.to_date(F.lit("2001-12-31"))))
    s2 = f.filter(F.col("fiscal_year") >= 2000).select(
        "order_key", "supp_key", "fiscal_year", "fiscal_month",
        (F.col("obligated_amt") + 1).cast("decimal(38,2)").alias("obligated_amt"),
        date_sk(F.to_date(F.lit("2002-01-31"))).alias("snapshot_date_sk"))
    snaps = s1.unionByName(s2)
    return latest_snapshot(snaps, ["order_key", "supp_key", "fiscal_year", "fiscal_month"]).select(
        "order_key", "supp_key", "fiscal_year", "fiscal_month", "snapshot_date_sk", "obligated_amt")
