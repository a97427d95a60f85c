"""Data-quality checks (§2.11) on the demo fact and the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.functions import fiscal_month, fiscal_year, flag, money
from gildhall.operators import pick_one, profile, quality_suite, resolve_sk
from gildhall.operators import quality as Q
from gildhall.plans.registry import query
from gildhall.plans.standins import IA_DIM_SQL, LEDGER_FACT_SQL, LEDGER_SQL, ia_dim, ledger, ledger_fact, supp_dim
from gildhall.sources import live

EXPECTED_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]


@query("q_quality_profile", f"""WITH {LEDGER_SQL}
SELECT * FROM (VALUES
  ('n_rows', (SELECT CAST(COUNT(*) AS DECIMAL(38,2)) FROM ledger), (SELECT COUNT(*) >= 1 FROM ledger)),
  ('deleted_true', (SELECT CAST(COUNT(*) FILTER (WHERE is_deleted = TRUE) AS DECIMAL(38,2)) FROM ledger), CAST(NULL AS BOOLEAN)),
  ('deleted_false', (SELECT CAST(COUNT(*) FILTER (WHERE is_deleted = FALSE) AS DECIMAL(38,2)) FROM ledger), CAST(NULL AS BOOLEAN)),
  ('deleted_null', (SELECT CAST(COUNT(*) FILTER (WHERE is_deleted IS NULL) AS DECIMAL(38,2)) FROM ledger), CAST(NULL AS BOOLEAN)),
  ('returnflag_null', (SELECT CAST(COUNT(*) FILTER (WHERE l_returnflag IS NULL) AS DECIMAL(38,2)) FROM ledger),
     (SELECT COUNT(*) FILTER (WHERE l_returnflag IS NULL) = 0 FROM ledger)),
  ('gap_column_not_null', (SELECT CAST(0 AS DECIMAL(38,2))), TRUE),
  ('negative_price', (SELECT CAST(COUNT(*) FILTER (WHERE l_extendedprice < 0) AS DECIMAL(38,2)) FROM ledger),
     (SELECT COUNT(*) FILTER (WHERE l_extendedprice < 0) = 0 FROM ledger)),
  ('price_below_floor', (SELECT CAST(COUNT(*) FILTER (WHERE l_extendedprice < -9999999) AS DECIMAL(38,2)) FROM ledger),
     (SELECT COUNT(*) FILTER (WHERE l_extendedprice < -9999999) = 0 FROM ledger)),
  ('price_sum', (SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) FROM ledger), CAST(NULL AS BOOLEAN))
) AS v("check", value, ok)""")
def q_quality_profile(t):
    """Coverage counts, TRUE/FALSE/NULL split, never-NULL, all-NULL gap,
    sign and floor checks in ONE aggregate pass (CHK-1, CHK-3, CHK-12, AGG-13)."""
    led = ledger(t).withColumn("gap_col", F.lit(None).cast("string"))
    return profile(led, {
        "n_rows": (F.count(F.lit(1)), Q.ge(1)),
        "deleted_true": (Q.true_count("is_deleted"), None),
        "deleted_false": (Q.false_count("is_deleted"), None),
        "deleted_null": (Q.null_count("is_deleted"), None),
        "returnflag_null": (Q.null_count("l_returnflag"), Q.eq(0)),
        "gap_column_not_null": (Q.not_null_count("gap_col"), Q.eq(0)),
        "negative_price": (F.count_if(F.col("l_extendedprice") < 0), Q.eq(0)),
        "price_below_floor": (F.count_if(F.col("l_extendedprice") < -9999999), Q.eq(0)),
        "price_sum": (F.sum(money("l_extendedprice")), None),
    })


@query("q_row_parity", f"""WITH {LEDGER_FACT_SQL},
src AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey,
    {'year(l_shipdate) + CASE WHEN month(l_shipdate) >= 10 THEN 1 ELSE 0 END'}, month(l_shipdate)
    FROM ledger WHERE is_deleted IS NULL OR is_deleted = FALSE))
SELECT 'row_parity' AS "check", (SELECT n FROM src) AS source_rows, (SELECT COUNT(*) FROM ledger_fact) AS target_rows,
       (SELECT n FROM src) = (SELECT COUNT(*) FROM ledger_fact) AS ok""")
def q_row_parity(t):
    """Source grains vs target rows (CHK-2): the zero-row filter shows up here."""
    src = live(ledger(t)).select("l_orderkey", "l_suppkey", fiscal_year("l_shipdate"), fiscal_month("l_shipdate")) \
        .distinct()
    return Q.row_parity(src, ledger_fact(t))


@query("q_dup_keys", """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_dup_keys(t):
    """Natural-key uniqueness: keys with more than one row (CHK-4, AGG-8)."""
    return Q.dup_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("q_sentinel_report", f"""WITH {IA_DIM_SQL},
supp_dim AS (SELECT * FROM supplier WHERE s_suppkey % 10 <> 0),
b AS (SELECT l_orderkey, MIN(l_suppkey) AS min_suppkey FROM lineitem GROUP BY 1),
f AS (SELECT o.o_orderkey, b.min_suppkey, COALESCE(d.ia_sk, -1) AS ia_sk, COALESCE(s.s_suppkey, -1) AS supp_sk
  FROM orders o LEFT JOIN ia_dim d ON d.c_custkey = o.o_custkey LEFT JOIN b ON b.l_orderkey = o.o_orderkey
  LEFT JOIN supp_dim s ON s.s_suppkey = b.min_suppkey)
SELECT 'ia_sk' AS sk_column, COUNT(*) FILTER (WHERE ia_sk = -1 AND FALSE) AS expected_sentinels,
       COUNT(*) FILTER (WHERE ia_sk = -1) AS unexpected_sentinels FROM f
UNION ALL
SELECT 'supp_sk', COUNT(*) FILTER (WHERE supp_sk = -1 AND min_suppkey IS NULL),
       COUNT(*) FILTER (WHERE supp_sk = -1 AND min_suppkey IS NOT NULL) FROM f""")
def q_sentinel_report(t):
    """Sentinel keys split into expected (no natural key) and unexpected (CHK-6)."""
    b = pick_one(t["lineitem"], "l_orderkey", "l_suppkey", out="min_suppkey").withColumnRenamed("l_orderkey", "o_orderkey")
    f = t["orders"].select("o_orderkey", "o_custkey").join(b, "o_orderkey", "left")
    f = resolve_sk(f, ia_dim(t), {"o_custkey": "c_custkey"}, sk="ia_sk")
    f = resolve_sk(f, supp_dim(t), {"min_suppkey": "s_suppkey"}, sk="supp_sk")
    return Q.sentinel_report(f, ["ia_sk", "supp_sk"], {"supp_sk": F.col("min_suppkey").isNull()})


@query("q_sum_recon", """WITH d AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS detail_sum FROM lineitem GROUP BY 1),
j AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(15,2)) AS total_amt, d.detail_sum FROM orders o LEFT JOIN d ON d.l_orderkey = o.o_orderkey)
SELECT o_orderkey, total_amt, CAST(detail_sum AS DECIMAL(38,2)) AS detail_sum,
       CAST(abs(total_amt - COALESCE(detail_sum, 0)) AS DECIMAL(38,2)) AS diff
FROM j WHERE abs(total_amt - COALESCE(detail_sum, 0)) > 0.01""")
def q_sum_recon(t):
    """Orders whose line sum misses the order total by more than 0.01 (CHK-7)."""
    detail = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), money("l_extendedprice").alias("amt"))
    total = t["orders"].select("o_orderkey", money("o_totalprice").alias("o_totalprice"))
    r = Q.sum_recon(detail, total, ["o_orderkey"], "amt", "o_totalprice", tol=0.01)
    return r.select("o_orderkey", "total_amt", F.col("detail_sum").cast("decimal(38,2)").alias("detail_sum"),
                    F.col("diff").cast("decimal(38,2)").alias("diff"))


@query("q_control_totals", f"""WITH {LEDGER_FACT_SQL}
SELECT fiscal_year, COUNT(*) AS n_rows, CAST(round(SUM(obligated_amt), 0) AS DECIMAL(38,0)) AS obligated_total,
       CAST(round(SUM(net_amt), 0) AS DECIMAL(38,0)) AS net_total FROM ledger_fact GROUP BY 1""")
def q_control_totals(t):
    """Rounded control totals per fiscal year (CHK-8)."""
    return ledger_fact(t).groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("obligated_amt"), 0).cast("decimal(38,0)").alias("obligated_total"),
        F.round(F.sum("net_amt"), 0).cast("decimal(38,0)").alias("net_total"))


@query("q_expected_codes", """SELECT code AS o_orderpriority FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'),
  ('4-NOT SPECIFIED'), ('5-LOW'), ('6-NONE')) v(code) WHERE code NOT IN (SELECT DISTINCT o_orderpriority FROM orders)""")
def q_expected_codes(t):
    """Expected codes absent from the data (CHK-10)."""
    return Q.expected_codes(t["orders"], "o_orderpriority", EXPECTED_PRIORITIES)


@query("q_flag_mismatch", """WITH f AS (SELECT CAST(ts AS DATE) AS day,
    NOT (upper(trim(event_type)) IN ('CLICK', 'VIEW') OR COALESCE(upper(trim(event_type)) LIKE 'PURCH%', FALSE)
         OR COALESCE(upper(trim(event_type)) LIKE '%ERR%', FALSE)) AS all_false FROM events)
SELECT day, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE all_false) AS n_all_false,
  round(100.0 * COUNT(*) FILTER (WHERE all_false) / COUNT(*), 2) AS all_false_pct,
  100.0 * COUNT(*) FILTER (WHERE all_false) / COUNT(*) > 50 AS is_mismatch
FROM f GROUP BY 1""")
def q_flag_mismatch(t):
    """Share of rows with every derived flag false; above 50 % means the
    encoding probably changed (CHK-11)."""
    e = t["events"]
    all_false = ~(flag("event_type", ["CLICK", "VIEW"]) | flag("event_type", "PURCH%") | flag("event_type", "%ERR%"))
    g = e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                     F.count_if(all_false).alias("n_all_false"))
    pct = F.col("n_all_false").cast("double") * 100 / F.col("n_rows")
    return g.select("day", "n_rows", "n_all_false", F.round(pct, 2).alias("all_false_pct"),
                    (pct > 50).alias("is_mismatch"))


@query("q_sla_late", """SELECT o.o_orderpriority, COUNT(*) AS n_lines,
  COUNT(*) FILTER (WHERE date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) > 3) AS n_late,
  CAST(MAX(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))) AS INTEGER) AS max_days
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1""")
def q_sla_late(t):
    """Lines shipped more than 3 days after the order (CHK-13)."""
    j = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate") \
        .join(t["orders"].select("o_orderkey", "o_orderdate", "o_orderpriority"), "o_orderkey")
    days = F.datediff("l_shipdate", "o_orderdate")
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(days > 3).alias("n_late"),
                                            F.max(days).alias("max_days"))


@query("q_preflight", """SELECT * FROM (VALUES
  ('orders', EXISTS (SELECT 1 FROM orders)), ('lineitem', EXISTS (SELECT 1 FROM lineitem)),
  ('customer', EXISTS (SELECT 1 FROM customer)), ('events', EXISTS (SELECT 1 FROM events)),
  ('orders_cancelled', EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'X'))) v(input_name, has_rows)""")
def q_preflight(t):
    """Every upstream non-empty: ``limit(1)`` per input in one union (CHK-15, fix for D-21)."""
    o = t["orders"]
    return Q.preflight({"orders": o, "lineitem": t["lineitem"], "customer": t["customer"], "events": t["events"],
                        "orders_cancelled": o.filter(F.col("o_orderstatus") == "X")})


@query("q_unresolved_sample", f"""WITH {IA_DIM_SQL}
SELECT o_custkey, COUNT(*) AS n_orders FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM ia_dim)
GROUP BY 1 ORDER BY o_custkey LIMIT 20""")
def q_unresolved_sample(t):
    """A bounded sample of raw values that did not resolve (CHK-16): anti-join,
    group, then top 20 by value — the limit is the feature."""
    un = t["orders"].join(ia_dim(t).select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")
    return un.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")).orderBy("o_custkey").limit(20)


@query("q_multi_child", """WITH c AS (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1)
SELECT o.o_orderstatus, COUNT(*) FILTER (WHERE c.n > 1) AS n_multi_line_orders, CAST(MAX(c.n) AS BIGINT) AS max_lines
FROM orders o JOIN c ON c.l_orderkey = o.o_orderkey GROUP BY 1""")
def q_multi_child(t):
    """Orders spanning several lines, counted before any pick-one (CHK-17, fix for D-11)."""
    c = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    j = t["orders"].select("o_orderkey", "o_orderstatus").join(c, "o_orderkey")
    return j.groupBy("o_orderstatus").agg(F.count_if(F.col("n") > 1).alias("n_multi_line_orders"),
                                          F.max("n").alias("max_lines"))


@query("q_period_span", """SELECT o_custkey, MIN(o_orderdate) AS first_order_dt, MAX(o_orderdate) AS last_order_dt,
  COUNT(DISTINCT (year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END) * 100
                 + ((month(o_orderdate) + 2) % 12) + 1) AS n_periods
FROM orders GROUP BY 1""")
def q_period_span(t):
    """Span by date (not by label text) and distinct fiscal periods (CHK-18)."""
    d = F.col("o_orderdate")
    return t["orders"].groupBy("o_custkey").agg(
        F.min(d).alias("first_order_dt"), F.max(d).alias("last_order_dt"),
        F.count_distinct(fiscal_year(d) * 100 + fiscal_month(d)).alias("n_periods"))


@query("q_quality_suite", """WITH l AS (SELECT *, CASE WHEN l_suppkey % 10 = 0 THEN -1 ELSE l_suppkey END AS supp_sk FROM lineitem),
v AS (
  SELECT 'values:l_returnflag' AS chk, l_returnflag AS item, COUNT(*) AS n, 2 AS top FROM l GROUP BY 2
  UNION ALL SELECT 'values:l_linenumber', CAST(l_linenumber AS VARCHAR), COUNT(*), 5 FROM l GROUP BY 2)
SELECT 'unique:line' AS "check", CAST(NULL AS VARCHAR) AS item,
       CAST((SELECT COUNT(*) FROM (SELECT 1 FROM l GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)) AS BIGINT) AS n
UNION ALL
SELECT 'unique:order', NULL, (SELECT COUNT(*) FROM (SELECT 1 FROM l GROUP BY l_orderkey HAVING COUNT(*) > 1))
UNION ALL
SELECT 'sentinel:supp_sk', CASE WHEN l_linestatus = 'F' THEN 'expected' ELSE 'unexpected' END, COUNT(*)
FROM l WHERE supp_sk = -1 GROUP BY 2
UNION ALL
SELECT chk, item, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY chk ORDER BY n DESC, item) AS rn FROM v) WHERE rn <= top""")
def q_quality_suite(t):
    """Two uniqueness checks, a sentinel check and two distributions from one scan (CHK-4, CHK-6, CHK-9)."""
    supp = F.when(F.col("l_suppkey") % 10 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))
    return quality_suite(t["lineitem"].withColumn("supp_sk", supp),
                         unique={"line": ["l_orderkey", "l_linenumber"], "order": ["l_orderkey"]},
                         sentinels={"supp_sk": F.col("l_linestatus") == "F"},
                         distributions={"l_returnflag": 2, "l_linenumber": 5})


@query("q_write_metrics", f"""WITH {LEDGER_FACT_SQL}
SELECT COUNT(*) AS n_rows, CAST(SUM(obligated_amt) AS DECIMAL(38,2)) AS obligated_total,
       CAST(COUNT(*) FILTER (WHERE fiscal_month = 1) AS BIGINT) AS october_rows FROM ledger_fact""")
def q_write_metrics(t):
    """Rows written, a control total and a count, observed by the job that writes the fact (CHK-2, CHK-8, AUD-1)."""
    import uuid

    from gildhall.session import checkpoint_dir
    from gildhall.sources import write_observed
    f = ledger_fact(t)
    spark = f.sparkSession
    _, seen = write_observed(f, f"{checkpoint_dir(spark).rstrip('/')}/metrics-{uuid.uuid4().hex}", {
        "n_rows": F.count(F.lit(1)), "obligated_total": F.sum("obligated_amt").cast("decimal(38,2)"),
        "october_rows": F.count_if(F.col("fiscal_month") == 1)})
    return spark.createDataFrame([tuple(seen[c] for c in ("n_rows", "obligated_total", "october_rows"))],
                                 "n_rows long, obligated_total decimal(38,2), october_rows long")
