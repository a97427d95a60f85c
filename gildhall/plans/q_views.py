"""Reporting-view family (§2.14) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.functions import date_sk, ratio, rules
from gildhall.operators import exact_percentile, preagg_join
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF, money_sum


def aging_rules():
    a = F.col("age_days")
    return [(a <= 365, "0-365"), (a <= 730, "366-730"), (a <= 1095, "731-1095")]


@query("q_aging_buckets", f"""WITH o AS (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS age_days
  FROM orders WHERE o_orderstatus = 'O')
SELECT CASE WHEN age_days <= 365 THEN '0-365' WHEN age_days <= 730 THEN '366-730'
            WHEN age_days <= 1095 THEN '731-1095' ELSE '1096+' END AS aging_bucket,
       COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS open_amt
FROM o GROUP BY 1""")
def q_aging_buckets(t):
    """Open-balance ageing buckets at a fixed as-of (oet.v_udo_aging)."""
    o = t["orders"].filter(F.col("o_orderstatus") == "O") \
        .withColumn("age_days", F.datediff(F.to_date(F.lit(AS_OF)), "o_orderdate"))
    return o.groupBy(rules(F.col("age_days"), aging_rules(), "1096+", normalise=False).alias("aging_bucket")).agg(
        F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("open_amt"))


@query("q_cycle_time", """WITH c AS (SELECT o.o_orderpriority,
    date_diff('day', CAST(o.o_orderdate AS DATE), CAST(MAX(l.l_shipdate) AS DATE)) AS cycle_days
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderpriority, o.o_orderdate)
SELECT o_orderpriority, COUNT(*) AS n_orders,
  CAST(round(quantile_cont(cycle_days, 0.5), 2) AS DECIMAL(10,2)) AS median_days,
  CAST(round(quantile_cont(cycle_days, 0.9), 2) AS DECIMAL(10,2)) AS p90_days,
  CAST(round(AVG(cycle_days), 2) AS DECIMAL(10,2)) AS avg_days
FROM c GROUP BY 1""")
def q_cycle_time(t):
    """Order-to-last-shipment cycle time: exact median / P90 per priority
    (alt.v_acquisition_cycle_time, AGG-4)."""
    o = preagg_join(t["orders"].select("o_orderkey", "o_orderpriority", "o_orderdate"), t["lineitem"],
                    on="o_orderkey", right_on="l_orderkey", aggs=[F.max("l_shipdate").alias("last_ship")])
    c = o.filter(F.col("last_ship").isNotNull()) \
        .withColumn("cycle_days", F.datediff("last_ship", "o_orderdate"))
    p = exact_percentile(c, ["o_orderpriority"], "cycle_days", {"median_days": 0.5, "p90_days": 0.9})
    s = c.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"),
                                         F.round(F.avg("cycle_days"), 2).cast("decimal(10,2)").alias("avg_days"))
    return s.join(p, "o_orderpriority").select(
        "o_orderpriority", "n_orders",
        F.round("median_days", 2).cast("decimal(10,2)").alias("median_days"),
        F.round("p90_days", 2).cast("decimal(10,2)").alias("p90_days"), "avg_days")


@query("q_sla_summary", """WITH j AS (SELECT o.o_orderpriority,
    date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS d
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT o_orderpriority, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE d <= 30) AS n_on_time,
  round(100.0 * COUNT(*) FILTER (WHERE d <= 30) / NULLIF(COUNT(*), 0), 2) AS on_time_pct
FROM j GROUP BY 1""")
def q_sla_summary(t):
    """On-time share with a zero guard (tpp.v_prompt_payment_sla, AGG-3, AGG-11)."""
    j = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate") \
        .join(t["orders"].select("o_orderkey", "o_orderdate", "o_orderpriority"), "o_orderkey")
    g = j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.datediff("l_shipdate", "o_orderdate") <= 30).alias("n_on_time"))
    return g.withColumn("on_time_pct", ratio("n_on_time", "n_lines", 2, pct=True))


@query("q_price_distribution", """SELECT p_type, COUNT(*) AS n_parts,
  CAST(round(quantile_cont(p_retailprice, 0.5), 2) AS DECIMAL(15,2)) AS median_price,
  CAST(round(quantile_cont(p_retailprice, 0.9), 2) AS DECIMAL(15,2)) AS p90_price,
  COUNT(*) FILTER (WHERE p_retailprice > 1500) AS n_premium
FROM part GROUP BY 1""")
def q_price_distribution(t):
    """Price distribution per type (smi.v_bid_price_distribution, AGG-4, AGG-3)."""
    p = t["part"]
    q = exact_percentile(p, ["p_type"], "p_retailprice", {"median_price": 0.5, "p90_price": 0.9})
    s = p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_parts"),
                                F.count_if(F.col("p_retailprice") > 1500).alias("n_premium"))
    return s.join(q, "p_type").select(
        "p_type", "n_parts", F.round("median_price", 2).cast("decimal(15,2)").alias("median_price"),
        F.round("p90_price", 2).cast("decimal(15,2)").alias("p90_price"), "n_premium")


@query("q_workload", """SELECT r.r_name, COUNT(DISTINCT o.o_custkey) AS n_customers, COUNT(DISTINCT o.o_orderkey) AS n_open_orders,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS open_amt
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey WHERE o.o_orderstatus = 'O' GROUP BY 1""")
def q_workload(t):
    """Open workload by region with distinct counts (wpr.v_workload_by_region, AGG-2)."""
    o = t["orders"].filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey", "o_totalprice")
    c = t["customer"].select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = t["nation"].select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    r = t["region"].select("r_regionkey", "r_name")
    j = o.join(c, "o_custkey").join(n, "n_nationkey").join(r, "r_regionkey")
    return j.groupBy("r_name").agg(F.count_distinct("o_custkey").alias("n_customers"),
                                   F.count_distinct("o_orderkey").alias("n_open_orders"),
                                   money_sum("o_totalprice").alias("open_amt"))


@query("q_event_timeline", """SELECT e.event_id, e.ts, CAST(strftime(e.ts, '%Y%m%d') AS INTEGER) AS event_date_sk, e.user_id,
  e.event_type, c.c_name, CAST(e.value AS DECIMAL(15,2)) AS value_amt
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id ORDER BY e.ts, e.event_id""")
def q_event_timeline(t):
    """Chronology joined to the actor, ordered only at presentation
    (cat.v_event_timeline, JON-2, SRT-1): a distributed range sort."""
    e = t["events"].select("event_id", "ts", "user_id", "event_type", "value")
    c = t["customer"].select(F.col("c_custkey").alias("user_id"), "c_name")
    j = e.join(c, "user_id", "left")
    return j.select("event_id", "ts", date_sk("ts").alias("event_date_sk"), "user_id", "event_type", "c_name",
                    F.col("value").cast("decimal(15,2)").alias("value_amt")).orderBy("ts", "event_id")
