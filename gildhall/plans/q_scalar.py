"""Projections, filters, rule tables and scalar functions (§2.2, §2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall import functions as G
from gildhall.operators import preagg_join
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF, DMUL, dmul, ia_dim, money_sum


@query("q_projection", """SELECT p_partkey AS part_id, upper(p_name) AS part_name, p_brand,
  TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_num, p_size,
  CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS size_class,
  CAST(p_retailprice AS DECIMAL(15,2)) AS retail_amt
FROM part""")
def q_projection(t):
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("part_id"), F.upper("p_name").alias("part_name"), "p_brand",
        F.expr("try_cast(substring(p_brand, 7) AS INT)").alias("brand_num"), "p_size",
        G.rules(F.col("p_size"), [(F.col("p_size") < 10, "S"), (F.col("p_size") < 30, "M")], "L",
                normalise=False).alias("size_class"),
        G.money("p_retailprice").alias("retail_amt"))


@query("q_null_handling", """SELECT o_orderkey,
  COALESCE(NULLIF(trim(o_orderstatus), ''), 'UNKNOWN') AS status_cd,
  NULLIF(o_orderstatus, 'P') AS settled_status,
  COALESCE(NULLIF(o_orderstatus, 'P'), NULLIF(substr(o_orderpriority, 3), 'NOT SPECIFIED'), 'UNSPECIFIED') AS status_or_priority,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_num,
  COALESCE(o_orderstatus = 'O', FALSE) AS is_open
FROM orders""")
def q_null_handling(t):
    o = t["orders"]
    return o.select(
        "o_orderkey",
        F.coalesce(G.blank_to_null("o_orderstatus"), F.lit("UNKNOWN")).alias("status_cd"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("settled_status"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")),
                   F.nullif(F.expr("substring(o_orderpriority, 3)"), F.lit("NOT SPECIFIED")),
                   F.lit("UNSPECIFIED")).alias("status_or_priority"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_num"),
        F.coalesce(F.col("o_orderstatus") == "O", F.lit(False)).alias("is_open"))


@query("q_filters", """SELECT p_type, COUNT(*) AS n_parts,
  CAST(SUM(CAST(p_retailprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS retail_amt
FROM part
WHERE p_name IS NOT NULL
  AND (p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
       OR (upper(p_name) LIKE '%RING%' AND p_type NOT IN ('ECONOMY', 'SMALL')))
  AND upper(p_name) NOT LIKE 'RED%'
  AND p_size <> 1
GROUP BY p_type""")
def q_filters(t):
    p = t["part"]
    cond = (F.col("p_name").isNotNull()
            & (F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
               | (F.upper("p_name").like("%RING%") & ~F.col("p_type").isin("ECONOMY", "SMALL")))
            & ~F.upper("p_name").like("RED%")
            & (F.col("p_size") != 1))
    return p.filter(cond).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n_parts"), money_sum("p_retailprice").alias("retail_amt"))


@query("q_holdback", f"""WITH h AS (
  SELECT l_returnflag, l_linestatus, CAST(l_extendedprice AS DECIMAL(15,2)) AS price,
         {DMUL('l_extendedprice', 'l_discount')} AS holdback FROM lineitem)
SELECT l_returnflag, l_linestatus, CAST(SUM(holdback) AS DECIMAL(38,2)) AS holdback_amt,
       CAST(SUM(price - holdback) AS DECIMAL(38,2)) AS net_amt,
       COUNT(*) FILTER (WHERE holdback > 1000) AS n_large_holdback
FROM h GROUP BY 1, 2""")
def q_holdback(t):
    """The holdback is derived once and used twice (PRJ-2)."""
    h = t["lineitem"].select("l_returnflag", "l_linestatus", G.money("l_extendedprice").alias("price"),
                             dmul("l_extendedprice", "l_discount").alias("holdback"))
    return h.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("holdback").cast("decimal(38,2)").alias("holdback_amt"),
        F.sum(F.col("price") - F.col("holdback")).cast("decimal(38,2)").alias("net_amt"),
        F.count_if(F.col("holdback") > 1000).alias("n_large_holdback"))


# Fixed demo rule table: order status + priority → lifecycle phase, first match wins.
PHASE_RULES = [("F-%", "CLOSED"), ("O-1%", "OPEN_URGENT"), ("O-2%", "OPEN_URGENT"), ("O-%", "OPEN"),
               ("P-%", "IN_PROGRESS")]


@query("q_rule_label", """SELECT
  CASE WHEN upper(trim(o_orderstatus || '-' || o_orderpriority)) LIKE 'F-%' THEN 'CLOSED'
       WHEN upper(trim(o_orderstatus || '-' || o_orderpriority)) LIKE 'O-1%' THEN 'OPEN_URGENT'
       WHEN upper(trim(o_orderstatus || '-' || o_orderpriority)) LIKE 'O-2%' THEN 'OPEN_URGENT'
       WHEN upper(trim(o_orderstatus || '-' || o_orderpriority)) LIKE 'O-%' THEN 'OPEN'
       WHEN upper(trim(o_orderstatus || '-' || o_orderpriority)) LIKE 'P-%' THEN 'IN_PROGRESS'
       ELSE 'UNKNOWN' END AS phase,
  CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' ELSE o_orderstatus END AS status_desc,
  COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS total_amt
FROM orders GROUP BY 1, 2""")
def q_rule_label(t):
    o = t["orders"]
    code = F.concat_ws("-", "o_orderstatus", "o_orderpriority")
    status_desc = G.rules("o_orderstatus", [(["F"], "Fulfilled"), (["O"], "Open"), (["P"], "Partial")],
                          default=F.col("o_orderstatus"), normalise=False)
    return o.groupBy(G.rules(code, PHASE_RULES, "UNKNOWN").alias("phase"), status_desc.alias("status_desc")).agg(
        F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("total_amt"))


@query("q_rule_flags", """SELECT event_type,
  upper(trim(event_type)) IN ('CLICK', 'VIEW') AS is_engagement,
  COALESCE(upper(trim(event_type)) LIKE 'PURCH%', FALSE) AS is_conversion,
  COALESCE(upper(trim(event_type)) LIKE '%ERR%', FALSE) AS is_failure,
  COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS value_amt
FROM events GROUP BY 1, 2, 3, 4""")
def q_rule_flags(t):
    e = t["events"]
    return e.groupBy(
        "event_type",
        G.flag("event_type", ["CLICK", "VIEW"]).alias("is_engagement"),
        G.flag("event_type", "PURCH%").alias("is_conversion"),
        G.flag("event_type", "%ERR%").alias("is_failure"),
    ).agg(F.count(F.lit(1)).alias("n_events"), money_sum("value").alias("value_amt"))


@query("q_presence_status", """WITH l AS (
  SELECT l_orderkey, MIN(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS first_return_dt,
         MAX(l_shipdate) FILTER (WHERE l_linestatus = 'O') AS last_open_dt
  FROM lineitem GROUP BY 1)
SELECT CASE WHEN l.first_return_dt IS NOT NULL AND l.last_open_dt IS NOT NULL THEN 'FINAL'
            WHEN l.first_return_dt IS NOT NULL OR l.last_open_dt IS NOT NULL THEN 'PENDING_REQUEST'
            ELSE 'DRAFT' END AS amendment_status, COUNT(*) AS n_orders
FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def q_presence_status(t):
    """Status from presence of dates (PRJ-9): FINAL / PENDING_REQUEST / DRAFT."""
    lines = t["lineitem"]
    o = preagg_join(t["orders"], lines, on="o_orderkey", right_on="l_orderkey", aggs=[
        F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("first_return_dt"),
        F.max(F.when(F.col("l_linestatus") == "O", F.col("l_shipdate"))).alias("last_open_dt")])
    a, b = F.col("first_return_dt").isNotNull(), F.col("last_open_dt").isNotNull()
    status = F.when(a & b, "FINAL").when(a | b, "PENDING_REQUEST").otherwise("DRAFT")
    return o.groupBy(status.alias("amendment_status")).agg(F.count(F.lit(1)).alias("n_orders"))


@query("q_posting_priority", """WITH ia AS (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0),
l AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT CASE WHEN ia.c_custkey IS NOT NULL AND l.l_orderkey IS NOT NULL THEN 1
            WHEN ia.c_custkey IS NOT NULL THEN 2 WHEN l.l_orderkey IS NOT NULL THEN 3 ELSE 4 END AS posting_priority,
       COUNT(*) AS n_orders
FROM orders o LEFT JOIN ia ON ia.c_custkey = o.o_custkey LEFT JOIN l ON l.l_orderkey = o.o_orderkey
GROUP BY 1""")
def q_posting_priority(t):
    """Priority from which source matched (PRJ-10): both, customer only, lines only, none."""
    ia = ia_dim(t).select(F.col("c_custkey").alias("_ia_key"), F.lit(True).alias("_in_ia"))
    lines = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey")).distinct() \
        .withColumn("_in_lines", F.lit(True))
    o = t["orders"].join(ia, F.col("o_custkey") == F.col("_ia_key"), "left").join(lines, "o_orderkey", "left")
    a, b = F.col("_in_ia").isNotNull(), F.col("_in_lines").isNotNull()
    prio = F.when(a & b, 1).when(a, 2).when(b, 3).otherwise(4)
    return o.groupBy(prio.alias("posting_priority")).agg(F.count(F.lit(1)).alias("n_orders"))


def _month_text():
    k = F.col("o_orderkey")
    m = F.month("o_orderdate")
    return (F.when(k % 7 == 0, F.lit("XX"))
             .when(k % 5 == 0, F.concat(F.lit(" "), F.lower(F.date_format("o_orderdate", "MMM")), F.lit(" ")))
             .when(k % 3 == 0, m.cast("string"))
             .when(k % 3 == 1, F.lpad(m.cast("string"), 2, "0"))
             .otherwise(F.upper(F.date_format("o_orderdate", "MMM"))))


@query("q_month_decode", """WITH x AS (
  SELECT o_orderdate,
    CASE WHEN o_orderkey % 7 = 0 THEN 'XX'
         WHEN o_orderkey % 5 = 0 THEN ' ' || lower(strftime(o_orderdate, '%b')) || ' '
         WHEN o_orderkey % 3 = 0 THEN CAST(month(o_orderdate) AS VARCHAR)
         WHEN o_orderkey % 3 = 1 THEN lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
         ELSE upper(strftime(o_orderdate, '%b')) END AS month_text FROM orders),
d AS (SELECT *, CASE WHEN regexp_matches(month_text, '^[0-9]+$') THEN TRY_CAST(month_text AS INTEGER)
    ELSE CASE upper(trim(month_text)) WHEN 'JAN' THEN 1 WHEN 'FEB' THEN 2 WHEN 'MAR' THEN 3 WHEN 'APR' THEN 4
      WHEN 'MAY' THEN 5 WHEN 'JUN' THEN 6 WHEN 'JUL' THEN 7 WHEN 'AUG' THEN 8 WHEN 'SEP' THEN 9
      WHEN 'OCT' THEN 10 WHEN 'NOV' THEN 11 WHEN 'DEC' THEN 12 END END AS month_int FROM x)
SELECT month_text, month_int, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE month_int = month(o_orderdate)) AS n_match
FROM d GROUP BY 1, 2""")
def q_month_decode(t):
    """Month text in three forms ('1', '01', 'JAN', ' jan ', junk) back to a number (FN-13, FLT-3)."""
    o = t["orders"].withColumn("month_text", _month_text())
    d = o.withColumn("month_int", G.month_number("month_text"))
    return d.groupBy("month_text", "month_int").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("month_int") == F.month("o_orderdate")).alias("n_match"))


@query("q_code_parse", """SELECT c_custkey,
  CASE WHEN length(c_name) = 18 AND regexp_matches(c_name, '^Customer#[0-9]+$') THEN substr(c_name, 1, 8) END AS name_prefix,
  CASE WHEN length(c_name) = 18 AND regexp_matches(c_name, '^Customer#[0-9]+$') THEN TRY_CAST(substr(c_name, 10, 9) AS BIGINT) END AS seq_num,
  CASE WHEN length(c_name) > 9 THEN substr(c_name, 10) END AS suffix,
  length(c_name) = 18 AND regexp_matches(c_name, '^Customer#[0-9]+$') AS is_valid
FROM customer""")
def q_code_parse(t):
    """Positional parse with a length guard (FN-17, FN-18)."""
    c = t["customer"]
    ok = (F.length("c_name") == 18) & F.col("c_name").rlike("^Customer#[0-9]+$")
    return c.select(
        "c_custkey",
        F.when(ok, F.substring("c_name", 1, 8)).alias("name_prefix"),
        F.when(ok, F.substring("c_name", 10, 9).try_cast("bigint")).alias("seq_num"),
        G.suffix_after("c_name", 9).alias("suffix"),
        ok.alias("is_valid"))


@query("q_code_compose", """WITH x AS (
  SELECT c.c_custkey, c.c_name, n.n_name, r.r_name,
         CASE WHEN c.c_custkey % 7 = 0 THEN '  ' ELSE c.c_mktsegment END AS seg,
         CASE WHEN c.c_custkey % 3 = 0 THEN CAST(c.c_nationkey AS VARCHAR) ELSE '' END AS ext
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey)
SELECT c_custkey,
  NULLIF(concat_ws('-', NULLIF(trim(n_name), ''), NULLIF(trim(r_name), ''), NULLIF(trim(seg), '')), '') AS composite_cd,
  concat_ws(' ', NULLIF(trim(c_name), ''), NULLIF(trim(seg), ''), NULLIF(trim(r_name), '')) AS display_name,
  CASE WHEN NULLIF(trim(ext), '') IS NOT NULL THEN 'PH-' || CAST(c_custkey AS VARCHAR) || ' x' || trim(ext)
       ELSE 'PH-' || CAST(c_custkey AS VARCHAR) END AS phone
FROM x""")
def q_code_compose(t):
    """Composite code skipping blank parts, name from parts, phone with extension (FN-14..16)."""
    c = t["customer"]
    n = t["nation"]
    r = t["region"]
    x = (c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
          .select("c_custkey", "c_name", "n_name", "r_name",
                  F.when(F.col("c_custkey") % 7 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("seg"),
                  F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey").cast("string"))
                   .otherwise(F.lit("")).alias("ext")))
    return x.select(
        "c_custkey",
        G.compose_code("-", "n_name", "r_name", "seg").alias("composite_cd"),
        G.full_name("c_name", "seg", "r_name").alias("display_name"),
        G.phone_with_ext(F.concat(F.lit("PH-"), F.col("c_custkey").cast("string")), "ext").alias("phone"))


@query("q_date_keys", f"""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_sk,
  CAST(strptime(CAST(CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS VARCHAR), '%Y%m%d') AS DATE) AS order_date,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS age_days
FROM orders""")
def q_date_keys(t):
    """yyyyMMdd key and back (FN-8, FN-9), age in days at a fixed as-of (FN-10, FN-11)."""
    o = t["orders"].select("o_orderkey", G.date_sk("o_orderdate").alias("order_date_sk"), "o_orderdate")
    return o.select("o_orderkey", "order_date_sk", G.from_date_sk("order_date_sk").alias("order_date"),
                    G.days_between(F.to_date(F.lit(AS_OF)), "o_orderdate").alias("age_days"))


@query("q_variance_flag", """WITH l AS (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS actual_amt
  FROM lineitem GROUP BY 1),
x AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(15,2)) AS plan_amt, COALESCE(l.actual_amt, 0) AS actual_amt
  FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey)
SELECT o_orderkey, plan_amt, actual_amt,
  CASE WHEN plan_amt IS NULL OR plan_amt = 0 THEN NULL ELSE abs(actual_amt - plan_amt) <= abs(plan_amt) * 0.10 END AS on_plan,
  round(100.0 * CAST(actual_amt - plan_amt AS DOUBLE) / NULLIF(CAST(plan_amt AS DOUBLE), 0), 2) AS variance_pct
FROM x""")
def q_variance_flag(t):
    """Order total vs sum of lines, ±10 %, NULL when there is no base (FN-22, FN-23)."""
    o = preagg_join(t["orders"].select("o_orderkey", G.money("o_totalprice").alias("plan_amt")),
                    t["lineitem"], on="o_orderkey", right_on="l_orderkey",
                    aggs=[money_sum("l_extendedprice").alias("actual_amt")])
    o = o.withColumn("actual_amt", F.coalesce("actual_amt", F.lit(0).cast("decimal(38,2)")))
    return o.select(
        "o_orderkey", "plan_amt", "actual_amt",
        G.within("actual_amt", "plan_amt", 0.10).alias("on_plan"),
        G.ratio(F.col("actual_amt") - F.col("plan_amt"), F.col("plan_amt"), 2, pct=True).alias("variance_pct"))
