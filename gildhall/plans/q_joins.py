"""Join operators on the test tables (§2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.operators import (
    cast_join, const_lookup, decode, first_hit, pick_one, period_contains, poly_ref, preagg_join,
    prefix_join, resolve_sk, valid_rows,
)
from gildhall.operators.joins import like_literal
from gildhall.plans.registry import query
from gildhall.plans.standins import (
    AS_OF, CUST_HISTORY_SQL, IA_DIM_SQL, cust_history, ia_dim, money_sum, supp_dim,
)

SUPP_DIM_SQL = "supp_dim AS (SELECT *, s_suppkey AS supp_sk FROM supplier WHERE s_suppkey % 10 <> 0)"


@query("q_lookup_left", f"""WITH {IA_DIM_SQL}
SELECT o.o_orderkey, o.o_custkey, d.c_name, d.c_mktsegment FROM orders o LEFT JOIN ia_dim d ON d.c_custkey = o.o_custkey""")
def q_lookup_left(t):
    d = ia_dim(t).select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t["orders"].select("o_orderkey", "o_custkey").join(d, "o_custkey", "left")


@query("q_resolve_sk", f"""WITH {IA_DIM_SQL}
SELECT o.o_orderkey, o.o_custkey, COALESCE(d.ia_sk, -1) AS ia_sk
FROM orders o LEFT JOIN ia_dim d ON d.c_custkey = o.o_custkey AND d.is_current_flag""")
def q_resolve_sk(t):
    o = t["orders"].select("o_orderkey", "o_custkey")
    return resolve_sk(o, ia_dim(t), {"o_custkey": "c_custkey"}, sk="ia_sk")


@query("q_current_join", f"""WITH {CUST_HISTORY_SQL}
SELECT c.c_mktsegment, COUNT(*) AS n_orders,
       CAST(SUM(CAST(c.c_acctbal AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS balance_amt
FROM orders o JOIN cust_history c ON c.c_custkey = o.o_custkey AND c.is_current_flag
GROUP BY 1""")
def q_current_join(t):
    """Join to the current version only: filter first, then join (FLT-7)."""
    cur = cust_history(t).filter(F.col("is_current_flag")).select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    j = t["orders"].select("o_custkey").join(cur, "o_custkey")
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"),
                                         money_sum("c_acctbal").alias("balance_amt"))


@query("q_decode", """WITH lk AS (SELECT DISTINCT p_type AS code, lower(p_type) || ' parts' AS descr FROM part WHERE p_type <> 'SMALL')
SELECT p.p_partkey, p.p_type, COALESCE(lk.descr, p.p_type) AS type_desc FROM part p LEFT JOIN lk ON lk.code = p.p_type""")
def q_decode(t):
    """Code → description, raw code kept when the code is unknown (JON-4)."""
    p = t["part"]
    lk = p.filter(F.col("p_type") != "SMALL").select(
        F.col("p_type").alias("code"), F.concat(F.lower("p_type"), F.lit(" parts")).alias("descr")).distinct()
    return decode(p.select("p_partkey", "p_type"), lk, "p_type", "descr", out="type_desc", lookup_code="code")


@query("q_multi_hop", """WITH l AS (SELECT l_orderkey, COUNT(*) AS n_lines,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS amt FROM lineitem GROUP BY 1)
SELECT n.n_name, COUNT(*) AS n_orders, CAST(SUM(l.n_lines) AS BIGINT) AS n_lines, CAST(SUM(l.amt) AS DECIMAL(38,2)) AS line_amt
FROM l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1""")
def q_multi_hop(t):
    """line → order → customer → nation, lines pre-aggregated to the order first (JON-5)."""
    lines = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), money_sum("l_extendedprice").alias("amt"))
    o = t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = t["customer"].select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = t["nation"].select("n_nationkey", "n_name")
    j = lines.join(o, "o_orderkey").join(c, "c_custkey").join(n, "n_nationkey")
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("n_lines").cast("bigint").alias("n_lines"),
                                   F.sum("amt").cast("decimal(38,2)").alias("line_amt"))


@query("q_bridge_min", f"""WITH {SUPP_DIM_SQL},
b AS (SELECT l_orderkey, MIN(l_suppkey) AS min_suppkey FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, b.min_suppkey, COALESCE(d.supp_sk, -1) AS supp_sk
FROM orders o LEFT JOIN b ON b.l_orderkey = o.o_orderkey LEFT JOIN supp_dim d ON d.s_suppkey = b.min_suppkey""")
def q_bridge_min(t):
    """Many-to-many bridge reduced to MIN per order, then resolved (JON-6)."""
    b = pick_one(t["lineitem"], "l_orderkey", "l_suppkey", how="min", out="min_suppkey") \
        .withColumnRenamed("l_orderkey", "o_orderkey")
    o = t["orders"].select("o_orderkey").join(b, "o_orderkey", "left")
    return resolve_sk(o, supp_dim(t), {"min_suppkey": "s_suppkey"}, sk="supp_sk")


@query("q_preagg_join", """WITH l AS (SELECT l_orderkey, COUNT(*) AS n_lines,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS line_amt FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, o.o_orderstatus, COALESCE(l.n_lines, 0) AS n_lines, COALESCE(l.line_amt, 0) AS line_amt
FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey""")
def q_preagg_join(t):
    """Aggregate the many side to the join grain, then join: no fan-out (JON-7)."""
    return preagg_join(t["orders"].select("o_orderkey", "o_orderstatus"), t["lineitem"], on="o_orderkey",
                       right_on="l_orderkey",
                       aggs=[F.count(F.lit(1)).alias("n_lines"), money_sum("l_extendedprice").alias("line_amt")],
                       fill={"n_lines": 0, "line_amt": 0})


@query("q_period_contain", """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) AS n
  FROM events GROUP BY 1, 2),
w AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week_start, MIN(ts) AS p_start, MAX(ts) AS p_end
  FROM events GROUP BY 1, 2)
SELECT w.user_id, w.week_start, COUNT(*) AS n_days, CAST(SUM(d.n) AS BIGINT) AS n_events
FROM d JOIN w ON w.user_id = d.user_id AND w.p_start <= d.first_ts AND d.last_ts <= w.p_end
GROUP BY 1, 2""")
def q_period_contain(t):
    """Activity days contained in weekly sessions: equi-join + range residual (JON-8)."""
    e = t["events"]
    days = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    weeks = e.groupBy("user_id", F.to_date(F.date_trunc("week", "ts")).alias("week_start")).agg(
        F.min("ts").alias("p_start"), F.max("ts").alias("p_end"))
    j = period_contains(days, weeks, "user_id", "first_ts", "last_ts", "p_start", "p_end")
    return j.groupBy("user_id", "week_start").agg(F.count(F.lit(1)).alias("n_days"),
                                                  F.sum("n").cast("bigint").alias("n_events"))


@query("q_valid_lookup", f"""WITH nat AS (SELECT *, CASE WHEN n_nationkey % 5 = 0 THEN DATE '2001-01-01'
    WHEN n_nationkey % 5 = 1 THEN DATE '2003-01-01' END AS inactive_dt FROM nation),
v AS (SELECT * FROM nat WHERE inactive_dt IS NULL OR inactive_dt > DATE '{AS_OF}')
SELECT c.c_custkey, c.c_nationkey, v.n_name FROM customer c LEFT JOIN v ON v.n_nationkey = c.c_nationkey""")
def q_valid_lookup(t):
    """Validity filter applied to the lookup before the outer join (JON-9)."""
    k = F.col("n_nationkey")
    nat = t["nation"].withColumn("inactive_dt", F.when(k % 5 == 0, F.to_date(F.lit("2001-01-01")))
                                 .when(k % 5 == 1, F.to_date(F.lit("2003-01-01"))))
    v = valid_rows(nat, "inactive_dt", AS_OF).select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t["customer"].select("c_custkey", "c_nationkey").join(v, "c_nationkey", "left")


@query("q_cast_join", """WITH o AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'C' || CAST(o_custkey AS VARCHAR)
    ELSE CAST(o_custkey AS VARCHAR) END AS cust_ref FROM orders)
SELECT c.c_mktsegment, COUNT(*) AS n_orders FROM o LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = o.cust_ref
GROUP BY 1""")
def q_cast_join(t):
    """Reference held as text on one side: both sides cast once (JON-16)."""
    o = t["orders"].select(F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
                           .otherwise(F.col("o_custkey").cast("string")).alias("cust_ref"))
    j = cast_join(o, t["customer"].select("c_custkey", "c_mktsegment"), "cust_ref", "c_custkey", "string")
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"))


@query("q_prefix_join", """WITH c AS (SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || CAST(c_custkey AS VARCHAR) AS account_cd FROM customer),
a AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS agency_cd, n_name AS agency_name FROM nation WHERE n_nationkey % 4 <> 3)
SELECT c.c_custkey, c.account_cd, a.agency_name FROM c LEFT JOIN a ON a.agency_cd = substr(c.account_cd, 1, 2)""")
def q_prefix_join(t):
    """``LEFT(code, 2) = agency_code`` as a derived equi-join key (JON-17)."""
    c = t["customer"].select("c_custkey", F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
                                                   F.col("c_custkey").cast("string")).alias("account_cd"))
    a = t["nation"].filter(F.col("n_nationkey") % 4 != 3).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("agency_cd"), F.col("n_name").alias("agency_name"))
    return prefix_join(c, a, "account_cd", 2, "agency_cd", ["agency_name"])


@query("q_two_path", f"""WITH {IA_DIM_SQL}, {SUPP_DIM_SQL},
b AS (SELECT l_orderkey, MIN(l_suppkey) AS min_suppkey FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, COALESCE(d.c_name, s.s_name) AS partner_name
FROM orders o LEFT JOIN ia_dim d ON d.c_custkey = o.o_custkey
LEFT JOIN b ON b.l_orderkey = o.o_orderkey LEFT JOIN supp_dim s ON s.s_suppkey = b.min_suppkey""")
def q_two_path(t):
    """Two lookup paths, first hit wins (JON-18)."""
    b = pick_one(t["lineitem"], "l_orderkey", "l_suppkey", out="min_suppkey").withColumnRenamed("l_orderkey", "o_orderkey")
    o = t["orders"].select("o_orderkey", "o_custkey").join(b, "o_orderkey", "left")
    out = first_hit(o, [(ia_dim(t), {"o_custkey": "c_custkey"}, "c_name"),
                        (supp_dim(t), {"min_suppkey": "s_suppkey"}, "s_name")], out="partner_name")
    return out.select("o_orderkey", "partner_name")


def _table_code():
    e = F.col("event_type")
    return (F.when(e == "purchase", "CUST_IA").when(e == "signup", "CUSTOMER").when(e == "click", "SUPP_LINK")
             .when(e == "view", "SUPPLIER").when(e == "error", "MEDIA"))


@query("q_poly_ref", f"""WITH {IA_DIM_SQL}, {SUPP_DIM_SQL},
e AS (SELECT event_id, user_id, CASE event_type WHEN 'purchase' THEN 'CUST_IA' WHEN 'signup' THEN 'CUSTOMER'
    WHEN 'click' THEN 'SUPP_LINK' WHEN 'view' THEN 'SUPPLIER' WHEN 'error' THEN 'MEDIA' END AS table_code FROM events)
SELECT e.event_id, e.table_code, d.ia_sk AS cust_sk, s.supp_sk
FROM e LEFT JOIN ia_dim d ON d.c_custkey = e.user_id AND (upper(e.table_code) LIKE '%\\_IA' ESCAPE '\\' OR e.table_code = 'CUSTOMER')
LEFT JOIN supp_dim s ON s.s_suppkey = e.user_id AND upper(e.table_code) LIKE 'SUPP%'""")
def q_poly_ref(t):
    """The table code decides which dimension the id points to (JON-10, JON-11).
    The underscore is escaped, so 'MEDIA' does not match '%_IA' (fix for D-28)."""
    e = t["events"].select("event_id", "user_id", _table_code().alias("table_code"))
    code = F.upper(F.col("table_code"))
    cust = code.like("%" + like_literal("_IA")) | (F.col("table_code") == "CUSTOMER")
    return poly_ref(e, "table_code", "user_id", {
        "cust_sk": (cust, ia_dim(t), "c_custkey", "ia_sk"),
        "supp_sk": ("SUPP%", supp_dim(t), "s_suppkey", "supp_sk"),
    }).select("event_id", "table_code", "cust_sk", "supp_sk")


@query("q_const_lookup", """SELECT o_orderstatus, (SELECT MAX(r_regionkey) FROM region WHERE upper(r_name) = 'EUROPE') AS r_regionkey,
  (SELECT MAX(r_name) FROM region WHERE upper(r_name) = 'EUROPE') AS r_name, COUNT(*) AS n_orders
FROM orders GROUP BY 1""")
def q_const_lookup(t):
    """Constant-key lookup as scalar subqueries, no join (JON-12)."""
    o = const_lookup(t["orders"], t["region"], F.upper("r_name") == "EUROPE", ["r_regionkey", "r_name"])
    return o.groupBy("o_orderstatus", "r_regionkey", "r_name").agg(F.count(F.lit(1)).alias("n_orders"))


@query("q_fact_fact", """WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS order_amt FROM orders GROUP BY 1, 2),
l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(month(l_shipdate) AS INTEGER) AS mo,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS line_amt FROM lineitem GROUP BY 1, 2)
SELECT o.yr, o.mo, o.order_amt, COALESCE(l.line_amt, 0) AS line_amt FROM o LEFT JOIN l ON l.yr = o.yr AND l.mo = o.mo""")
def q_fact_fact(t):
    """Fact-to-fact: both sides aggregated to the month before the join (JON-20, fix for D-9)."""
    o = t["orders"].groupBy(F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo")).agg(
        money_sum("o_totalprice").alias("order_amt"))
    return preagg_join(o, t["lineitem"].withColumns({"yr": F.year("l_shipdate"), "mo": F.month("l_shipdate")}),
                       on=["yr", "mo"], aggs=[money_sum("l_extendedprice").alias("line_amt")], fill={"line_amt": 0})




@query("q_bucketed_resolve", """WITH award AS (SELECT o_orderkey, o_orderstatus, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS award_sk
  FROM orders WHERE o_orderkey % 10 <> 0),
closeout AS (SELECT l_orderkey, ROW_NUMBER() OVER (ORDER BY l_orderkey) AS closeout_sk, MAX(l_shipdate) AS last_ship
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey)
SELECT l.l_orderkey, l.l_linenumber, COALESCE(a.award_sk, -1) AS award_sk, a.o_orderstatus AS award_status,
       COALESCE(c.closeout_sk, -1) AS closeout_sk, c.last_ship
FROM lineitem l LEFT JOIN award a ON a.o_orderkey = l.l_orderkey LEFT JOIN closeout c ON c.l_orderkey = l.l_orderkey""")
def q_bucketed_resolve(t):
    """Lines and two dimensions written in the same buckets of the order key: both keys are resolved, and both
    dimensions' attributes carried, by merging buckets, without a shuffle of the lines (JON-3, JON-5)."""
    import uuid

    from gildhall.operators import assign_sk
    from gildhall.session import checkpoint_dir
    from gildhall.sources.bucketed import Lookup, resolve_bucketed, write_bucketed
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate")
    spark = lines.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/bucketed-{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))   # what the cluster is sized for
    award = assign_sk(t["orders"].where("o_orderkey % 10 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("status")),
                      ["o_orderkey"], name="award_sk")
    closeout = assign_sk(lines.where("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped")),
                         ["l_orderkey"], name="closeout_sk")
    fact = write_bucketed(lines.select("l_orderkey", "l_linenumber"), f"{root}/lines", "l_orderkey", buckets)
    out = resolve_bucketed(fact, [
        Lookup(write_bucketed(award, f"{root}/award", "o_orderkey", buckets), "award_sk", carry={"status": "award_status"}),
        Lookup(write_bucketed(closeout, f"{root}/closeout", "l_orderkey", buckets), "closeout_sk", carry={"shipped": "last_ship"})])
    return out.select("l_orderkey", "l_linenumber", "award_sk", "award_status", "closeout_sk", "last_ship")
