"""Keep-one family, ranks, LAG deltas (§2.5), set operations (§2.7), top-k (§2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.operators import delta, keep_one, latest_flag, rank_by_agg, subtype_union, union_shapes
from gildhall.plans.registry import query
from gildhall.plans.standins import DMUL, dmul, money_sum

LINE_COLS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


@query("q_keep_latest", """SELECT o_custkey, o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(15,2)) AS total_amt
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def q_keep_latest(t):
    """Latest order per customer, ties by key (WIN-1, WIN-3)."""
    k = keep_one(t["orders"], ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return k.select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(15,2)").alias("total_amt"))


@query("q_keep_priority", """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def q_keep_priority(t):
    """Computed priority: open orders first, then oldest, then key (WIN-2, WIN-10)."""
    active_first = F.when(F.col("o_orderstatus") == "O", 0).otherwise(1)
    k = keep_one(t["orders"], ["o_custkey"], [active_first, F.col("o_orderdate"), F.col("o_orderkey")])
    return k.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")


@query("q_first_child", f"""WITH f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
      ORDER BY {', '.join(LINE_COLS)}) AS rn FROM lineitem) WHERE rn = 1)
SELECT o.o_orderkey, o.o_orderstatus, f.l_linenumber AS first_linenumber, f.l_partkey AS first_partkey,
       f.l_suppkey AS first_suppkey
FROM orders o JOIN f ON f.l_orderkey = o.o_orderkey""")
def q_first_child(t):
    """First line per order by line number with a total tie-break, joined to the order (WIN-4)."""
    f = keep_one(t["lineitem"], ["l_orderkey"], LINE_COLS).select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("first_linenumber"),
        F.col("l_partkey").alias("first_partkey"), F.col("l_suppkey").alias("first_suppkey"))
    return t["orders"].select("o_orderkey", "o_orderstatus").join(f, "o_orderkey")


@query("q_ingest_dedup", """WITH raw AS (
  SELECT event_id, user_id, value, ts AS _ingested_at FROM events
  UNION ALL
  SELECT event_id, user_id, value + 1, ts + INTERVAL 1 HOUR FROM events WHERE event_id % 3 = 0)
SELECT event_id, user_id, CAST(value AS DECIMAL(15,2)) AS value_amt, _ingested_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY _ingested_at DESC, value DESC) AS rn FROM raw)
WHERE rn = 1""")
def q_ingest_dedup(t):
    """Re-ingested rows: keep the latest *row* per id, not the id (WIN-5, fix for D-12)."""
    e = t["events"]
    raw = e.select("event_id", "user_id", "value", F.col("ts").alias("_ingested_at")).unionByName(
        e.filter(F.col("event_id") % 3 == 0).select(
            "event_id", "user_id", (F.col("value") + 1).alias("value"),
            (F.col("ts") + F.expr("interval 1 hour")).alias("_ingested_at")))
    k = keep_one(raw, ["event_id"], [F.col("_ingested_at").desc(), F.col("value").desc()])
    return k.select("event_id", "user_id", F.col("value").cast("decimal(15,2)").alias("value_amt"), "_ingested_at")


@query("q_latest_flag", """SELECT o_orderkey, o_custkey,
  o_orderdate = MAX(o_orderdate) OVER (PARTITION BY o_custkey) AS is_latest FROM orders""")
def q_latest_flag(t):
    """Partition maximum as an "is latest" flag (WIN-9)."""
    return latest_flag(t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate") \
        .select("o_orderkey", "o_custkey", "is_latest")


@query("q_burn_order", """WITH g AS (SELECT c.c_nationkey, l.l_suppkey, MIN(l.l_orderkey) AS first_orderkey
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY 1, 2)
SELECT c_nationkey, l_suppkey, first_orderkey,
  ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY first_orderkey, l_suppkey) AS burn_rank FROM g""")
def q_burn_order(t):
    """Suppliers ranked per customer nation by their first order (WIN-6)."""
    lines = t["lineitem"].select("l_orderkey", "l_suppkey")
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    c = t["customer"].select("c_custkey", "c_nationkey")
    j = lines.join(o, "l_orderkey").join(c, "c_custkey")
    r = rank_by_agg(j, ["l_suppkey"], ["c_nationkey"], [F.min("l_orderkey").alias("first_orderkey")],
                    [F.col("first_orderkey"), F.col("l_suppkey")], name="burn_rank")
    return r.select("c_nationkey", "l_suppkey", "first_orderkey", "burn_rank")


@query("q_lag_delta", """SELECT o_custkey, o_orderkey,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) - LAG(CAST(o_totalprice AS DECIMAL(15,2))) OVER w AS DECIMAL(16,2)) AS total_delta,
  CAST(date_diff('day', LAG(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since_prev
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def q_lag_delta(t):
    """Order total and date deltas per customer (WIN-7, WIN-8), LAG as a rank equi-join."""
    o = t["orders"].select("o_custkey", "o_orderkey", "o_orderdate",
                           F.col("o_totalprice").cast("decimal(15,2)").alias("amt"))
    d = delta(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], {"amt": "total_delta"},
              {"o_orderdate": "days_since_prev"})
    return d.select("o_custkey", "o_orderkey", F.col("total_delta").cast("decimal(16,2)").alias("total_delta"),
                    "days_since_prev")


@query("q_event_union", """SELECT 'event' AS source, user_id AS entity_id, event_id AS seq, event_type AS kind,
  CAST(value AS DECIMAL(15,2)) AS amount, CAST(NULL AS INTEGER) AS text_len FROM events
UNION ALL
SELECT 'conversation', conv_id, turn, role, CAST(NULL AS DECIMAL(15,2)), CAST(length(text) AS INTEGER) FROM conversations""")
def q_event_union(t):
    """Heterogeneous branches into one event shape by name (SET-1)."""
    e = t["events"].select(F.lit("event").alias("source"), F.col("user_id").alias("entity_id"),
                           F.col("event_id").alias("seq"), F.col("event_type").alias("kind"),
                           F.col("value").cast("decimal(15,2)").alias("amount"))
    c = t["conversations"].select(F.lit("conversation").alias("source"), F.col("conv_id").alias("entity_id"),
                                  F.col("turn").alias("seq"), F.col("role").alias("kind"),
                                  F.length("text").alias("text_len"))
    return union_shapes([e, c]).select("source", "entity_id", "seq", "kind", "amount", "text_len")


@query("q_subtype_union", f"""WITH u AS (
  SELECT 'ACCEPTED' AS subtype, l_linestatus AS status, CAST(l_extendedprice AS DECIMAL(15,2)) AS amount FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL
  SELECT 'NEW', l_linestatus, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) - {DMUL('l_extendedprice', 'l_discount')} AS DECIMAL(15,2)) FROM lineitem WHERE l_returnflag = 'N'
  UNION ALL
  SELECT 'RETURNED', l_linestatus, -CAST(l_extendedprice AS DECIMAL(15,2)) FROM lineitem WHERE l_returnflag = 'R')
SELECT subtype, status, COUNT(*) AS n_lines, CAST(SUM(amount) AS DECIMAL(38,2)) AS amount FROM u GROUP BY 1, 2""")
def q_subtype_union(t):
    """Three subtype branches with literal tags, one generic union (SET-2)."""
    li = t["lineitem"]
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    u = subtype_union([
        (li.filter(F.col("l_returnflag") == "A"), "ACCEPTED", {"status": F.col("l_linestatus"), "amount": price}),
        (li.filter(F.col("l_returnflag") == "N"), "NEW",
         {"status": F.col("l_linestatus"), "amount": (price - dmul("l_extendedprice", "l_discount")).cast("decimal(15,2)")}),
        (li.filter(F.col("l_returnflag") == "R"), "RETURNED", {"status": F.col("l_linestatus"), "amount": -price}),
    ])
    return u.groupBy("subtype", "status").agg(F.count(F.lit(1)).alias("n_lines"),
                                              F.sum("amount").cast("decimal(38,2)").alias("amount"))


@query("q_top_values", """SELECT p.p_brand, COUNT(*) AS n_lines,
  CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS line_amt
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY 1 ORDER BY n_lines DESC, p_brand LIMIT 10""")
def q_top_values(t):
    """Frequency list, top 10 by count with a total order (SRT-2, SRT-3, CHK-9).
    The limit is the feature; planned as TakeOrderedAndProject."""
    j = t["lineitem"].select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice") \
        .join(t["part"].select("p_partkey", "p_brand"), "p_partkey")
    g = j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_lines"), money_sum("l_extendedprice").alias("line_amt"))
    return g.orderBy(F.col("n_lines").desc(), F.col("p_brand")).limit(10)
