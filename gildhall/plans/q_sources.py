"""Scans, generators, loaders and sinks (§2.1) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildhall.operators import scd2_initial
from gildhall.plans.registry import query
from gildhall.plans.standins import AS_OF, FM, FY, LEDGER_SQL, ledger, money_sum
from gildhall.sources import blocked, conform, extend_dim, live, load_ref, seed
from gildhall.sources.scans import date_spine_over, period_spine_over


def _delete_flag():
    # second soft-delete flag in character form: ' y' (deleted), 'N', NULL
    return (F.when(F.col("l_discount") == 0, F.lit(" y"))
             .when(F.col("l_discount") == 0.01, F.lit(None).cast("string"))
             .otherwise(F.lit("N")))


@query("q_live_scan", f"""WITH {LEDGER_SQL},
x AS (SELECT *, CASE WHEN l_discount = 0 THEN ' y' WHEN l_discount = 0.01 THEN NULL ELSE 'N' END AS delete_flag
      FROM ledger)
SELECT l_linestatus, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE is_deleted IS NULL) AS n_null_flag,
       COUNT(*) FILTER (WHERE delete_flag IS NULL) AS n_null_char_flag,
       CAST(SUM(CAST(l_quantity AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS qty
FROM x
WHERE (is_deleted IS NULL OR is_deleted = FALSE)
  AND (delete_flag IS NULL OR upper(trim(delete_flag)) <> 'Y')
GROUP BY l_linestatus""")
def q_live_scan(t):
    led = ledger(t).withColumn("delete_flag", _delete_flag())
    rows = live(led, also=[("delete_flag", "Y")])
    return rows.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("is_deleted").isNull()).alias("n_null_flag"),
        F.count_if(F.col("delete_flag").isNull()).alias("n_null_char_flag"),
        money_sum("l_quantity").alias("qty"))


_SPINE_COLS_SQL = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS calendar_date,
  strftime(d, '%A') AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_num,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS calendar_month,
  strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
  CAST(year(d) AS INTEGER) AS calendar_year,
  CAST(year(d) + CASE WHEN month(d) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS federal_fiscal_fy,
  CAST(CASE WHEN month(d) IN (10,11,12) THEN 1 WHEN month(d) IN (1,2,3) THEN 2
            WHEN month(d) IN (4,5,6) THEN 3 ELSE 4 END AS INTEGER) AS federal_fiscal_qtr,
  CAST(CASE WHEN month(d) >= 10 THEN month(d) - 9 ELSE month(d) + 3 END AS INTEGER) AS federal_fiscal_month,
  dayofweek(d) IN (0, 6) AS is_weekend_flag,
  (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 11 AND day(d) = 11)
    OR (month(d) = 12 AND day(d) = 25) AS is_federal_holiday,
  d = last_day(d) AS is_last_day_of_month,
  (month(d) = 9 AND day(d) = 30) AS is_last_day_of_fy"""


@query("q_date_spine", f"""WITH b AS (
  SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(l_shipdate) AS DATE) AS hi
  FROM orders, (SELECT MAX(l_shipdate) AS l_shipdate FROM lineitem)),
s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT {_SPINE_COLS_SQL} FROM s""")
def q_date_spine(t):
    """Day spine over the span of the data (order date to last ship date)."""
    lo = t["orders"].agg(F.min("o_orderdate").alias("_lo"))
    hi = t["lineitem"].select(F.max("l_shipdate")).scalar()
    return date_spine_over(lo.select("_lo", hi.alias("_hi")), "_lo", "_hi")


@query("q_period_spine", """WITH b AS (
  SELECT CAST(year(MIN(o_orderdate)) - 1 AS INTEGER) AS y0, CAST(year(MAX(o_orderdate)) + 1 AS INTEGER) AS y1 FROM orders),
s AS (SELECT CAST(unnest(generate_series(make_date(y0, 10, 1), make_date(y1, 9, 1), INTERVAL 1 MONTH)) AS DATE) AS ps FROM b)
SELECT CAST(year(ps) AS INTEGER) AS accrual_year, CAST(month(ps) AS INTEGER) AS accrual_month,
       CAST(year(ps) + CASE WHEN month(ps) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS accrual_fy,
       CAST(((month(ps) + 2) % 12) + 1 AS INTEGER) AS accrual_fy_month,
       CAST((((month(ps) + 2) % 12)) // 3 + 1 AS INTEGER) AS accrual_fy_quarter,
       printf('FY%d-M%02d (%s %d)', year(ps) + CASE WHEN month(ps) >= 10 THEN 1 ELSE 0 END,
              ((month(ps) + 2) % 12) + 1, strftime(ps, '%b'), year(ps)) AS period_label,
       ps AS period_start_dt, last_day(ps) AS period_end_dt, month(ps) = 9 AS is_year_end_flag
FROM s""")
def q_period_spine(t):
    """Monthly periods covering every fiscal year that has orders."""
    b = t["orders"].agg((F.year(F.min("o_orderdate")) - 1).alias("_y0"),
                        (F.year(F.max("o_orderdate")) + 1).alias("_y1"))
    return period_spine_over(b, "_y0", "_y1")


@query("q_fiscal_calendar", f"""SELECT {FY('o_orderdate')} AS fiscal_year,
  CAST((((month(o_orderdate) + 2) % 12)) // 3 + 1 AS INTEGER) AS fiscal_quarter,
  {FM('o_orderdate')} AS fiscal_month, COUNT(*) AS n_orders,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS total_amt
FROM orders GROUP BY 1, 2, 3""")
def q_fiscal_calendar(t):
    from gildhall.functions import fiscal_month, fiscal_quarter, fiscal_year
    d = F.col("o_orderdate")
    return t["orders"].groupBy(fiscal_year(d).alias("fiscal_year"), fiscal_quarter(d).alias("fiscal_quarter"),
                               fiscal_month(d).alias("fiscal_month")).agg(
        F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("total_amt"))


# The seeded priority codes of the demo entity-type seed (six rows).
PRIORITY_SEED = [("1-URGENT", "Urgent", 1), ("2-HIGH", "High", 2), ("3-MEDIUM", "Medium", 3),
                 ("4-NOT SPECIFIED", "Not specified", 4), ("5-LOW", "Low", 5), ("9-UNKNOWN", "Unknown", 9)]


@query("q_entity_seed", """WITH s(priority_cd, priority_name, sort_order) AS (VALUES
  ('1-URGENT', 'Urgent', 1), ('2-HIGH', 'High', 2), ('3-MEDIUM', 'Medium', 3),
  ('4-NOT SPECIFIED', 'Not specified', 4), ('5-LOW', 'Low', 5), ('9-UNKNOWN', 'Unknown', 9)),
c AS (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT s.priority_cd, s.priority_name, CAST(s.sort_order AS INTEGER) AS sort_order, COALESCE(c.n, 0) AS n_orders
FROM s LEFT JOIN c ON c.o_orderpriority = s.priority_cd""")
def q_entity_seed(t):
    """Six seeded codes (count asserted on the driver) joined to their use."""
    s = seed(t.spark, PRIORITY_SEED, "priority_cd string, priority_name string, sort_order int", expected=6)
    c = t["orders"].groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    j = s.join(c, s["priority_cd"] == c["o_orderpriority"], "left")
    return j.select("priority_cd", "priority_name", "sort_order", F.coalesce("n", F.lit(0)).alias("n_orders"))


ROLE_ASSIGNMENT = T.StructType([
    T.StructField("role_assignment_sk", T.LongType(), False),
    T.StructField("user_sk", T.LongType(), True),
    T.StructField("role_cd", T.StringType(), True),
    T.StructField("eff_start_dt", T.TimestampNTZType(), True),
])


@query("q_blocked_empty", """SELECT 'wpr.fact_role_assignment' AS target_table,
  'BLOCKED: no role source in Silver' AS reason, CAST(0 AS BIGINT) AS rows_written,
  COUNT(*) AS source_rows_seen FROM orders""")
def q_blocked_empty(t):
    """Blocked target: an empty typed frame is 'written'; the audit row
    records why, verifies the target is empty and counts the input seen."""
    target = blocked(t.spark, ROLE_ASSIGNMENT)
    written = target.select(F.count(F.lit(1))).scalar()
    return t["orders"].agg(F.count(F.lit(1)).alias("source_rows_seen")).select(
        F.lit("wpr.fact_role_assignment").alias("target_table"),
        F.lit("BLOCKED: no role source in Silver").alias("reason"),
        written.alias("rows_written"), "source_rows_seen")


@query("q_ref_load", """SELECT DISTINCT * FROM (
  SELECT 'segment' AS code_set, trim(c_mktsegment) AS code_value, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS code_desc,
         upper(substr(c_mktsegment, 1, 3)) AS short_desc, CAST(NULL AS INTEGER) AS sort_order, TRUE AS is_active_flag FROM customer
  UNION ALL
  SELECT 'priority', trim(o_orderpriority), substr(o_orderpriority, 3), CAST(NULL AS VARCHAR),
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER), o_orderpriority NOT LIKE '%NOT SPECIFIED%' FROM orders
  UNION ALL
  SELECT 'part_type', trim(p_type), lower(p_type), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS BOOLEAN) FROM part
  UNION ALL
  SELECT 'event_type', trim(event_type), upper(event_type), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), TRUE FROM events)""")
def q_ref_load(t):
    """Four code sets from four tables as one long code table, one job."""
    config = [
        dict(source="customer", code_set="segment", code_col="c_mktsegment",
             desc_col=F.concat(F.upper(F.substring("c_mktsegment", 1, 1)), F.lower(F.expr("substring(c_mktsegment, 2)"))),
             short_col=F.upper(F.substring("c_mktsegment", 1, 3)), active=F.lit(True), distinct=True),
        dict(source="orders", code_set="priority", code_col="o_orderpriority",
             desc_col=F.expr("substring(o_orderpriority, 3)"), sort_col=F.substring("o_orderpriority", 1, 1),
             active=~F.col("o_orderpriority").like("%NOT SPECIFIED%")),
        dict(source="part", code_set="part_type", code_col="p_type", desc_col=F.lower("p_type")),
        dict(source="events", code_set="event_type", code_col="event_type", desc_col=F.upper("event_type"),
             active=F.lit(True)),
    ]
    return load_ref({n: t[n] for n in ("customer", "orders", "part", "events")}, config)


@query("q_extend_dim", """SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_name,
  TIMESTAMP '2002-01-01 00:00:00' AS eff_start_dt, CAST(NULL AS TIMESTAMP) AS eff_end_dt, TRUE AS is_current_flag
FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def q_extend_dim(t):
    dim = scd2_initial(t["supplier"].select("s_suppkey", "s_name", "s_nationkey"), AS_OF)
    extra = t["nation"].select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return extend_dim(dim, extra, "s_nationkey").select(
        "s_suppkey", "s_name", "s_nationkey", "n_name", "eff_start_dt", "eff_end_dt", "is_current_flag")


AWARD_CONTRACT = T.StructType([
    T.StructField("award_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("award_status_cd", T.StringType(), True),
    T.StructField("total_amt", T.DecimalType(15, 2), True),
    T.StructField("award_dt", T.DateType(), True),
    T.StructField("priority_cd", T.StringType(), True),
    T.StructField("lead_agency_cd", T.StringType(), True),
    T.StructField("closeout_dt", T.DateType(), True),
    T.StructField("_gold_created_at", T.TimestampNTZType(), True),
    T.StructField("_gold_updated_at", T.TimestampNTZType(), True),
    T.StructField("_source_batch_id", T.StringType(), True),
])


@query("q_conform", """SELECT o_orderkey AS award_id, o_custkey AS customer_id, o_orderstatus AS award_status_cd,
  CAST(o_totalprice AS DECIMAL(15,2)) AS total_amt, CAST(o_orderdate AS DATE) AS award_dt,
  o_orderpriority AS priority_cd, CAST(NULL AS VARCHAR) AS lead_agency_cd, CAST(NULL AS DATE) AS closeout_dt,
  TIMESTAMP '2002-01-01 00:00:00' AS _gold_created_at, TIMESTAMP '2002-01-01 00:00:00' AS _gold_updated_at,
  'batch-demo' AS _source_batch_id
FROM orders""")
def q_conform(t):
    o = t["orders"].select(
        F.col("o_orderkey").alias("award_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("award_status_cd"), F.col("o_totalprice").alias("total_amt"),
        F.col("o_orderdate").alias("award_dt"), F.col("o_orderpriority").alias("priority_cd"))
    return conform(o, AWARD_CONTRACT, as_of=AS_OF, batch_id="batch-demo")
