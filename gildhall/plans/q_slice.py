"""The first end-to-end slice: ledger fact → star summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.plans.registry import query
from gildhall.plans.standins import LEDGER_FACT_SQL, ia_dim, ledger_fact


@query("q_ledger_fact", f"WITH {LEDGER_FACT_SQL} SELECT * FROM ledger_fact")
def q_ledger_fact(t):
    return ledger_fact(t)


@query("q_star_summary", f"""WITH {LEDGER_FACT_SQL}
SELECT r.r_name, n.n_name, f.fiscal_year,
       COUNT(DISTINCT f.order_key) AS n_orders, CAST(SUM(f.line_cnt) AS BIGINT) AS n_lines,
       CAST(SUM(f.obligated_amt) AS DECIMAL(38,2)) AS obligated_amt,
       CAST(SUM(f.net_amt) AS DECIMAL(38,2)) AS net_amt
FROM ledger_fact f
JOIN ia_dim c ON c.ia_sk = f.ia_sk AND c.is_current_flag
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY r.r_name, n.n_name, f.fiscal_year""")
def q_star_summary(t):
    f = ledger_fact(t)
    c = ia_dim(t).filter(F.col("is_current_flag")).select("ia_sk", "c_nationkey")
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = t["region"].select("r_regionkey", "r_name")
    j = (f.join(c, "ia_sk")
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.groupBy("r_name", "n_name", "fiscal_year").agg(
        F.count_distinct("order_key").alias("n_orders"),
        F.sum("line_cnt").cast("bigint").alias("n_lines"),
        F.sum("obligated_amt").cast("decimal(38,2)").alias("obligated_amt"),
        F.sum("net_amt").cast("decimal(38,2)").alias("net_amt"))
