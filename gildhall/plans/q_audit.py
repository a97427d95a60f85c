"""Run log as data (§2.12) and watermarks (CDC-1, CDC-6).

Audit rows are synthesised from ``events``: one run per hour, six targets
(``gold.t0`` … ``gold.t5`` by user), status FAILED for error events,
RUNNING for small view events, SUCCESS otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.operators import freshness, gate, high_waters, run_outcome, run_state
from gildhall.plans.registry import query

NOW = "2024-02-01 00:00:00"
SINCE = "2024-01-30 00:00:00"
CRITICAL = ["gold.t0", "gold.t1"]

# Fixed demo dependency table: step, upstream target, critical?
DEPS = [("fact_obligation", "gold.t0", True), ("fact_obligation", "gold.t1", True),
        ("fact_obligation", "gold.t2", False), ("fact_lifecycle", "gold.t3", True),
        ("fact_lifecycle", "gold.t4", True), ("v_summary", "gold.t5", True)]


def audit_log(t):
    e = t["events"]
    status = (F.when(F.col("event_type") == "error", "FAILED")
               .when((F.col("event_type") == "view") & (F.col("value") < 10), "RUNNING")
               .otherwise("SUCCESS"))
    return e.select(
        F.date_format("ts", "yyyyMMddHH").alias("run_id"),
        F.col("event_type").alias("product"),
        F.concat(F.lit("gold.t"), (F.col("user_id") % 6).cast("string")).alias("target_table"),
        F.lit("DELTA_REFRESH").alias("run_type"),
        status.alias("run_status"),
        F.col("ts").alias("event_ts"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start_ts"),
        F.when(status != "RUNNING", F.col("ts")).alias("end_ts"),
        F.when(status == "SUCCESS", F.col("ts")).alias("watermark_to"))


AUDIT_SQL = """audit AS (
  SELECT strftime(ts, '%Y%m%d%H') AS run_id, event_type AS product, 'gold.t' || CAST(user_id % 6 AS VARCHAR) AS target_table,
    'DELTA_REFRESH' AS run_type,
    CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'view' AND value < 10 THEN 'RUNNING' ELSE 'SUCCESS' END AS run_status,
    ts AS event_ts, date_trunc('hour', ts) AS start_ts,
    CASE WHEN NOT (event_type = 'view' AND value < 10) OR event_type = 'error' THEN ts END AS end_ts,
    CASE WHEN event_type <> 'error' AND NOT (event_type = 'view' AND value < 10) THEN ts END AS watermark_to
  FROM events)"""

STATE_SQL = f"""{AUDIT_SQL},
state AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, MIN(event_ts) OVER (PARTITION BY run_id, target_table) AS first_event_ts,
    ROW_NUMBER() OVER (PARTITION BY run_id, target_table
      ORDER BY event_ts DESC, CASE WHEN run_status = 'RUNNING' THEN 0 ELSE 1 END DESC, run_status DESC) AS rn
  FROM audit) WHERE rn = 1)"""


@query("q_high_water", f"""WITH {AUDIT_SQL},
last AS (SELECT target_table, arg_max(watermark_to, end_ts) FILTER (WHERE run_status = 'SUCCESS' AND watermark_to IS NOT NULL) AS w
  FROM audit GROUP BY 1)
SELECT target_table, COALESCE(w, TIMESTAMP '{NOW}' - INTERVAL 86400 SECOND) AS watermark_from,
       TIMESTAMP '{NOW}' AS watermark_to FROM last""")
def q_high_water(t):
    """Last successful watermark per target, else now − 24 h (CDC-1, SRT-4, fix for D-3)."""
    return high_waters(audit_log(t), NOW, 86400)


@query("q_freshness", f"""WITH {AUDIT_SQL}
SELECT product, COUNT(*) FILTER (WHERE run_status = 'SUCCESS' AND end_ts >= TIMESTAMP '{SINCE}') > 0 AS is_fresh
FROM audit GROUP BY 1""")
def q_freshness(t):
    """Whether each product had a successful run since a point in time (CDC-6)."""
    return freshness(audit_log(t), SINCE)


@query("q_run_state", f"""WITH {STATE_SQL}
SELECT run_id, target_table, first_event_ts, run_status, event_ts, end_ts, watermark_to FROM state""")
def q_run_state(t):
    """State per (run, target) as a fold of append-only events (AUD-1, AUD-2)."""
    return run_state(audit_log(t)).select("run_id", "target_table", "first_event_ts", "run_status", "event_ts",
                                          "end_ts", "watermark_to")


@query("q_run_outcome", f"""WITH {STATE_SQL}
SELECT run_id, COUNT(*) AS n_targets, COUNT(*) FILTER (WHERE run_status = 'SUCCESS') AS n_success,
  COUNT(*) FILTER (WHERE run_status = 'FAILED') AS n_failed,
  COUNT(*) FILTER (WHERE run_status = 'FAILED' AND target_table IN ('gold.t0', 'gold.t1')) AS n_critical_failed,
  COUNT(*) FILTER (WHERE run_status = 'RUNNING') AS n_running, COUNT(*) FILTER (WHERE run_status = 'BLOCKED') AS n_blocked,
  CASE WHEN COUNT(*) FILTER (WHERE run_status = 'FAILED' AND target_table IN ('gold.t0', 'gold.t1')) > 0 THEN 'FAILURE'
       WHEN COUNT(*) FILTER (WHERE run_status = 'BLOCKED') > 0 THEN 'BLOCKED'
       WHEN COUNT(*) FILTER (WHERE run_status = 'RUNNING') > 0 THEN 'PARTIAL'
       WHEN COUNT(*) FILTER (WHERE run_status = 'FAILED') > 0 THEN 'WARNING' ELSE 'COMPLETE' END AS outcome
FROM state GROUP BY 1""")
def q_run_outcome(t):
    """Complete / warning / failure / blocked / partial per run (AUD-3)."""
    return run_outcome(run_state(audit_log(t)), CRITICAL)


@query("q_gate", f"""WITH {STATE_SQL},
deps(step, upstream, is_critical) AS (VALUES ('fact_obligation', 'gold.t0', TRUE), ('fact_obligation', 'gold.t1', TRUE),
  ('fact_obligation', 'gold.t2', FALSE), ('fact_lifecycle', 'gold.t3', TRUE), ('fact_lifecycle', 'gold.t4', TRUE),
  ('v_summary', 'gold.t5', TRUE)),
d AS (SELECT step, upstream FROM deps WHERE is_critical),
need AS (SELECT step, COUNT(*) AS n_critical FROM d GROUP BY 1),
ok AS (SELECT s.run_id, d.step, COUNT(*) FILTER (WHERE s.run_status = 'SUCCESS') AS n_ok
  FROM state s JOIN d ON d.upstream = s.target_table GROUP BY 1, 2)
SELECT ok.run_id, ok.step, need.n_critical, ok.n_ok, need.n_critical = ok.n_ok AS may_run
FROM ok JOIN need ON need.step = ok.step""")
def q_gate(t):
    """Steps whose critical upstreams all succeeded in the run (AUD-4)."""
    deps = t.spark.createDataFrame(DEPS, "step string, upstream string, is_critical boolean")
    return gate(run_state(audit_log(t)), deps)
