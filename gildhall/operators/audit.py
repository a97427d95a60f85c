"""Run log as data (AUD-1..AUD-4).

The audit table is append-only: one row per event (RUNNING / SUCCESS /
FAILED / BLOCKED / SKIPPED). There is no UPDATE; the state of a run is a
fold of its events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("product", T.StringType(), True),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("run_type", T.StringType(), True),
    T.StructField("run_status", T.StringType(), False),
    T.StructField("event_ts", T.TimestampNTZType(), False),
    T.StructField("start_ts", T.TimestampNTZType(), True),
    T.StructField("end_ts", T.TimestampNTZType(), True),
    T.StructField("rows_read", T.LongType(), True),
    T.StructField("rows_written", T.LongType(), True),
    T.StructField("watermark_from", T.TimestampNTZType(), True),
    T.StructField("watermark_to", T.TimestampNTZType(), True),
    T.StructField("message", T.StringType(), True),
])


def audit_event(spark: SparkSession, *, run_id: str, target_table: str, run_status: str, event_ts,
                product: str | None = None, run_type: str | None = None, start_ts=None, end_ts=None,
                rows_read: int | None = None, rows_written: int | None = None,
                watermark_from=None, watermark_to=None, message: str | None = None) -> DataFrame:
    """One event row; keyword-only so rows read and rows written cannot be
    swapped (fix for D-23). Append it with ``write(df, path, mode='append')``."""
    return spark.createDataFrame([(run_id, product, target_table, run_type, run_status, event_ts, start_ts,
                                   end_ts, rows_read, rows_written, watermark_from, watermark_to, message)],
                                 AUDIT_SCHEMA)


def run_state(audit: DataFrame) -> DataFrame:
    """Current state per (run, target): the latest event wins (AUD-2).

    ``max_by`` over a struct ordered by ``(event_ts, status rank)`` — a
    terminal status beats RUNNING at the same instant. Partial aggregation,
    no window.
    """
    rank = (F.when(F.col("run_status") == "RUNNING", 0).otherwise(1))
    latest = F.max_by(F.struct(*[c for c in audit.columns if c not in ("run_id", "target_table")]),
                      F.struct("event_ts", rank.alias("_r"), "run_status"))
    return (audit.groupBy("run_id", "target_table").agg(latest.alias("_s"),
                                                        F.min("event_ts").alias("first_event_ts"))
                 .select("run_id", "target_table", "first_event_ts", "_s.*"))


def run_outcome(states: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Outcome per run (AUD-3).

    FAILURE  a critical target failed
    BLOCKED  nothing failed but a target is blocked
    PARTIAL  a target is still running
    WARNING  only non-critical targets failed
    COMPLETE every target succeeded or was skipped
    """
    s = F.col("run_status")
    crit = F.col("target_table").isin(list(critical)) if critical else F.lit(False)
    g = states.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_targets"),
        F.count_if(s == "SUCCESS").alias("n_success"),
        F.count_if(s == "FAILED").alias("n_failed"),
        F.count_if((s == "FAILED") & crit).alias("n_critical_failed"),
        F.count_if(s == "RUNNING").alias("n_running"),
        F.count_if(s == "BLOCKED").alias("n_blocked"))
    outcome = (F.when(F.col("n_critical_failed") > 0, "FAILURE")
                .when(F.col("n_blocked") > 0, "BLOCKED")
                .when(F.col("n_running") > 0, "PARTIAL")
                .when(F.col("n_failed") > 0, "WARNING")
                .otherwise("COMPLETE"))
    return g.withColumn("outcome", outcome)


def gate(states: DataFrame, deps: DataFrame) -> DataFrame:
    """Which steps may run (AUD-4).

    ``deps``: ``(step, upstream, is_critical)``. A step may run in a run when
    every critical upstream has SUCCESS in that run. Only equi-joins: the
    states are joined to the dependency table on ``target_table = upstream``
    and the successes per (run, step) are compared with the number of
    critical upstreams of the step. A (run, step) pair appears when at least
    one of the step's upstreams has a state in that run.
    """
    d = deps.filter(F.col("is_critical")).select("step", "upstream")
    need = d.groupBy("step").agg(F.count(F.lit(1)).alias("n_critical"))
    st = states.select("run_id", F.col("target_table").alias("upstream"), "run_status")
    j = st.join(d, "upstream", "inner")
    ok = F.count_if(F.col("run_status") == "SUCCESS")
    return (j.groupBy("run_id", "step").agg(ok.alias("n_ok"))
             .join(need, "step", "inner")
             .select("run_id", "step", "n_critical", "n_ok",
                     (F.col("n_critical") == F.col("n_ok")).alias("may_run")))
