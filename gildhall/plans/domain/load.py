"""Load one target and record it in the append-only audit log (SNK-1..3, AUD-1).

``load_target`` appends a RUNNING event, writes the target with the given
mode, and appends SUCCESS (rows written and further ``metrics``, such as control
totals or sentinel counts, observed by the write job itself; rows read when given, and ``watermark_to = as_of`` so the first CDC run
after a full load starts from it — fix for D-3) or FAILED with the error.
Rows read and rows written are separate keyword arguments (D-23).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildhall.operators import audit_event
from gildhall.sources import write, write_observed


def _ts(as_of: str) -> dt.datetime:
    return dt.datetime.fromisoformat(as_of)


def load_target(df: DataFrame, target: str, path: str, audit_path: str, run_id: str, as_of: str,
                mode: str = "overwrite", run_type: str = "FULL_PRIME", product: str | None = None,
                rows_read: int | None = None, metrics: Mapping[str, Column] | None = None, **write_args) -> str:
    spark = df.sparkSession
    ts = _ts(as_of)
    common = dict(run_id=run_id, target_table=target, product=product, run_type=run_type, start_ts=ts)
    write(audit_event(spark, run_status="RUNNING", event_ts=ts, **common), audit_path, mode="append")
    checks = {"_rows": F.count(F.lit(1)), **(metrics or {})}
    try:
        status, seen = write_observed(df, path, checks, mode=mode, **write_args)
    except Exception as e:  # the failure is recorded, then raised
        write(audit_event(spark, run_status="FAILED", event_ts=ts, end_ts=ts, message=str(e)[:2000], **common),
              audit_path, mode="append")
        raise
    written = seen.pop("_rows", 0)
    final = "SKIPPED" if status == "SKIPPED_ALREADY_LOADED" else "SUCCESS"
    write(audit_event(spark, run_status=final, event_ts=ts, end_ts=ts, rows_read=rows_read, rows_written=written,
                      watermark_to=ts, message=json.dumps({"status": status, **seen}, default=str) if seen else status,
                      **common), audit_path, mode="append")
    return status
