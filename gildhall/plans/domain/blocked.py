"""Facts whose Silver sources do not exist yet (SRC-9).

The builder returns an empty frame of the target contract; ``blocked_event``
is the BLOCKED audit row that records why, so a blocked target is told apart
from a failed one (AUD-3). The empty fact is the correct state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gildhall.operators import audit_event
from gildhall.sources import blocked


def _contract(cols: str) -> T.StructType:
    return T.StructType.fromDDL(cols)


ROLE_ASSIGNMENT_DDL = (
    "user_sk BIGINT NOT NULL, responsible_role_sk BIGINT NOT NULL, entity_type_sk BIGINT NOT NULL, org_sk BIGINT, "
    "agency_sk BIGINT, award_sk BIGINT, ia_sk BIGINT, assigned_date_sk INT, source_entity_id BIGINT NOT NULL, "
    "assignment_status_cd STRING, delegation_letter_ref STRING, has_delegation_flag BOOLEAN, "
    "awards_assigned_count INT, active_clin_count INT, total_obligated_amt DECIMAL(15,2)")

REVIEW_DETERMINATION_DDL = (
    "review_type_sk BIGINT NOT NULL, reviewer_type_sk BIGINT NOT NULL, finding_sk BIGINT, award_sk BIGINT, "
    "ia_sk BIGINT, agency_sk BIGINT NOT NULL, review_date_sk INT, source_review_id BIGINT NOT NULL, "
    "source_determination_id BIGINT, reviewer_user_id STRING, review_assigned_dt TIMESTAMP_NTZ, "
    "determination_dt TIMESTAMP_NTZ, days_to_determination INT, determination_comments STRING, "
    "is_blocking_finding_flag BOOLEAN")

# The Silver role tables whose absence blocks the role fact.
ROLE_SOURCES = ["silver_aasbs_acquisition_role", "silver_aasbs_award_role", "silver_aasbs_ia_role",
                "silver_aasbs_funding_role", "silver_aasbs_solicit_role"]

BLOCK_REASONS = {
    "wpr.fact_role_assignment": "BLOCKED_SILVER_GAP: role source tables absent: " + ", ".join(ROLE_SOURCES),
    "cat.fact_review_determination": "BLOCKED_SILVER_GAP: review determination source tables absent",
}


def _spark(silver):
    return next(iter(silver.values())).sparkSession


def fact_role_assignment(silver, gold, as_of: str) -> DataFrame:
    return blocked(_spark(silver), _contract(ROLE_ASSIGNMENT_DDL))


def fact_review_determination(silver, gold, as_of: str) -> DataFrame:
    return blocked(_spark(silver), _contract(REVIEW_DETERMINATION_DDL))


def blocked_event(spark, target: str, run_id: str, as_of: str) -> DataFrame:
    import datetime as dt
    ts = dt.datetime.fromisoformat(as_of)
    return audit_event(spark, run_id=run_id, target_table=target, run_status="BLOCKED", event_ts=ts, start_ts=ts,
                       end_ts=ts, rows_read=0, rows_written=0, message=BLOCK_REASONS[target])
