"""Rule-derived lookup dimensions (cat, iat, psc, wpr, air).

Each is a projection of one Silver code table (live rows) with flags and
labels from fixed pattern rules (PRJ-5..PRJ-7), a dense surrogate key by
code, and no history. The rule lists below are fixed values that must equal
the reference's; patterns are LIKE patterns on the upper-trimmed code, first
matching label wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.functions import like_any
from gildhall.operators import assign_sk
from gildhall.sources import live, period_spine, seed

# Event type → lifecycle phase (first match wins), system and audit flags.
EVENT_PHASE = [
    ("PRE_AWARD", ["%SOLICIT%", "%REVIEW%", "%JA%", "%PRE%AWARD%"]),
    ("AWARD", ["%AWARD%", "%CONTRACT%", "%MOD%"]),
    ("POST_AWARD", ["%INVOICE%", "%ACCEPT%", "%CLIN%", "%POST%AWARD%", "%PAYMENT%"]),
    ("CLOSEOUT", ["%CLOSE%", "%FINAL%", "%DEOBLIG%"]),
]
EVENT_SYSTEM = ["%SYSTEM%", "%AUTO%", "%NOTIF%", "%STATUS%CHANGE%"]
EVENT_AUDIT = ["%AWARD%CREATE%", "%MOD%APPROV%", "%COR%ASSIGN%", "%CO%SIGN%", "%JA%APPROV%", "%CLOSE%FINAL%",
               "%DEOBLIG%"]

# Review type flags and FAR basis (first match wins).
REVIEW_PRE_AWARD = ["%LEGAL%", "%TECH%", "%PRICE%", "%COMPETITION%", "%JA%", "%JUSTIF%"]
REVIEW_MANDATORY = ["%LEGAL%", "%PRICE%", "%JA%", "%JUSTIF%"]
REVIEW_FAR_BASIS = [
    ("GSA Legal Review Policy", ["%LEGAL%"]), ("FAR 15.404", ["%PRICE%"]), ("FAR 15.304", ["%TECH%"]),
    ("FAR 6.302", ["%JA%", "%JUSTIF%"]), ("FAR 6.101", ["%COMPETITION%"]), ("5 U.S.C. App. 3", ["%OIG%"]),
]

# Review finding flags.
FINDING_BLOCKING = ["%RETURN%", "%REJECT%", "%DENY%", "%DISAPPROVE%"]
FINDING_REMEDIATION = ["%RETURN%", "%REJECT%", "%COMMENT%", "%REVISE%", "%DENY%"]

# IA amendment action flags.
AMEND_SCOPE = ["%SCOPE%", "%WORK%"]
AMEND_COST = ["%COST%", "%BUDGET%", "%FEE%"]
AMEND_PERIOD = ["%PERIOD%", "%EXTEND%", "%POP%"]

# Cost rate type codes that mean actual (not estimated) rates.
ACTUAL_RATE_CODES = ["ACTUAL", "ACT", "ACTUAL_RATE", "ACTUALS"]

# Responsible role codes and their FAR citations.
DELEGATED_ROLES = ["COR", "COTR", "COR_DELEGATE"]
ROLE_FAR = [("FAR 1.602-2(d)", DELEGATED_ROLES), ("FAR 1.602-1", ["CO", "PCO", "ACO", "TCO"]),
            ("FAR 42.202", ["FMA", "FINANCE_MANAGER"])]

# The six entity types of the data model (static seed).
ENTITY_TYPES = [("AWARD", "Award / Contract"), ("IA", "Interagency Agreement"), ("FUNDING", "Funding Package"),
                ("SOLICITATION", "Solicitation"), ("ACQUISITION", "Acquisition"),
                ("COLLAB", "Collaboration Request")]


def _first(code, table) -> F.Column:
    out = None
    for label, pats in table:
        cond = like_any(code, pats)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def _in(code, codes) -> F.Column:
    return F.coalesce(F.upper(F.trim(code)).isin(codes), F.lit(False))


def _code_table(silver, name: str, code: str, desc: str, extra: dict, sk: str) -> DataFrame:
    src = live(silver[name])
    c = F.col("cd")
    out = src.select(c.alias(code), F.col("description").alias(desc),
                     *[expr(c).alias(col) for col, expr in extra.items()])
    return assign_sk(out, [code], name=sk)


def dim_event_type(silver, gold, as_of: str) -> DataFrame:
    return _code_table(silver, "aasbs_lu_event_type", "event_type_cd", "event_type_desc", {
        "lifecycle_phase_cd": lambda c: _first(c, EVENT_PHASE),
        "is_system_event_flag": lambda c: like_any(c, EVENT_SYSTEM),
        "is_audit_significant": lambda c: like_any(c, EVENT_AUDIT)}, "event_type_sk")


def dim_review_type(silver, gold, as_of: str) -> DataFrame:
    return _code_table(silver, "aasbs_lu_review_type", "review_type_cd", "review_type_desc", {
        "is_pre_award_flag": lambda c: like_any(c, REVIEW_PRE_AWARD),
        "is_mandatory_flag": lambda c: like_any(c, REVIEW_MANDATORY),
        "far_basis": lambda c: _first(c, REVIEW_FAR_BASIS)}, "review_type_sk")


def dim_reviewer_type(silver, gold, as_of: str) -> DataFrame:
    return _code_table(silver, "aasbs_lu_reviewer_type", "reviewer_type_cd", "reviewer_type_desc", {},
                       "reviewer_type_sk")


def dim_finding(silver, gold, as_of: str) -> DataFrame:
    return _code_table(silver, "aasbs_lu_review_finding", "finding_cd", "finding_desc", {
        "is_blocking_flag": lambda c: like_any(c, FINDING_BLOCKING),
        "requires_remediation": lambda c: like_any(c, FINDING_REMEDIATION)}, "finding_sk")


def dim_amend_action(silver, gold, as_of: str) -> DataFrame:
    return _code_table(silver, "aasbs_lu_ia_amend_action", "amend_action_cd", "amend_action_desc", {
        "changes_scope_flag": lambda c: like_any(c, AMEND_SCOPE),
        "changes_cost_flag": lambda c: like_any(c, AMEND_COST),
        "changes_period_flag": lambda c: like_any(c, AMEND_PERIOD)}, "amend_action_sk")


def dim_cost_rate_type(silver, gold, as_of: str) -> DataFrame:
    return _code_table(silver, "aasbs_lu_cost_rate_type", "cost_rate_type_cd", "cost_rate_type_desc", {
        "is_actual_flag": lambda c: _in(c, ACTUAL_RATE_CODES)}, "cost_rate_type_sk")


def dim_responsible_role(silver, gold, as_of: str) -> DataFrame:
    def far(c):
        out = None
        for label, codes in ROLE_FAR:
            cond = _in(c, codes)
            out = F.when(cond, label) if out is None else out.when(cond, label)
        return out
    return _code_table(silver, "aasbs_lu_responsible_role", "responsible_role_cd", "responsible_role_desc", {
        "requires_delegation_flag": lambda c: _in(c, DELEGATED_ROLES),
        "far_citation": far}, "responsible_role_sk")


def dim_entity_type(silver, gold, as_of: str) -> DataFrame:
    spark = next(iter(silver.values())).sparkSession
    s = seed(spark, ENTITY_TYPES, "entity_type_cd string, entity_type_desc string", expected=6)
    return assign_sk(s, ["entity_type_cd"], name="entity_type_sk")


def dim_accrual_period(silver, gold, as_of: str, first_cal_year: int = 2015, end_cal_year: int = 2031) -> DataFrame:
    """Monthly accrual periods; the year range is a parameter (the reference
    takes it from job widgets)."""
    spark = next(iter(silver.values())).sparkSession
    p = period_spine(spark, first_cal_year, end_cal_year)
    return assign_sk(p, ["period_start_dt"], name="accrual_period_sk")


