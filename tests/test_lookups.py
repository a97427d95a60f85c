"""Rule-derived lookup dimensions on small code tables."""

from gildhall.plans.domain import BUILDERS

CODE = "cd string, description string, is_deleted boolean"


def _silver(spark, **tables):
    return {f"aasbs_{k}": spark.createDataFrame(v, CODE) for k, v in tables.items()}


def test_event_type_rules(spark):
    s = _silver(spark, lu_event_type=[("solicit_posted", "x", None), ("AWARD_CREATED", "y", False),
                                      ("invoice_paid", "z", None), ("CLOSEOUT_FINAL", "w", None),
                                      ("SYSTEM_NOTIFY", "v", None), ("OLD", "gone", True)])
    rows = {r.event_type_cd: r for r in BUILDERS["cat.dim_event_type"](s, {}, "2024-01-01").collect()}
    assert set(rows) == {"solicit_posted", "AWARD_CREATED", "invoice_paid", "CLOSEOUT_FINAL", "SYSTEM_NOTIFY"}
    assert rows["solicit_posted"].lifecycle_phase_cd == "PRE_AWARD"
    assert (rows["AWARD_CREATED"].lifecycle_phase_cd, rows["AWARD_CREATED"].is_audit_significant) == ("AWARD", True)
    assert rows["invoice_paid"].lifecycle_phase_cd == "POST_AWARD"
    assert (rows["CLOSEOUT_FINAL"].lifecycle_phase_cd, rows["CLOSEOUT_FINAL"].is_audit_significant) == ("CLOSEOUT", True)
    assert (rows["SYSTEM_NOTIFY"].lifecycle_phase_cd, rows["SYSTEM_NOTIFY"].is_system_event_flag) == (None, True)
    assert sorted(r.event_type_sk for r in rows.values()) == [1, 2, 3, 4, 5]


def test_review_finding_amend_rate_role(spark):
    s = _silver(spark, lu_review_type=[("LEGAL", "l", None), ("TECH_EVAL", "t", None), ("OIG", "o", None)],
                lu_review_finding=[("RETURNED", "r", None), ("COMMENTS", "c", None)],
                lu_ia_amend_action=[("EXTEND_POP", "e", None), ("COST_INCREASE", "c", None)],
                lu_cost_rate_type=[(" actual ", "a", None), ("EST", "e", None)],
                lu_responsible_role=[("cor", "c", None), ("PCO", "p", None), ("X", "x", None)])
    rt = {r.review_type_cd: r for r in BUILDERS["cat.dim_review_type"](s, {}, "d").collect()}
    assert (rt["LEGAL"].is_mandatory_flag, rt["LEGAL"].far_basis) == (True, "GSA Legal Review Policy")
    assert (rt["TECH_EVAL"].is_pre_award_flag, rt["TECH_EVAL"].is_mandatory_flag, rt["TECH_EVAL"].far_basis) == \
        (True, False, "FAR 15.304")
    assert rt["OIG"].far_basis == "5 U.S.C. App. 3"
    fi = {r.finding_cd: (r.is_blocking_flag, r.requires_remediation) for r in BUILDERS["cat.dim_finding"](s, {}, "d").collect()}
    assert fi == {"RETURNED": (True, True), "COMMENTS": (False, True)}
    am = {r.amend_action_cd: (r.changes_scope_flag, r.changes_cost_flag, r.changes_period_flag)
          for r in BUILDERS["iat.dim_amend_action"](s, {}, "d").collect()}
    assert am == {"EXTEND_POP": (False, False, True), "COST_INCREASE": (False, True, False)}
    cr = {r.cost_rate_type_cd: r.is_actual_flag for r in BUILDERS["psc.dim_cost_rate_type"](s, {}, "d").collect()}
    assert cr == {" actual ": True, "EST": False}
    rr = {r.responsible_role_cd: (r.requires_delegation_flag, r.far_citation)
          for r in BUILDERS["wpr.dim_responsible_role"](s, {}, "d").collect()}
    assert rr == {"cor": (True, "FAR 1.602-2(d)"), "PCO": (False, "FAR 1.602-1"), "X": (False, None)}


def test_seed_and_periods(spark):
    s = _silver(spark, lu_event_type=[])
    et = BUILDERS["wpr.dim_entity_type"](s, {}, "d").collect()
    assert len(et) == 6 and {r.entity_type_cd for r in et} >= {"AWARD", "IA", "COLLAB"}
    ap = BUILDERS["air.dim_accrual_period"](s, {}, "d").orderBy("accrual_period_sk").collect()
    assert ap[0].period_label == "FY2016-M01 (Oct 2015)" and len(ap) == 16 * 12
