"""DP1 domain builders end to end on a small Silver fixture (schemas from FIXTURES.md §3)."""

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from gildhall.operators import quality as Q
from gildhall.plans.domain import build_all

SCHEMAS = {
    "aasbs_lu_activity_address_code": "active_yn STRING, cd STRING, description STRING, fpds_ng_agency_identifier STRING, "
                                      "is_deleted BOOLEAN, program_cd STRING, region_cd STRING",
    "aasbs_lu_agency": "cd STRING, cd_2char STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_lu_bureau": "agency_cd STRING, cd STRING, description STRING, is_deleted BOOLEAN, updated_dt TIMESTAMP_NTZ",
    "table_master_lu_federal_agency": "agency_code STRING, agency_description STRING, agency_type STRING, "
                                      "bureau_description STRING, inactive_date TIMESTAMP_NTZ, is_deleted BOOLEAN",
    "aasbs_ia": "activity_address_cd STRING, fiscal_year INT, ia_began_dt TIMESTAMP_NTZ, ia_status_cd STRING, id BIGINT, "
                "instrument_type_cd STRING, is_deleted BOOLEAN, piid STRING",
    "aasbs_lu_ia_status": "cd STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_loa": "agreement_end_dt TIMESTAMP_NTZ, agreement_number STRING, appropriation STRING, customer_act_num STRING, "
                 "customer_fund STRING, first_fy_available_year INT, fund_type_cd STRING, ginv_line_num INT, id BIGINT, "
                 "is_deleted BOOLEAN, last_fy_available_year INT, loa_status_cd STRING, requesting_agency_cd STRING, "
                 "tracking_num BIGINT, transmitted_dt TIMESTAMP_NTZ, treasury_sub_account STRING, "
                 "tsym_alloc_trans_agency_cd STRING, tsym_availability_type STRING",
    "aasbs_lu_loa_status": "cd STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_award": "award_fin STRING, award_piid STRING, award_status_cd STRING, id BIGINT, is_deleted BOOLEAN, "
                   "latest_award_mod_id BIGINT, lead_svc_activity_address_cd STRING",
    "aasbs_award_mod": "award_id BIGINT, co_signature_dt TIMESTAMP_NTZ, id BIGINT, is_deleted BOOLEAN, "
                       "m1p_mod_start_dt TIMESTAMP_NTZ, mod_num STRING",
    "aasbs_award_ia": "award_id BIGINT, ia_id BIGINT, is_deleted BOOLEAN",
    "aasbs_funding": "billing_type_cd STRING, fund_category_cd STRING, fund_status_cd STRING, ia_id BIGINT, id BIGINT, "
                     "is_deleted BOOLEAN, latest_funding_amendment_id BIGINT",
    "aasbs_funding_amendment": "fund_amend_status_cd STRING, funding_id BIGINT, id BIGINT, is_deleted BOOLEAN",
    "aasbs_funding_amendment_loa": "funding_amendment_id BIGINT, is_deleted BOOLEAN, loa_change_amt DECIMAL(15,2), loa_id BIGINT",
    "aasbs_lu_fund_status": "cd STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_lu_fund_category": "cd STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_lu_billing_type": "cd STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_line_item": "id BIGINT, is_deleted BOOLEAN, li_deliverable_id BIGINT, li_tracking_num STRING, "
                       "line_item_end_dt TIMESTAMP_NTZ, line_item_fy INT, line_item_num STRING, "
                       "line_item_start_dt TIMESTAMP_NTZ, line_item_total_amt DECIMAL(15,2), line_item_type_cd STRING, "
                       "parent_award_mod_id BIGINT",
    "aasbs_line_item_accepted": "award_mod_id BIGINT, budget_fy INT, exercise_this_yn STRING, id BIGINT, "
                                "is_deleted BOOLEAN, line_item_id BIGINT",
    "aasbs_li_deliverable": "bona_fide_need_fy INT, contract_type_cd STRING, id BIGINT, is_deleted BOOLEAN, psc_cd STRING, "
                            "severability_type_cd STRING, unit_of_measure_cd STRING",
    "aasbs_lu_line_item_type": "cd STRING, description STRING, is_deleted BOOLEAN",
    "aasbs_loa_ledger": "created_dt TIMESTAMP_NTZ, funding_id BIGINT, ia_id BIGINT, id BIGINT, is_deleted BOOLEAN, "
                        "line_item_accepted_id BIGINT, line_item_certified_amt DECIMAL(15,2), "
                        "line_item_committed_amt DECIMAL(15,2), line_item_obligated_amt DECIMAL(15,2), loa_id BIGINT, "
                        "service_charge_amt DECIMAL(15,2), transaction_type_cd STRING",
    "aasbs_invoice_item": "cost_line_item_accepted_id BIGINT, id BIGINT, invoice_id BIGINT, invoice_item_amt DECIMAL(15,2), "
                          "is_deleted BOOLEAN",
    "aasbs_acceptance_item": "acceptance_id BIGINT, is_deleted BOOLEAN, item_gsa_approved_amt DECIMAL(15,2), "
                             "line_item_accepted_id BIGINT",
    "aasbs_bill_item": "bill_item_amt DECIMAL(15,2), is_deleted BOOLEAN, line_item_accepted_id BIGINT",
}

T = dt.datetime
ROWS = {
    "aasbs_lu_activity_address_code": [
        dict(cd="47QA01", description="Region 1", fpds_ng_agency_identifier="47", program_cd="P1", region_cd="01"),
        dict(cd="47QA02", description="Region 2", fpds_ng_agency_identifier="47", region_cd="02"),
        dict(cd="DEAD01", description="gone", fpds_ng_agency_identifier="47", is_deleted=True)],
    "aasbs_lu_agency": [dict(cd="GSA", cd_2char="47", description="General Services Administration")],
    "aasbs_lu_bureau": [dict(agency_cd="GSA", cd="B2", description="Bureau Two", updated_dt=T(2020, 1, 1)),
                        dict(agency_cd="GSA", cd="B1", description="Bureau One", updated_dt=T(2019, 1, 1))],
    "table_master_lu_federal_agency": [dict(agency_code="47", agency_description="GSA", agency_type="EXEC")],
    "aasbs_ia": [dict(id=10, piid="IA-10", instrument_type_cd="mipr", ia_status_cd="A", activity_address_cd="47QA01"),
                 dict(id=11, piid="IA-11", instrument_type_cd=None, ia_status_cd="Z", activity_address_cd="NOPE")],
    "aasbs_lu_ia_status": [dict(cd="A", description="Active")],
    "aasbs_loa": [dict(id=100, tracking_num=5, loa_status_cd="O", requesting_agency_cd="4712", customer_fund="F1",
                       tsym_alloc_trans_agency_cd="047", appropriation="0600", treasury_sub_account="",
                       is_deleted=False)],
    "aasbs_lu_loa_status": [dict(cd="O", description="Open")],
    "aasbs_award": [dict(id=1000, award_piid="AW-1", award_status_cd="ACTIVE", latest_award_mod_id=501,
                         lead_svc_activity_address_cd="47QA02")],
    "aasbs_award_mod": [dict(id=500, award_id=1000, mod_num="0", m1p_mod_start_dt=T(2021, 1, 1)),
                        dict(id=501, award_id=1000, mod_num="P01", m1p_mod_start_dt=T(2021, 6, 1),
                             co_signature_dt=T(2021, 6, 2))],
    "aasbs_award_ia": [dict(award_id=1000, ia_id=11), dict(award_id=1000, ia_id=10)],
    "aasbs_funding": [dict(id=7, ia_id=10, fund_status_cd="S", latest_funding_amendment_id=70)],
    "aasbs_funding_amendment": [dict(id=70, funding_id=7), dict(id=71, funding_id=7)],
    "aasbs_funding_amendment_loa": [dict(funding_amendment_id=70, loa_change_amt=D("100.00"), loa_id=100),
                                    dict(funding_amendment_id=71, loa_change_amt=D("-25.00"), loa_id=100)],
    "aasbs_lu_fund_status": [], "aasbs_lu_fund_category": [], "aasbs_lu_billing_type": [],
    "aasbs_line_item": [dict(id=2000, line_item_num="0001AA", parent_award_mod_id=501, line_item_fy=2021,
                             li_deliverable_id=9, line_item_type_cd="SVC")],
    "aasbs_line_item_accepted": [dict(id=3000, line_item_id=2000, budget_fy=2021, exercise_this_yn="Y"),
                                 dict(id=3001, line_item_id=2000, budget_fy=2022, exercise_this_yn="N")],
    "aasbs_li_deliverable": [dict(id=9, psc_cd="R499")],
    "aasbs_lu_line_item_type": [dict(cd="SVC", description="Service")],
    "aasbs_loa_ledger": [
        dict(id=1, line_item_accepted_id=3001, loa_id=100, funding_id=7, ia_id=10, created_dt=T(2021, 10, 5),
             line_item_obligated_amt=D("60.00"), transaction_type_cd="OBL"),
        dict(id=2, line_item_accepted_id=3001, loa_id=100, funding_id=7, ia_id=10, created_dt=T(2021, 10, 20),
             line_item_obligated_amt=D("40.00"), transaction_type_cd="OBL"),
        dict(id=3, line_item_accepted_id=3001, loa_id=100, funding_id=7, ia_id=10, created_dt=T(2021, 11, 1),
             line_item_obligated_amt=D("0.00")),                      # zero row → dropped
        dict(id=4, line_item_accepted_id=3001, loa_id=100, funding_id=7, ia_id=10, created_dt=T(2021, 12, 1),
             line_item_obligated_amt=D("999.00"), is_deleted=True)],
    "aasbs_invoice_item": [dict(id=1, cost_line_item_accepted_id=9999, invoice_id=1, invoice_item_amt=D("5.00"))],
    "aasbs_acceptance_item": [dict(acceptance_id=1, line_item_accepted_id=3001, item_gsa_approved_amt=D("30.00")),
                              dict(acceptance_id=2, line_item_accepted_id=3001, item_gsa_approved_amt=D("10.00"))],
    "aasbs_bill_item": [dict(line_item_accepted_id=3001, bill_item_amt=D("12.00"))],
}


@pytest.fixture(scope="module")
def gold(spark):
    silver = {}
    for name, schema in SCHEMAS.items():
        cols = [c.strip().split(" ")[0] for c in re.split(r",(?![^()]*\))", schema)]
        rows = [tuple(r.get(c) for c in cols) for r in ROWS.get(name, [])]
        silver[name] = spark.createDataFrame(rows, schema)
    return build_all(silver, "2022-01-01")


def test_agency_one_row_per_aac(gold):
    a = gold["common.dim_agency"]
    rows = {r.activity_address_cd: r for r in a.collect()}
    assert set(rows) == {"47QA01", "47QA02"}                      # deleted AAC excluded
    r = rows["47QA01"]
    assert (r.agency_code, r.agency_name, r.bureau_code, r.is_omb_agency_flag) == \
        ("47", "General Services Administration", "B1", True)      # first bureau by date (D-16)
    assert sorted(x.agency_sk for x in rows.values()) == [1, 2]
    assert Q.dup_keys(a, ["activity_address_cd"]).count() == 0


def test_ia_type_status_and_agency(gold):
    rows = {r.ia_id: r for r in gold["common.dim_ia"].collect()}
    assert (rows[10].ia_type_cd, rows[10].ia_status_desc, rows[10].servicing_agency_sk) == ("ORDER", "Active", 1)
    assert (rows[11].ia_type_cd, rows[11].ia_status_desc, rows[11].servicing_agency_sk) == (None, "Z", -1)


def test_loa_prefix_lookup_does_not_fan_out(gold):
    loa = gold["common.dim_loa"].collect()
    assert len(loa) == 1
    assert (loa[0].agency_sk, loa[0].treasury_account_symbol, loa[0].loa_status_desc) == (1, "047-4712-0600", "Open")


def test_award_ia_through_bridge(gold):
    aw = gold["common.dim_award"].collect()
    assert len(aw) == 1                                              # no cross product (D-7)
    ia10 = [r.ia_sk for r in gold["common.dim_ia"].collect() if r.ia_id == 10][0]
    r = aw[0]
    assert (r.ia_sk, r.agency_sk, r.award_mod_num, r.total_mods_count, r.base_award_dt) == \
        (ia10, 2, "P01", 2, T(2021, 1, 1))


def test_funding_total(gold):
    f = gold["common.dim_funding"].first()
    assert (f.total_funded_amt, f.fund_status_desc, f.agency_sk) == (D("75.00"), "S", 1)


def test_line_item_latest_accepted(gold):
    li = gold["common.dim_line_item"].first()
    assert (li.line_item_accepted_id, li.budget_fy, li.exercise_this_yn, li.slin_num, li.psc_cd,
            li.line_item_type_desc) == (3001, 2022, False, "AA", "R499", "Service")
    assert li.award_sk == gold["common.dim_award"].first().award_sk


def test_fact_obligation(gold):
    rows = {r.fiscal_month: r for r in gold["oet.fact_obligation_expenditure"].collect()}
    # Oct and Nov grains; the deleted Dec ledger row is gone. Line-level acceptance
    # amounts sit on every grain of the line (prime rule), so Nov is not all zero.
    assert sorted(rows) == [1, 2]
    r = rows[1]
    assert (r.fiscal_year, r.fiscal_quarter, r.snapshot_date_sk) == (2022, 1, 20211020)
    assert (r.obligated_amt, r.accepted_amt, r.invoiced_amt, r.billed_amt, r.udo_amt) == \
        (D("100.00"), D("40.00"), D("0.00"), D("12.00"), D("60.00"))
    assert (r.acceptance_count, r.invoice_count, r.source_loa_ledger_ids) == (2, 0, "1,2")
    assert min(r.loa_sk, r.funding_sk, r.award_sk, r.ia_sk, r.agency_sk) > 0
    assert (rows[2].obligated_amt, rows[2].accepted_amt, rows[2].udo_amt) == (D("0.00"), D("40.00"), D("-40.00"))


def test_fact_drops_all_zero_rows(spark, gold):
    from gildhall.plans.domain.oet import fact_obligation_expenditure
    silver = {n: spark.createDataFrame([], sch) for n, sch in SCHEMAS.items()}
    silver["aasbs_loa_ledger"] = spark.createDataFrame(
        [(T(2021, 10, 5), 7, 10, 1, None, 4242, None, None, D("0.00"), 100, None, None)], SCHEMAS["aasbs_loa_ledger"])
    assert fact_obligation_expenditure(silver, gold, "2022-01-01").count() == 0
    assert F is not None


def test_cdc_refresh_dimension_and_fact(spark, gold):
    """An IA status change closes the old version and opens a new one with a
    fresh surrogate key; an unchanged IA is kept; the fact is re-aggregated
    for the grains touched in the window only."""
    from gildhall.plans.domain.cdc import affected_fact_grains, refresh_dimension, refresh_fact
    silver = {}
    for name, schema in SCHEMAS.items():
        cols = [c.strip().split(" ")[0] for c in re.split(r",(?![^()]*\))", schema)]
        rows = [tuple(r.get(c) for c in cols) for r in ROWS.get(name, [])]
        silver[name] = spark.createDataFrame(rows, schema)
    ia = silver["aasbs_ia"]
    ia = ia.withColumn("ia_status_cd", F.when(F.col("id") == 10, F.lit("C")).otherwise(F.col("ia_status_cd"))) \
        .withColumn("updated_dt", F.when(F.col("id") == 10, F.lit("2022-02-01 10:00:00").cast("timestamp_ntz")))
    silver["aasbs_ia"] = ia
    out = refresh_dimension(silver, gold, "common.dim_ia", "2022-02-01", "2022-03-01", "2022-03-01", "cdc-1")
    rows = sorted((r.ia_id, r._action, r.ia_status_cd, r.ia_sk, r.is_current_flag) for r in out.collect())
    assert rows == [(10, "closed", "A", 1, False), (10, "inserted", "C", 3, True), (11, "kept", "Z", 2, True)]
    assert Q.scd2_invariants(out, ["ia_id"]).count() == 0
    delta = refresh_dimension(silver, gold, "common.dim_ia", "2022-02-01", "2022-03-01", "2022-03-01", "cdc-1",
                              changes_only=True)
    assert sorted((r.ia_id, r._action, r.ia_sk) for r in delta.collect()) == [(10, "closed", 1), (10, "inserted", 3)]

    g = silver["aasbs_acceptance_item"]
    silver["aasbs_acceptance_item"] = g.unionByName(spark.createDataFrame(
        [(3, None, D("5.00"), 3001)], SCHEMAS["aasbs_acceptance_item"])).withColumn(
        "created_dt", F.when(F.col("acceptance_id") == 3, F.lit("2022-02-10").cast("timestamp_ntz")))
    grains = sorted(tuple(r) for r in affected_fact_grains(silver, "2022-02-01", "2022-03-01").collect())
    assert grains == [(3001, 100)]                                   # distinct on the 2-column grain (D-4)
    fact = {r.fiscal_month: r for r in refresh_fact(silver, gold, "2022-02-01", "2022-03-01", "2022-03-01", "c").collect()}
    assert fact[1].accepted_amt == D("45.00") and fact[1]._source_batch_id == "c"


def test_cdc_fact_accrual_only_when_fresh(spark, gold):
    """accrued_amt is filled only when the accrual product ran after the window start (CDC-6)."""
    from gildhall.operators import audit_event
    from gildhall.plans.domain.cdc import refresh_fact
    silver = {}
    for name, schema in SCHEMAS.items():
        cols = [c.strip().split(" ")[0] for c in re.split(r",(?![^()]*\))", schema)]
        rows = [tuple(r.get(c) for c in cols) for r in ROWS.get(name, [])]
        silver[name] = spark.createDataFrame(rows, schema)
    silver["aasbs_loa_ledger"] = silver["aasbs_loa_ledger"].withColumn(
        "created_dt", F.when(F.col("id") == 1, F.lit("2022-02-05").cast("timestamp_ntz")).otherwise(F.col("created_dt")))
    silver["aasbs_accrual_income"] = spark.createDataFrame([(3001, D("7.50"), None), (3001, D("2.50"), None)],
                                                           "line_item_accepted_id bigint, calculated_income_amt "
                                                           "decimal(15,2), is_deleted boolean")
    fresh = audit_event(spark, run_id="r", target_table="air.fact_accrual_income", run_status="SUCCESS",
                        product="DP4", event_ts=T(2022, 2, 20), end_ts=T(2022, 2, 20), watermark_to=T(2022, 2, 20))
    stale = audit_event(spark, run_id="r", target_table="air.fact_accrual_income", run_status="SUCCESS",
                        product="DP4", event_ts=T(2022, 1, 20), end_ts=T(2022, 1, 20), watermark_to=T(2022, 1, 20))
    on = refresh_fact(silver, gold, "2022-02-01", "2022-03-01", "2022-03-01", "c", audit=fresh).collect()
    off = refresh_fact(silver, gold, "2022-02-01", "2022-03-01", "2022-03-01", "c", audit=stale).collect()
    assert {r.accrued_amt for r in on} == {D("10.00")}
    assert {r.accrued_amt for r in off} == {D("0.00")}


def test_lazy_gold_builds_only_the_closure(spark):
    """Asking for one target builds exactly what its builders read, each once, in
    dependency order; the target itself comes back unmaterialised; cycles fail."""
    from gildhall.plans.domain import LazyGold
    calls, mats = [], []

    def mk(name, reads):
        def build(silver, gold, as_of):
            calls.append(name)
            for r in reads:
                gold[r]
            return spark.range(1).withColumnRenamed("id", name.replace(".", "_"))
        return build

    builders = {"a": mk("a", []), "b": mk("b", ["a"]), "c": mk("c", ["a", "b"]), "unused": mk("unused", ["a"])}
    g = LazyGold({}, "2024-01-01", materialise=lambda n, df: (mats.append(n), df)[1], builders=builders)
    g.plan("c")
    assert calls == ["c", "a", "b"] and mats == ["a", "b"] and g.built() == ["a", "b"]
    assert "unused" in g and "zzz" not in g
    cyc = LazyGold({}, "2024-01-01", builders={"x": mk("x", ["y"]), "y": mk("y", ["x"])})
    import pytest
    with pytest.raises(ValueError, match="cycle"):
        cyc.plan("x")
