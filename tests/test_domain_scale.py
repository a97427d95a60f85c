"""Plans of the domain builders over derived Silver: what moves, and on which rows keys are resolved."""

import pytest
from pyspark.sql import functions as F

from gildhall.plans.payments_silver import payments_silver
from gildhall.plans.standins import AS_OF
from gildhall.sources.tables import Tables

SF = "/root/testdata/sf0.001"
FLAG = "is_current_flag boolean"
DIMS = {"common.dim_ia": f"ia_id bigint, ia_sk bigint, {FLAG}",
        "common.dim_agency": f"activity_address_cd string, agency_sk bigint, {FLAG}",
        "common.dim_loa": f"loa_id bigint, loa_sk bigint, {FLAG}",
        "common.dim_award": f"award_id bigint, award_mod_id bigint, award_sk bigint, award_start_dt timestamp_ntz, {FLAG}",
        "common.dim_line_item": "line_item_id bigint, line_item_accepted_id bigint, line_item_sk bigint, li_pop_end_dt timestamp_ntz, "
                                f"obligated_ceiling_amt decimal(15,2), {FLAG}",
        "alt.dim_acquisition": "acquisition_id bigint, acquisition_sk bigint, agency_sk bigint, acquisition_status_cd string, "
                               f"created_dt timestamp_ntz, {FLAG}",
        "alt.dim_solicitation": "solicit_id bigint, acquisition_sk bigint, solicitation_sk bigint",
        "alt.dim_closeout": "acquisition_id bigint, closeout_sk bigint",
        "alt.dim_contractor": f"award_mod_company_id bigint, contractor_sk bigint, duns_num string, small_business_flag boolean, {FLAG}",
        "air.dim_accrual_period": "accrual_year int, accrual_month int, accrual_period_sk bigint",
        "air.dim_onefund_program": "aac string, onefund_sk bigint",
        "psc.dim_billing_period": "schedule_id bigint, billing_period_sk bigint",
        "psc.dim_clin_subtype": "line_item_id bigint, clin_subtype_sk bigint",
        "psc.dim_cost_rate_type": "cost_rate_type_cd string, cost_rate_type_sk bigint",
        "fre.dim_fpds_award": "award_id bigint, fpds_award_sk bigint", "fre.dim_fpds_agency": "aac string, fpds_agency_sk bigint",
        "fre.dim_fpds_psc": "psc_cd string, psc_sk bigint",
        "fre.dim_fpds_contractor": "award_mod_company_id bigint, fpds_contractor_sk bigint",
        "smi.dim_piid": "piid_id bigint, piid_sk bigint", "smi.dim_posting_type": "solicit_id bigint, posting_type_sk bigint",
        "tpp.dim_receiving_report": "rr_summary_id bigint, receiving_report_sk bigint"}


@pytest.fixture(scope="module")
def silver(spark):
    return payments_silver(Tables(spark, SF))


@pytest.fixture(scope="module")
def gold(spark):
    return {name: spark.createDataFrame([], schema) for name, schema in DIMS.items()}


def _joins(df, kind=""):
    """Condition and names of the left side of each join (of a kind) in the analyzed plan of ``df``."""
    out = []

    def walk(node):
        if node.nodeName() == "Join" and kind in node.joinType().toString():
            names = node.left().output().toString()
            out.append((node.condition().toString(), names))
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(df._jdf.queryExecution().analyzed())
    return out


def _left_of(df, key):
    found = [left for cond, left in _joins(df) if f"({key}#" in cond or f" {key}#" in cond]
    assert found, key
    return found


def test_tables_of_lines_scan_the_grouped_lines(spark, silver):
    """Line items are grouped once and stored; the Silver tables of lines are scans of that."""
    for name in ("aasbs_line_item", "aasbs_line_item_accepted", "aasbs_accrual_expense", "aasbs_service_charge_schedule",
                 "aasbs_accrual_income", "aasbs_transmit_billing_summary"):
        assert "Exchange" not in silver[name]._jdf.queryExecution().executedPlan().toString(), name
    files = silver["aasbs_line_item"].inputFiles()
    assert files and sorted(files) == sorted(silver["aasbs_accrual_income"].inputFiles())


def test_lines_keep_the_rows_of_their_orders(spark, tmp_path):
    """A line without an order stays a line without an item; an order given twice gives its item twice."""
    from gildhall.plans.dp1_silver import derived_silver
    t = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("lineitem", "orders")}
    some = t["orders"].filter("o_orderkey % 3 <> 0")
    t["orders"] = some.unionByName(some.filter("o_orderkey % 5 = 0"))
    s = derived_silver(t)
    got = s["aasbs_line_item"].selectExpr("id", "parent_ia_id", "line_item_total_amt AS total")
    lines = t["lineitem"].groupBy("l_orderkey", "l_linenumber").agg({"l_extendedprice": "count"})
    want = lines.join(t["orders"], lines.l_orderkey == t["orders"].o_orderkey).selectExpr("l_orderkey * 100 + l_linenumber AS id", "o_custkey AS parent_ia_id")
    assert sorted(map(tuple, got.select("id", "parent_ia_id").collect())) == sorted(map(tuple, want.collect()))
    assert s["aasbs_line_item_accepted"].count() == lines.count() > got.select("id").distinct().count()


def test_lifecycle_keys_are_resolved_per_modification(silver, gold):
    """The lines carry no lookup of the award or acquisition but the one by modification."""
    from gildhall.plans.domain.alt_facts import fact_award_lifecycle
    f = fact_award_lifecycle(silver, gold, AS_OF)
    for key in ("ia_id", "acquisition_id", "acquisition_sk", "award_mod_company_id"):
        assert not any("lia_id#" in left or "current_accepted_amt#" in left for left in _left_of(f, key)), key


def test_accrual_keys_are_resolved_before_the_distributions(silver, gold):
    """Incomes and LOAs are resolved on their own rows, not on the distributions."""
    from gildhall.plans.domain.air_facts import fact_accrual_income
    f = fact_accrual_income(silver, gold, AS_OF)
    for key in ("accrual_expense_id", "line_item_accepted_id", "ia_id", "award_id"):
        assert not any("distribute_amt#" in left for left in _left_of(f, key)), key


def test_schedule_keys_are_resolved_on_lines(silver, gold):
    """the line's keys are resolved on the lines, which several schedules share."""
    from gildhall.plans.domain.psc_facts import fact_service_charge_schedule
    f = fact_service_charge_schedule(silver, gold, AS_OF)
    for key in ("parent_award_mod_id", "parent_ia_id", "lia_id"):
        assert not any("scheduled_amt#" in left for left in _left_of(f, key)), key


def test_acquisitions_without_an_ia_are_not_dealt_to_one_task(silver, gold, monkeypatch):
    """three quarters of the acquisitions have no IA; the IA's key is looked up for the others only."""
    from gildhall.plans.domain import alt_fre
    monkeypatch.setattr(alt_fre, "assign_sk", lambda df, keys, name: df)
    d = alt_fre.dim_acquisition(silver, gold, AS_OF)
    assert not any("acquisition_status_cd#" in left for left in _left_of(d, "ia_id"))


def test_responses_without_an_award_are_not_dealt_to_one_task(silver, gold):
    """most responses have no award; its keys are resolved on the awards."""
    from gildhall.plans.domain.smi_facts import fact_solicitation_response
    f = fact_solicitation_response(silver, gold, AS_OF)
    for key in ("award_id", "latest_award_mod_id", "ia_id", "acquisition_id", "ipartner_id"):
        assert not any("winning_response_yn#" in left for left in _left_of(f, key)), key


def test_lines_without_a_subtype_are_not_dealt_to_one_task(silver, gold):
    """plans are joined to the lines that point at one."""
    from gildhall.plans.domain.psc_facts import fact_clin_pricing
    f = fact_clin_pricing(silver, gold, AS_OF)
    for key in ("li_sc_labor_id", "li_sc_fixed_fee_id", "li_sc_travel_id"):
        assert not any("line_item_total_amt#" in left and "isnotnull" not in left and "parent_ia_id#" in left for left in _left_of(f, key)), key
    assert not any("line_item_total_amt#" in left for left in _left_of(f, "loa_id"))


def test_modifications_without_a_lookup_key_are_not_dealt_to_one_task(silver, gold):
    """half of the modifications have no ledger rows, no solicitation, most no company."""
    from gildhall.plans.domain.fre_facts import fact_fpds_transaction
    f = fact_fpds_transaction(silver, gold, AS_OF)
    for key in ("ia_id", "first_loa_id", "_company_id", "solicit_id"):
        assert not any("m1p_sf30_mod_type_cd#" in left for left in _left_of(f, key)), key


def test_invoices_without_a_line_or_report_are_not_dealt_to_one_task(silver, gold):
    """line, receiving report and IA keys are resolved on the rows that have them."""
    from gildhall.plans.domain.tpp_facts import fact_payment_reconciliation
    f = fact_payment_reconciliation(silver, gold, AS_OF)
    for key in ("primary_lia_id", "rr_summary_id", "ia_id"):
        assert not any("pegasys_doc_num#" in left for left in _left_of(f, key)), key


def test_distributions_are_stored_before_the_incomes_are_joined(silver, gold):
    """transmissions, LOAs and batches are joined in steps of their own, whose shuffle files end with them."""
    from gildhall.plans.domain.air_facts import fact_accrual_income
    f = fact_accrual_income(silver, gold, AS_OF)
    assert not any("dist_id#" in cond or "tracking_num#" in cond or "accrual_header_id#" in cond for cond, _ in _joins(f))
    assert not any("accrual_income_amt#" in left for left in _left_of(f, "ia_id"))


def test_lines_of_the_lifecycle_are_stored_before_their_modifications(silver, gold):
    """what is known by line is joined in a step of its own, whose shuffle files end with it."""
    from gildhall.plans.domain.alt_facts import fact_award_lifecycle
    assert not any("lia_id#" in cond for cond, _ in _joins(fact_award_lifecycle(silver, gold, AS_OF)))


def test_change_loads_read_items_of_affected_lines_only(spark, silver, gold):
    """items, accepted lines and line items of untouched lines are dropped before they are aggregated."""
    from gildhall.plans.domain.oet import fact_obligation_expenditure
    more = {"common.dim_line_item": f"line_item_id bigint, line_item_sk bigint, award_sk bigint, {FLAG}",
            "common.dim_funding": f"funding_id bigint, funding_sk bigint, {FLAG}",
            "common.dim_ia": f"ia_id bigint, ia_sk bigint, servicing_agency_sk bigint, {FLAG}"}
    built = {**gold, **{name: spark.createDataFrame([], schema) for name, schema in more.items()}}
    some = silver["aasbs_loa_ledger"].select("line_item_accepted_id", "loa_id").filter("line_item_accepted_id % 10 = 1")
    f = fact_obligation_expenditure(silver, built, AS_OF, affected=some)
    kept = [left for _, left in _joins(f, "LeftSemi")]
    for column in ("invoice_item_amt#", "item_gsa_approved_amt#", "bill_item_amt#", "line_item_sk#"):
        assert any(column in left for left in kept), column


def test_invoices_without_a_purchase_order_are_not_dealt_to_one_task(silver, gold):
    """only invoices with a purchase order are joined to one, and items are reduced before their invoices are looked up."""
    from gildhall.plans.domain.tpp_facts import fact_payment_reconciliation
    f = fact_payment_reconciliation(silver, gold, AS_OF)
    ordered = [left for cond, left in _joins(f) if "purchase_order_number#" in cond]
    assert ordered and not any("line_item_sk#" in left for left in ordered)
    assert [left for _, left in _joins(f, "LeftSemi") if "primary_lia_id#" in left]


def test_dimensions_are_not_run_again_for_a_sample_of_their_keys(silver, gold, monkeypatch):
    """the rows of large dimensions are dealt by quantiles of their key in Silver, not by a sample of their own rows."""
    from gildhall.operators import sequence
    from gildhall.plans.domain import common, tpp_air
    seen = []
    monkeypatch.setattr(sequence, "stored", lambda df: seen.append(df._jdf.queryExecution().analyzed().toString()) or df)
    for build in (common.dim_award, common.dim_line_item, common.dim_ia, tpp_air.dim_receiving_report):
        build(silver, gold, AS_OF)
    assert len(seen) == 4 and not any("RepartitionByExpression [" in plan and " ASC NULLS FIRST]" in plan.split("RepartitionByExpression [")[1].split("\n")[0]
                                      for plan in seen)


def test_lines_of_repeated_orders_stay_single(spark):
    """accepted lines stand once, whatever number of rows their order has, none included."""
    from gildhall.plans.dp1_silver import line_groups, one_a_line
    t = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("lineitem", "orders")}
    some = t["orders"].filter("o_orderkey % 3 <> 0")
    t["orders"] = some.unionByName(some.filter("o_orderkey % 5 = 0")).unionByName(some.limit(3).selectExpr(
        "CAST(NULL AS BIGINT) AS o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    got = one_a_line(line_groups(t)())
    want = t["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("_total"))
    assert sorted(map(tuple, got.select("l_orderkey", "l_linenumber", "_total").collect())) == sorted(map(tuple, want.collect()))
