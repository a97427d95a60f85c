"""Facts in stored steps: what a step has dealt is gone when the next begins."""

from collections import ChainMap

from pyspark.sql import functions as F

from gildhall.operators import period_contains
from gildhall.plans.dp1_silver import derived_silver
from gildhall.plans.domain.psc_facts import fact_service_charge_schedule
from gildhall.plans.q_domain import _gold
from gildhall.plans.standins import AS_OF
from gildhall.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_periods_are_dealt_once_where_no_item_ends_before_it_starts(spark):
    """the rows for items that end early met all periods, dealt once more by key, though there were none."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 1000).cast("int"))
    items = spark.range(300_000).select((F.col("id") % 90_000).alias("k"), day.alias("a"), F.date_add(day, 3).alias("b"))
    periods = spark.range(200_000).select((F.col("id") % 90_000).alias("k"), day.alias("p"), F.date_add(day, 60).alias("q"))
    plan = _plan(period_contains(items, periods, "k", "a", "b", "p", "q"))
    assert "_pc_bin" in plan and "hashpartitioning(k#" in plan.replace("hashpartitioning(_pc_0#", "hashpartitioning(k#")
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert not [line for line in dealt if "_pc_" not in line.replace("_pc_0", "k")], dealt


def test_items_that_end_early_still_match(spark):
    items = spark.createDataFrame([(1, "2000-01-10", "2000-01-05"), (1, "2000-01-03", "2000-01-04"), (2, "2000-01-10", "2000-01-05")], "k int, a string, b string") \
        .select("k", F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    periods = spark.createDataFrame([(1, "2000-01-01", "2000-01-06")], "k int, p string, q string").select(
        "k", F.to_date("p").alias("p"), F.to_date("q").alias("q"))
    got = {(r.k, str(r.a)) for r in period_contains(items, periods, "k", "a", "b", "p", "q").collect()}
    assert got == {(1, "2000-01-10"), (1, "2000-01-03")}


def test_schedule_fact_does_not_match_periods_in_its_last_step(spark):
    """the periods' bins, the line's keys and the schedules were dealt in one step."""
    t = Tables(spark, SF)
    plan = _plan(_gold(t).plan("psc.fact_service_charge_schedule"))
    assert "_pc_bin" not in plan and "parent_award_mod_id" not in plan


def test_accepted_lines_without_a_line_item_keep_their_key(spark):
    t = Tables(spark, SF)
    silver = derived_silver(t)
    gold = _gold(t, silver)
    some = ChainMap({"aasbs_line_item": silver["aasbs_line_item"].filter(F.col("id") % 2 == 0)}, silver)
    rows = fact_service_charge_schedule(some, gold, AS_OF)
    n, alone, known = rows.agg(F.count(F.lit(1)), F.count_if((F.col("award_sk") == -1) & (F.col("line_item_sk") > 0)),
                               F.count_if(F.col("award_sk") > 0)).first()
    assert alone > 0 and known > 0 and alone + known == n


def test_obligation_fact_moves_no_wide_row_for_the_ledgers_keys(spark):
    """the fact's rows were dealt anew for the line, LOA, funding and IA keys, all in one step."""
    plan = _plan(_gold(Tables(spark, SF)).plan("oet.fact_obligation_expenditure"))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert all("hashpartitioning(_row#" in line for line in dealt), dealt
    assert len(dealt) <= 2


def test_a_load_leaves_no_staged_rows(spark, tmpdir_run):
    """the state was staged as uncompressed checkpoint rows that stayed beside it."""
    import os

    from gildhall.operators import SnapshotFact
    fact = SnapshotFact(spark, f"{tmpdir_run}/fact", ["g"], ["id"], buckets=4)
    for load in (0, 1):
        rows = spark.range(load, 50).select((F.col("id") % 9).alias("g"), "id", (F.col("id") * 2 + load).alias("amt"))
        seen = fact.changed(rows, load)
        fact.append(load, rows.groupBy("g").agg(F.sum("amt").alias("amt")), rows.select("g"), seen)
    assert sorted(x for x in os.listdir(f"{tmpdir_run}/fact") if not x.startswith(".")) == ["affected", "seen", "snapshots", "state"]
    assert {r.g: r.amt for r in fact.state().collect()} == {g: sum(2 * i + 1 for i in range(1, 50) if i % 9 == g) for g in range(9)}


def test_line_item_dimension_is_stored_before_it_is_numbered(spark):
    """its joins and the dealing of its rows by key were one step, the largest of the facts that read it."""
    from gildhall.plans.domain.common import line_item_rows
    t = Tables(spark, SF)
    silver = derived_silver(t)
    plan = _plan(line_item_rows(silver, _gold(t, silver), AS_OF))
    assert "line_item_id" in plan and not [x for x in plan.splitlines() if "Exchange hashpartitioning(line_item_id" in x]


def test_lines_are_not_dealt_by_their_type(spark):
    """Read from files, the lines were dealt by a handful of codes before the code table was measured."""
    t = Tables(spark, SF)
    silver = derived_silver(t)
    lookup = silver["aasbs_lu_line_item_type"]
    lines = silver["aasbs_line_item"].select("id", "line_item_type_cd")
    plan = _plan(lines.join(lookup, lines["line_item_type_cd"] == lookup["cd"], "left"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning(line_item_type_cd" not in plan
    assert [tuple(r) for r in lookup.collect()] == [("F", "Fulfilled", None)]
