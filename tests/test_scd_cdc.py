import datetime as dt

from pyspark.sql import functions as F

from gildhall.operators import (
    affected_grains, change_window, changed_keys, high_water, is_fresh, reaggregate, scd2_apply, scd2_asof,
    scd2_initial, scd2_stats,
)
from gildhall.operators import quality as Q

SCHEMA = "k int, tracked string, inplace string, other int"


def _dim(spark):
    cur = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2), (3, "c", "z", 3), (4, "d", "w", 4),
                                 (5, None, "v", 5), (6, "f", None, 6), (7, "g", "u", 7)], SCHEMA)
    return scd2_initial(cur, "2001-01-01")


def _incoming(spark):
    return spark.createDataFrame([
        (1, "A", "x", 1),      # tracked only → closed + inserted
        (2, "b", "Y", 2),      # in-place only → updated
        (3, "C", "Z", 3),      # both → closed + inserted (new version carries both)
        (4, "d", "w", 4),      # none → unchanged
        (5, "e", "v", 5),      # NULL → value on tracked
        (6, "f", "t", 6),      # NULL → value on in-place
        (8, "h", "s", 8),      # new key
    ], SCHEMA)


def test_scd2_classes(spark):
    out = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01", "b1")
    rows = {(r.k, r._action): r for r in out.collect()}
    assert set(rows) == {(1, "closed"), (1, "inserted"), (2, "updated"), (3, "closed"), (3, "inserted"),
                         (4, "unchanged"), (5, "closed"), (5, "inserted"), (6, "updated"), (7, "kept"), (8, "new")}
    c1 = rows[(1, "closed")]
    assert c1.tracked == "a" and c1.eff_end_dt == dt.datetime(2002, 1, 1) and c1.is_current_flag is False
    i3 = rows[(3, "inserted")]
    assert (i3.tracked, i3.inplace, i3.eff_start_dt, i3.eff_end_dt) == ("C", "Z", dt.datetime(2002, 1, 1), None)
    u2 = rows[(2, "updated")]
    assert (u2.inplace, u2.eff_start_dt) == ("Y", dt.datetime(2001, 1, 1))
    stats = {r._action: r.n_rows for r in scd2_stats(out).collect()}
    assert stats["closed"] == 3 and stats["inserted"] == 3 and stats["new"] == 1


def test_scd2_value_to_null_is_a_change(spark):
    cur = scd2_initial(spark.createDataFrame([(1, "a", "x", 1)], SCHEMA), "2001-01-01")
    inc = spark.createDataFrame([(1, None, "x", 1)], SCHEMA)
    acts = sorted(r._action for r in scd2_apply(cur, inc, ["k"], ["tracked"], ["inplace"], "2002-01-01").collect())
    assert acts == ["closed", "inserted"]


def test_scd2_idempotent(spark):
    """Applying the same batch twice changes nothing the second time."""
    first = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01", "b1")
    current = first.filter(F.col("is_current_flag")).drop("_action")
    second = scd2_apply(current, _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01", "b1")
    assert {r._action for r in second.collect()} <= {"unchanged", "kept"}
    a = sorted(tuple(r) for r in current.collect())
    b = sorted(tuple(r) for r in second.drop("_action").collect())
    assert a == b


def test_scd2_invariants_after_apply(spark):
    out = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01")
    assert Q.scd2_invariants(out, ["k"]).count() == 0


def test_scd2_asof(spark):
    out = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01")
    probe = spark.createDataFrame([(1, dt.datetime(2001, 6, 1)), (1, dt.datetime(2002, 1, 1)), (1, dt.datetime(1999, 1, 1))],
                                  "k int, t timestamp_ntz")
    got = sorted((r.t, r.tracked) for r in scd2_asof(out.drop("_action"), probe, ["k"], "t", ["tracked"]).collect())
    assert got == [(dt.datetime(1999, 1, 1), None), (dt.datetime(2001, 6, 1), "a"), (dt.datetime(2002, 1, 1), "A")]


def test_change_window_bounds_and_fallback(spark):
    ts = dt.datetime
    df = spark.createDataFrame([
        (1, ts(2024, 1, 1), ts(2020, 1, 1)),   # equal to lower bound → in
        (2, ts(2024, 2, 1), ts(2020, 1, 1)),   # equal to upper bound → out
        (3, None, ts(2024, 1, 15)),            # NULL updated, created inside → in
        (4, None, ts(2024, 2, 1)),             # NULL updated, created at upper bound → out
        (5, ts(2023, 12, 31), ts(2024, 1, 5)), # updated outside, created inside → out (no fallback)
    ], "id int, updated_dt timestamp_ntz, created_dt timestamp_ntz")
    got = sorted(r.id for r in df.filter(change_window("updated_dt", "created_dt", "2024-01-01", "2024-02-01")).collect())
    assert got == [1, 3]


def test_high_water_fallback_and_latest(spark):
    ts = dt.datetime
    audit = spark.createDataFrame([
        ("t", "SUCCESS", ts(2024, 1, 2), ts(2024, 1, 2)),
        ("t", "SUCCESS", ts(2024, 1, 3), ts(2024, 1, 3)),
        ("t", "FAILED", ts(2024, 1, 4), None),
        ("u", "FAILED", ts(2024, 1, 4), None),
    ], "target_table string, run_status string, end_ts timestamp_ntz, watermark_to timestamp_ntz")
    assert high_water(audit, "t", "2024-02-01").first().watermark_from == ts(2024, 1, 3)
    assert high_water(audit, "u", "2024-02-01 00:00:00").first().watermark_from == ts(2024, 1, 31)


def test_changed_keys_union_distinct(spark):
    parents = spark.createDataFrame([(1, True), (2, False), (None, True)], "id int, hit boolean")
    children = spark.createDataFrame([(1, True), (3, True), (4, False)], "pid int, hit boolean")
    got = sorted(r.k for r in changed_keys([(parents, "id", F.col("hit")), (children, "pid", F.col("hit"))], "k").collect())
    assert got == [1, 3]


def test_affected_grains_no_double_count(spark):
    """One line in two grains (two fundings) is re-aggregated once per grain (D-4)."""
    ledger = spark.createDataFrame([(1, "L1", 10), (1, "L2", 5), (2, "L1", 7)], "line int, loa string, amt int")
    changed_lines = spark.createDataFrame([(1, "L1"), (1, "L2")], "line int, loa string")
    changed_inv = spark.createDataFrame([(1, "L1")], "line int, loa string")
    g = affected_grains([(changed_lines, ["line", "loa"]), (changed_inv, ["line", "loa"])], ["line", "loa"])
    out = {(r.line, r.loa): r.total for r in reaggregate(ledger, g, ["line", "loa"], [F.sum("amt").alias("total")]).collect()}
    assert out == {(1, "L1"): 10, (1, "L2"): 5}


def test_is_fresh(spark):
    audit = spark.createDataFrame([("p", "SUCCESS", dt.datetime(2024, 1, 5)), ("q", "FAILED", dt.datetime(2024, 1, 5))],
                                  "product string, run_status string, end_ts timestamp_ntz")
    assert is_fresh(audit, "p", "2024-01-01").first().is_fresh is True
    assert is_fresh(audit, "q", "2024-01-01").first().is_fresh is False
    assert is_fresh(audit, "zzz", "2024-01-01").first().is_fresh is False


def test_scd2_changes_only_and_bucketed_rewrite(spark, tmpdir_run):
    """Only changed keys come back; stored by key bucket, a refresh rewrites only the
    touched buckets and the full state equals the full apply."""
    import os
    from gildhall.operators import key_bucket
    full = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01", "b1")
    delta_rows = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01", "b1",
                            changes_only=True)
    acts = sorted((r.k, r._action) for r in delta_rows.collect())
    assert acts == [(1, "closed"), (1, "inserted"), (2, "updated"), (3, "closed"), (3, "inserted"), (5, "closed"),
                    (5, "inserted"), (6, "updated"), (8, "new")]
    path = os.path.join(tmpdir_run, "dim_current")
    (_dim(spark).withColumn("_bucket", key_bucket(["k"], 4)).write.partitionBy("_bucket").parquet(path))
    changed_current = delta_rows.filter(F.col("is_current_flag")).drop("_action")
    # rewrite each touched bucket with: untouched rows of the bucket + changed current rows
    stored = spark.read.parquet(path)
    touched = changed_current.withColumn("_bucket", key_bucket(["k"], 4))
    keep = stored.join(touched.select("k"), "k", "left_anti").join(touched.select("_bucket").distinct(), "_bucket",
                                                                      "left_semi")
    # cut lineage (reliable checkpoint) before overwriting the folder it was read from
    rewrite = keep.unionByName(touched.select(*keep.columns)).checkpoint(eager=True)
    rewrite.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).drop("_bucket").select(*_dim(spark).columns).collect())
    want = sorted(tuple(r) for r in full.filter(F.col("is_current_flag")).drop("_action")
                  .select(*_dim(spark).columns).collect())
    assert got == want


def test_scd2_changes_only_plan_restricts_before_the_full_join(spark):
    """changes_only puts a left-semi join on the change set under the classifying
    full outer join, so untouched current rows never reach the big join."""
    plan = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"], "2002-01-01",
                      changes_only=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "FullOuter" in plan
    assert plan.index("FullOuter") < plan.index("LeftSemi")      # the semi-join sits below the full join
    full = scd2_apply(_dim(spark), _incoming(spark), ["k"], ["tracked"], ["inplace"],
                      "2002-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in full


KEYED = "k int, part string, tracked string, inplace string"


def _keyed_dim(spark):
    rows = [(1, "a", "x", "i"), (2, "a", "x", "i"), (2, "b", "x", "i"), (3, "a", "x", "i")]
    return scd2_initial(spark.createDataFrame(rows, KEYED), "2001-01-01")


def _bad_batch(spark):
    return spark.createDataFrame([
        (None, "a", "n1", "i"), (None, None, "n2", "i"), (2, None, "n3", "i"),   # parts of the key missing
        (1, "a", "y", "i"), (1, "a", "z", "i"), (9, "a", "p", "i"), (9, "a", "p", "i"),  # repeated: one in the dimension, one not
        (2, "b", "y", "i"), (7, "a", "new", "i"), (3, "a", "x", "j")], KEYED)


def _state(df):
    return sorted((r.k, r.part, r.tracked, r.inplace, r.is_current_flag, r._action, r._reason) for r in df.collect()
                  if r._action != "rejected")


def _merge(current, batch, **more):
    return scd2_apply(current, batch, ["k", "part"], ["tracked"], ["inplace"], "2002-01-01", on_duplicate="reject", rejects=True, **more)


def test_null_and_repeated_keys_are_rejected_and_change_nothing(spark):
    out = _merge(_keyed_dim(spark), _bad_batch(spark))
    assert _state(out) == [
        (1, "a", "x", "i", True, "kept", None), (2, "a", "x", "i", True, "kept", None), (2, "b", "x", "i", False, "closed", None),
        (2, "b", "y", "i", True, "inserted", None), (3, "a", "x", "j", True, "updated", None), (7, "a", "new", "i", True, "new", None)]
    bad = sorted(((r.tracked, r._reason, r.is_current_flag) for r in out.collect() if r._action == "rejected"))
    assert bad == [("n1", "null_key", None), ("n2", "null_key", None), ("n3", "null_key", None), ("p", "repeated_key", None),
                   ("p", "repeated_key", None), ("y", "repeated_key", None), ("z", "repeated_key", None)]


def test_a_batch_with_rejects_applied_twice_is_a_no_op(spark):
    first = _merge(_keyed_dim(spark), _bad_batch(spark))
    current = first.filter("is_current_flag").drop("_action", "_reason")
    again = _merge(current, _bad_batch(spark))
    assert {r._action for r in again.collect()} == {"kept", "unchanged", "rejected"}
    assert sorted(map(str, current.collect())) == sorted(map(str, again.filter("is_current_flag").drop("_action", "_reason").collect()))
    few = _merge(current, _bad_batch(spark), changes_only=True)
    assert {r._action for r in few.collect()} == {"rejected"}


def test_repeated_keys_raise_by_default(spark):
    import pytest
    with pytest.raises(Exception, match="incoming key repeated"):
        scd2_apply(_keyed_dim(spark), _bad_batch(spark), ["k", "part"], ["tracked"], ["inplace"], "2002-01-01").collect()
    fine = _bad_batch(spark).filter("k NOT IN (1, 9) OR k IS NULL")
    out = scd2_apply(_keyed_dim(spark), fine, ["k", "part"], ["tracked"], ["inplace"], "2002-01-01").collect()
    assert "rejected" not in {r._action for r in out} and all(r.k is not None and r.part is not None for r in out)
    assert "_reason" not in out[0].__fields__


def test_null_keys_stay_out_of_the_join(spark):
    """A third of the batch without a key: those rows are appended, not shuffled to the join's NULL partition."""
    batch = spark.range(3000).selectExpr("IF(id % 3 = 0, NULL, CAST(id AS INT)) AS k", "'a' AS part", "'t' AS tracked", "'i' AS inplace")
    out = _merge(_keyed_dim(spark), batch)
    assert out.filter("_action = 'rejected'").count() == 1000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1
    assert plan.index("Union") < plan.index("Join FullOuter")     # appended above the join


def test_asof_against_all_pairs(spark):
    """Keys with 1 to 3,000 versions and rows spread over partitions: the same as comparing every pair."""
    import datetime as dt
    import random
    rng = random.Random(5)
    day = lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(days=n)
    versions, facts = [], []
    for k, n in ((1, 3000), (2, 1), (3, 7), (4, 0), (5, 40)):
        cuts = sorted(rng.sample(range(5000), n))
        for i, c in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < n else None
            if end and rng.random() < 0.2:
                end = max(c + 1, end - 3)          # a gap without a version
            versions.append((k, f"v{k}_{i}", day(c), day(end) if end else None))
        facts += [(k, j, day(rng.randrange(-100, 5200))) for j in range(2000 if k == 1 else 60)]
        facts += [(k, 9000 + i, day(c)) for i, c in enumerate(cuts[:5])]     # at the very start of a version
    versions += [(3, "inverted", day(50), day(40)), (None, "keyless", day(0), None)]
    facts += [(None, 1, day(3)), (1, 2, None)]
    dim = spark.createDataFrame(versions, "k int, name string, eff_start_dt timestamp_ntz, eff_end_dt timestamp_ntz")
    df = spark.createDataFrame(facts, "k int, id int, t timestamp_ntz")
    want = []
    for k, i, t in facts:
        hit = [v for kk, v, s, e in versions if None not in (k, t, kk) and kk == k and s <= t and (e is None or t < e)]
        assert len(hit) <= 1
        want.append((k, i, t, hit[0] if hit else None))
    got = scd2_asof(dim, df, ["k"], "t", ["name"])
    assert got.columns == ["k", "id", "t", "name"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_asof_spreads_a_key_with_very_many_versions(spark):
    """100,000 versions of one key and as many rows: no task of the lookup holds more than a share of them."""
    versions = spark.range(100_000).selectExpr("1 AS k", "id AS name", "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2000-01-01') AS eff_start_dt",
                                               "timestampadd(HOUR, CAST(id + 1 AS INT), TIMESTAMP_NTZ'2000-01-01') AS eff_end_dt")
    rows = spark.range(100_000).selectExpr("1 AS k", "id", "timestampadd(MINUTE, CAST(id * 60 + 30 AS INT), TIMESTAMP_NTZ'2000-01-01') AS t")
    got = scd2_asof(versions, rows, ["k"], "t", ["name"])
    assert got.filter("id = name").count() == 100_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "eff_start_dt" not in plan.split("Join")[1].split("\n")[0]   # no range condition in a join
