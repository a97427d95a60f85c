"""Bucketed tables: joins on the bucket key without a shuffle, hot keys beside the buckets."""

import pytest
from pyspark.sql import functions as F

from gildhall.sources.bucketed import Lookup, open_bucketed, resolve_bucketed, write_bucketed


@pytest.fixture()
def no_broadcast(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as made, not as re-planned
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def tables(spark, root, hot_rows=50):
    # key 7 holds a third of all rows; keys over 90 are unknown to the lookups; some rows have no key
    fact = spark.range(900).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id") % 97).alias("k"))
    dim = spark.range(91).select(F.col("id").alias("nk"), (F.col("id") + 1000).alias("a_sk"), F.concat(F.lit("n"), "id").alias("name"))
    other = spark.range(0, 91, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b_sk"))
    return (fact, dim, other, write_bucketed(fact, f"{root}/fact", "k", 8, hot_rows), write_bucketed(dim, f"{root}/dim", "nk", 8),
            write_bucketed(other, f"{root}/other", "k", 8))


def steps(dim, other):
    return [Lookup(dim, "a_sk", carry={"name": "a_name"}), Lookup(other, "b_sk", missing=-2)]


def test_rows_and_hot_key(spark, tmpdir_run):
    fact, dim, other, f, d, o = tables(spark, tmpdir_run)
    assert f.hot_keys == (7,) and d.hot_keys == () and f.hot.where("k IS NULL").count() == fact.where("k IS NULL").count()
    assert sorted(map(tuple, f.all().collect()), key=str) == sorted(map(tuple, fact.collect()), key=str)
    got = sorted(map(tuple, resolve_bucketed(f, steps(d, o)).select("id", "k", "a_sk", "a_name", "b_sk").collect()))
    want = []
    for i, k in fact.collect():
        known = k is not None and k < 91
        want.append((i, k, k + 1000 if known else -1, f"n{k}" if known else None, k * 2 if known and k % 2 == 0 else -2))
    assert str(got) == str(sorted(want))


def test_no_shuffle_over_the_buckets(spark, tmpdir_run, no_broadcast):
    *_, f, d, o = tables(spark, tmpdir_run)
    cold = resolve_bucketed(f, steps(d, o)).select("id", "a_sk", "b_sk")
    plan = cold._jdf.queryExecution().executedPlan().toString()
    buckets, hot = plan.split("\n:- ")[1].split("\n+- ")
    assert "SortMergeJoin" in buckets and "Exchange" not in buckets and buckets.count("Bucketed: true") == 3
    assert "BroadcastHashJoin" in hot


def test_opened_by_path(spark, tmpdir_run):
    fact, *_, f, d, o = tables(spark, tmpdir_run)
    again = open_bucketed(spark, f"{tmpdir_run}/fact")
    assert again.hot_keys == f.hot_keys and again.rows.count() == f.rows.count() and again.buckets == 8
    with pytest.raises(FileExistsError):
        write_bucketed(fact, f"{tmpdir_run}/fact", "k", 8)
    with pytest.raises(FileNotFoundError):
        open_bucketed(spark, f"{tmpdir_run}/none")


def test_repeated_key_empty_tables_and_other_buckets(spark, tmpdir_run):
    fact, dim, other, f, d, o = tables(spark, tmpdir_run)
    twice = write_bucketed(dim.union(dim.where("nk = 7")), f"{tmpdir_run}/twice", "nk", 8)
    with pytest.raises(Exception, match="key not unique"):
        resolve_bucketed(f, [Lookup(twice, "a_sk")]).collect()
    none = write_bucketed(dim.where("false"), f"{tmpdir_run}/none", "nk", 8)
    assert {r["a_sk"] for r in resolve_bucketed(f, [Lookup(none, "a_sk")]).collect()} == {-1}
    empty = write_bucketed(fact.where("false"), f"{tmpdir_run}/empty", "k", 8)
    assert resolve_bucketed(empty, steps(d, o)).collect() == []
    with pytest.raises(ValueError, match="buckets"):
        resolve_bucketed(f, [Lookup(write_bucketed(dim, f"{tmpdir_run}/four", "nk", 4), "a_sk")])
