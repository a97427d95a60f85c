"""Streaming CDC: files of changes → availableNow → foreachBatch SCD2."""

import datetime as dt
import os

from pyspark.sql import functions as F

from gildhall.operators import quality as Q
from gildhall.streaming import dimension_history, initial_load, refresh_dimension

SCHEMA = "k int, tracked string, inplace string, updated_dt timestamp_ntz"


def test_stream_refresh(spark, tmpdir_run):
    src = os.path.join(tmpdir_run, "changes")
    dim = os.path.join(tmpdir_run, "dim")
    ckpt = os.path.join(tmpdir_run, "ckpt")
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "k int, tracked string, inplace string")
    initial_load(base, dim, "2024-01-01")

    t = dt.datetime
    spark.createDataFrame([(1, "A", "x", t(2024, 2, 1)), (1, "AA", "x", t(2024, 2, 2)),   # two versions: latest wins
                           (2, "b", "Y", t(2024, 2, 1)), (9, "n", "n", t(2024, 2, 1))], SCHEMA) \
        .write.mode("append").parquet(src)
    args = dict(spark=spark, source_dir=src, schema=SCHEMA, dim_path=dim, key=["k"], order_col="updated_dt",
                tracked=["tracked"], inplace=["inplace"], checkpoint=ckpt)
    assert refresh_dimension(**args) == 1

    h = dimension_history(spark, dim)
    cur = {r.k: (r.tracked, r.inplace) for r in h.filter("is_current_flag").collect()}
    assert cur == {1: ("AA", "x"), 2: ("b", "Y"), 3: ("c", "z"), 9: ("n", "n")}
    closed = [(r.k, r.tracked, r.eff_end_dt) for r in h.filter(~F.col("is_current_flag")).collect()]
    assert closed == [(1, "a", t(2024, 2, 2))]
    assert Q.scd2_invariants(h, ["k"]).count() == 0

    # nothing new: no batch runs, state unchanged
    assert refresh_dimension(**args) == 0
    assert dimension_history(spark, dim).count() == 5

    # a later file is processed once
    spark.createDataFrame([(3, "C", "z", t(2024, 3, 1))], SCHEMA).write.mode("append").parquet(src)
    assert refresh_dimension(**args) == 1
    h = dimension_history(spark, dim)
    assert h.filter((F.col("k") == 3) & F.col("is_current_flag")).first().tracked == "C"
    assert h.count() == 6 and Q.scd2_invariants(h, ["k"]).count() == 0


def _scenario(spark, tmpdir_run, buckets):
    src = os.path.join(tmpdir_run, f"changes-{buckets}")
    dim = os.path.join(tmpdir_run, f"dim-{buckets}")
    base = spark.createDataFrame([(k, f"t{k}", f"i{k}") for k in range(1, 21)], "k int, tracked string, inplace string")
    initial_load(base, dim, "2024-01-01", key=["k"], buckets=buckets)
    t = dt.datetime
    spark.createDataFrame([(1, "A", "i1", t(2024, 2, 1)), (2, "t2", "I", t(2024, 2, 1)), (30, "n", "n", t(2024, 2, 1)),
                           (5, "t5", "i5", t(2024, 2, 1))], SCHEMA).write.mode("append").parquet(src)
    args = dict(spark=spark, source_dir=src, schema=SCHEMA, dim_path=dim, key=["k"], order_col="updated_dt",
                tracked=["tracked"], inplace=["inplace"], checkpoint=os.path.join(tmpdir_run, f"ck-{buckets}"),
                buckets=buckets)
    assert refresh_dimension(**args) == 1
    spark.createDataFrame([(1, "AA", "i1", t(2024, 3, 1)), (7, "T7", "i7", t(2024, 3, 1))], SCHEMA) \
        .write.mode("append").parquet(src)
    assert refresh_dimension(**args) == 1
    h = dimension_history(spark, dim, buckets=buckets)
    return sorted((r.k, r.tracked, r.inplace, r.is_current_flag, r.eff_start_dt, r.eff_end_dt)
                  for r in h.select("k", "tracked", "inplace", "is_current_flag", "eff_start_dt", "eff_end_dt")
                  .collect()), h


def test_stream_bucketed_matches_plain(spark, tmpdir_run):
    """Bucketed layout (changes-only, touched buckets rewritten) gives the same
    dimension and history as the plain full rewrite."""
    plain, _ = _scenario(spark, tmpdir_run, None)
    bucketed, h = _scenario(spark, tmpdir_run, 4)
    assert plain == bucketed
    assert len(bucketed) == 24 and Q.scd2_invariants(h, ["k"]).count() == 0


def test_stream_replay_after_partial_write(spark, tmpdir_run, monkeypatch):
    """A failure after the history write but before the current write: the
    replayed epoch reuses its staged result, so history keeps the closed row."""
    from gildhall.streaming import cdc_stream
    dim = os.path.join(tmpdir_run, "dim-replay")
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, tracked string, inplace string")
    initial_load(base, dim, "2024-01-01")
    batch = spark.createDataFrame([(1, "A", "x", dt.datetime(2024, 2, 1))], SCHEMA)
    real_write = cdc_stream.write

    def failing(df, path, mode="overwrite", **kw):
        if path.endswith("current"):
            raise RuntimeError("lost executor")
        return real_write(df, path, mode, **kw)

    monkeypatch.setattr(cdc_stream, "write", failing)
    try:
        cdc_stream.apply_batch(spark, batch, 0, dim, ["k"], "updated_dt", ["tracked"], ["inplace"])
    except RuntimeError:
        pass
    monkeypatch.setattr(cdc_stream, "write", real_write)
    cdc_stream.apply_batch(spark, batch, 0, dim, ["k"], "updated_dt", ["tracked"], ["inplace"])   # replay
    cdc_stream.apply_batch(spark, batch, 0, dim, ["k"], "updated_dt", ["tracked"], ["inplace"])   # and again
    h = dimension_history(spark, dim)
    got = sorted((r.k, r.tracked, r.is_current_flag) for r in h.collect())
    assert got == [(1, "A", True), (1, "a", False), (2, "b", True)]


def test_new_versions_get_fresh_keys_and_keyless_rows_are_kept_apart(spark, tmpdir_run):
    from gildhall.streaming.cdc_stream import rejected_path
    t = dt.datetime
    for buckets in (None, 4):
        src, dim = os.path.join(tmpdir_run, f"src{buckets}"), os.path.join(tmpdir_run, f"dim{buckets}")
        base = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2), (3, "c", "z", 3)], "k int, tracked string, inplace string, sk long")
        initial_load(base, dim, "2024-01-01", key=["k"], buckets=buckets)
        args = dict(spark=spark, source_dir=src, schema=SCHEMA, dim_path=dim, key=["k"], order_col="updated_dt", tracked=["tracked"],
                    inplace=["inplace"], checkpoint=os.path.join(tmpdir_run, f"ckpt{buckets}"), buckets=buckets, sk="sk")
        spark.createDataFrame([(1, "A", "x", t(2024, 2, 1)), (2, "b", "Y", t(2024, 2, 1)), (None, "n1", "i", t(2024, 2, 1)),
                               (None, "n2", "i", t(2024, 2, 1)), (9, "n", "n", t(2024, 2, 1))], SCHEMA).write.mode("append").parquet(src)
        assert refresh_dimension(**args) == 1
        spark.createDataFrame([(1, "B", "x", t(2024, 3, 1))], SCHEMA).write.mode("append").parquet(src)
        assert refresh_dimension(**args) == 1
        h = dimension_history(spark, dim, buckets)
        assert {r.k: (r.tracked, r.sk) for r in h.filter("is_current_flag").collect()} == {1: ("B", 6), 2: ("b", 2), 3: ("c", 3), 9: ("n", 5)}
        assert sorted((r.k, r.tracked, r.sk) for r in h.filter("NOT is_current_flag").collect()) == [(1, "A", 4), (1, "a", 1)]
        bad = spark.read.parquet(rejected_path(dim)).collect()
        assert sorted((r.tracked, r._reason, r._epoch) for r in bad) == [("n1", "null_key", 0), ("n2", "null_key", 0)]
