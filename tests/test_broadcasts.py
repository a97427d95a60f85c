"""Which sides are broadcast: measured ones by the session's threshold, others by a small file size."""

import pytest
from pyspark.sql import functions as F

from gildhall.operators import resolve_sk
from gildhall.session import BROADCAST, ESTIMATED_BROADCAST, MEASURED_BROADCAST, _bytes, measured_broadcasts, stored


@pytest.fixture
def ten_mb(spark):
    """A session as Spark makes it: 10 MB, whether measured or not."""
    before = {k: spark.conf.get(k, None) for k in (BROADCAST, MEASURED_BROADCAST)}
    spark.conf.set(BROADCAST, "10m")
    spark.conf.unset(MEASURED_BROADCAST)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _joins(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_many_rows_in_small_files_are_not_broadcast_by_estimate(ten_mb):
    """A dimension of sorted keys and empty columns: its files and the share of two columns in them are small, its rows many (F2)."""
    rows = ten_mb.range(3_000_000).select(F.col("id").alias("ia_id"), (F.col("id") * 7).alias("ia_sk"), F.lit(True).alias("is_current_flag"),
                                        *[F.lit(None).cast("string").alias(f"empty_{i}") for i in range(8)])
    dim = stored(rows.repartition(2).sortWithinPartitions("ia_id"))
    facts = stored(ten_mb.range(1_000_000).select((F.col("id") * 3).alias("ia_id"), F.rand(1).alias("amt")))
    assert "BroadcastHashJoin" not in _joins(facts.join(dim.select("ia_id", "ia_sk"), "ia_id"))
    assert "BroadcastHashJoin" not in _joins(resolve_sk(facts, dim, "ia_id", "ia_sk"))
    assert resolve_sk(facts, dim, "ia_id", "ia_sk").agg(F.sum("ia_sk")).first()[0] == 21 * sum(range(1_000_000))


def test_code_tables_are_still_broadcast(ten_mb):
    codes = stored(ten_mb.range(17).select(F.concat(F.lit("C"), F.col("id")).alias("cd"), F.lit("x").alias("description")))
    rows = stored(ten_mb.range(200_000).select(F.concat(F.lit("C"), F.col("id") % 20).alias("cd"), F.rand(1).alias("amt")))
    assert "BroadcastHashJoin" in _joins(rows.join(codes, "cd", "left"))


def test_measured_sides_keep_a_quarter_of_the_threshold(ten_mb):
    """In the driver a relation takes up to four times its rows."""
    measured_broadcasts(ten_mb)
    measured_broadcasts(ten_mb)
    assert _bytes(ten_mb.conf.get(BROADCAST)) == ESTIMATED_BROADCAST
    assert _bytes(ten_mb.conf.get(MEASURED_BROADCAST)) == 10 << 18
    ten_mb.conf.set(BROADCAST, "10m")
    ten_mb.conf.set(MEASURED_BROADCAST, "20m")
    measured_broadcasts(ten_mb)
    assert ten_mb.conf.get(MEASURED_BROADCAST) == "20m"


def test_a_lower_threshold_is_left_alone(ten_mb):
    for low in ("-1", "100k"):
        ten_mb.conf.set(BROADCAST, low)
        measured_broadcasts(ten_mb)
        assert ten_mb.conf.get(BROADCAST) == low and ten_mb.conf.get(MEASURED_BROADCAST, None) is None


def test_sizes():
    assert [_bytes(x) for x in ("256k", "10MB", "10485760b", "1g", "-1", "0", "2097152")] == [
        256 << 10, 10 << 20, 10 << 20, 1 << 30, -1, 0, 2097152]


def test_every_warehouse_query_measures_its_broadcasts(ten_mb):
    """The returned frame is planned by the caller: its session must hold the bound by then (F1)."""
    from __spark_entry__ import queries
    queries()["q_dp1_dim_agency"](ten_mb, "/root/testdata/sf0.001")
    assert _bytes(ten_mb.conf.get(BROADCAST)) == ESTIMATED_BROADCAST
