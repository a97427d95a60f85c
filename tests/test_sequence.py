"""Ordinal numbering, surrogate keys, LAG and exact percentiles under skew:
one group holds a third of all rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gildhall.operators import assign_sk, delta, exact_percentile, keep_one, latest_flag, ordinal


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rnd.randint(1, 40)           # group 0 holds a third of the rows
        rows.append((g if i != 5 else None, i, rnd.randint(0, 500) + rnd.random()))
    return spark.createDataFrame(rows, "g int, id long, v double")


def test_ordinal_matches_row_number_under_skew(spark):
    df = _skewed(spark)
    got = ordinal(df, ["g"], [F.col("v"), F.col("id")], name="rn", partitions=12)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    a = sorted((r.id, r.rn) for r in got.select("id", "rn").collect())
    b = sorted((r.id, r.rn) for r in exp.select("id", "rn").collect())
    assert a == b


def test_ordinal_splits_the_hot_group(spark):
    df = _skewed(spark)
    staged = df.repartitionByRange(12, F.col("g").asc_nulls_first(), "v", "id") \
        .withColumn("pid", F.spark_partition_id())
    parts_of_hot = staged.filter(F.col("g") == 0).select("pid").distinct().count()
    assert parts_of_hot >= 3          # the hot group is spread over several tasks


def test_assign_sk_dense_unique_repeatable(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "a", "d", "c", None]], "nk string")
    a = assign_sk(df, ["nk"], start=11, partitions=3)
    rows = sorted((r.nk or "", r.sk) for r in a.collect())
    assert [s for _, s in rows] == [11, 12, 13, 14, 15]
    b = assign_sk(df, ["nk"], start=11, partitions=2)
    assert rows == sorted((r.nk or "", r.sk) for r in b.collect())


def test_delta_equals_lag(spark):
    df = _skewed(spark, n=900)
    got = delta(df, ["g"], [F.col("v"), F.col("id")], {"v": "dv"})
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = df.withColumn("dv", F.col("v") - F.lag("v").over(w))
    a = {r.id: r.dv for r in got.collect()}
    b = {r.id: r.dv for r in exp.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9


def test_exact_percentile_equals_builtin(spark):
    df = _skewed(spark, n=1500)
    got = exact_percentile(df, ["g"], "v", {"p50": 0.5, "p90": 0.9, "p0": 0.0, "p100": 1.0})
    exp = df.groupBy("g").agg(F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.9).alias("p90"),
                              F.min("v").alias("p0"), F.max("v").alias("p100"))
    a = {r.g: (r.p50, r.p90, r.p0, r.p100) for r in got.collect()}
    b = {r.g: (r.p50, r.p90, r.p0, r.p100) for r in exp.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert abs(x - y) < 1e-6


def test_keep_one_ties_are_broken_by_order(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 5), (1, "2024-01-01", 9), (2, "2023-01-01", 1)],
                               "k int, ts string, id int")
    out = {r.k: r.id for r in keep_one(df, ["k"], [F.col("ts").desc(), F.col("id").desc()]).collect()}
    assert out == {1: 9, 2: 1}


def test_keep_one_plans_partial_group_limit(spark):
    df = _skewed(spark, n=300)
    plan = keep_one(df, ["g"], [F.col("v"), F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_flag(spark):
    df = spark.createDataFrame([(1, 3), (1, 5), (1, 5), (None, 2)], "k int, d int")
    out = sorted((r.k if r.k is not None else -1, r.d, r.is_latest) for r in latest_flag(df, ["k"], "d").collect())
    assert out == [(-1, 2, True), (1, 3, False), (1, 5, True), (1, 5, True)]


def test_quantile_sketches_merge_within_their_rank_error(spark):
    """A third of the rows in one group; sketches of ten parts merged: ranks off by less than 0.6 %, exact stays the default."""
    from gildhall.operators import merged_sketches, quantile_sketches, sketch_percentiles
    df = spark.range(300_000).selectExpr("IF(id % 3 = 0, 'hot', concat('g', id % 7)) AS g", "CAST(pow(rand(3) * 100, 3) AS DOUBLE) AS v",
                                         "id % 10 AS part").checkpoint()
    parts = quantile_sketches(df, ["part", "g"], "v")
    got = sketch_percentiles(merged_sketches(parts, ["g"]), ["g"], {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    j = df.join(got.drop("n"), "g").groupBy("g").agg(*[F.avg((F.col("v") <= F.col(c)).cast("int")).alias(c) for c in ("p50", "p90", "p99")])
    worst = max(max(abs(r.p50 - 0.5), abs(r.p90 - 0.9), abs(r.p99 - 0.99)) for r in j.collect())
    assert 0 < worst < 0.006
    assert sorted(r.n for r in merged_sketches(parts, ["g"]).collect()) == sorted(r["count"] for r in df.groupBy("g").count().collect())
    nulls = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None)], "g string, v double")
    assert [(r.g, r.n, r.p) for r in sketch_percentiles(quantile_sketches(nulls, ["g"], "v"), ["g"], {"p": 0.5}).collect()] == [("b", 1, 1.0)]


def test_numbered_rows_are_stored_once_and_compressed(spark):
    """The numbered rows are Parquet files read back with no join, their shuffle files gone (F1-F14: disk)."""
    df = spark.range(5000).selectExpr("id * 7 % 5000 AS k", "repeat(cast(id % 3 AS string), 40) AS wide")
    got = assign_sk(df, ["k"], start=11, name="sk", partitions=6)
    assert got.inputFiles() and all(f.endswith(".parquet") for f in got.inputFiles())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "LogicalRDD" not in plan
    assert got.selectExpr("count(*) AS n", "min(sk) AS lo", "max(sk) AS hi", "count_if(sk <> k + 11) AS bad").first() == (5000, 11, 5010, 0)
    assert got.select("k").inputFiles() == got.inputFiles()
    assert assign_sk(df.filter("k < 0"), ["k"]).count() == 0
    assert [r.sk for r in assign_sk(df.filter("k = 3"), ["k"], partitions=6).collect()] == [1]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_code_tables_are_stored_so_that_their_size_is_known(spark):
    """A lookup of a few codes is planned by its size, not dealt with the rows by code."""
    from gildhall.plans.dp1_silver import _code_table
    codes = _code_table(spark.range(100).selectExpr("concat('C', id % 3) AS c"), "c")
    assert codes.inputFiles() and sorted(r.cd for r in codes.collect()) == ["C0", "C1", "C2"]


def test_delta_moves_the_rows_once(spark):
    """a hot group over many partitions, NULL groups and NULL values as LAG has them, with one small join."""
    from pyspark.sql import Window
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
                                  F.when(F.col("id") % 11 != 0, F.col("id") * 7 % 101).alias("v"), F.date_add(F.to_date(F.lit("2020-01-01")), (F.col("id") % 17).cast("int")).alias("d"))
    got = delta(df, ["g"], [F.col("id")], {"v": "dv"}, {"d": "dd"})
    w = Window.partitionBy("g").orderBy("id")
    want = df.withColumns({"dv": F.col("v") - F.lag("v").over(w), "dd": F.datediff("d", F.lag("d").over(w))})
    assert sorted(map(tuple, got.select("id", "dv", "dd").collect())) == sorted(map(tuple, want.select("id", "dv", "dd").collect()), key=lambda r: r[0])
    assert got.columns == want.columns
    assert got._jdf.queryExecution().analyzed().toString().count("Join ") == 1


def test_assign_sk_by_quantiles_of_a_cheaper_frame(spark):
    """dealt by quantiles of other keys (skewed, too few, none, NULLs), the numbers are the same and the frame runs once."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    df = spark.range(4000).selectExpr("CASE WHEN id % 400 = 399 THEN NULL WHEN id < 20 THEN -id * 1000000000000000 ELSE id * 7 % 4000 END AS k",
                                      "id").mapInArrow(count, "k long, id long")
    want = {r.id: r.sk for r in assign_sk(df, ["k"], start=5, partitions=6).select("sk", "id").collect()}
    keys = {r.id: r.k for r in df.collect()}
    for cheap in (spark.range(4000), spark.range(3), spark.range(0), spark.range(500).selectExpr("id * id * id AS id")):
        runs.value = 0
        got = assign_sk(df, ["k"], start=5, partitions=6, keys=cheap.withColumnRenamed("id", "k"))
        assert runs.value == (4000 if cheap.count() else 8000)
        rows = got.select("sk", "id", "k").orderBy("sk").collect()
        assert [r.sk for r in rows] == list(range(5, 4005))
        assert [keys[r.id] for r in rows] == sorted(keys.values(), key=lambda k: (k is not None, k or 0))
        assert sorted(want.values()) == [r.sk for r in rows] and got.columns == ["k", "id", "sk"]
    spread = assign_sk(df, ["k"], partitions=6, keys=spark.range(4000).withColumnRenamed("id", "k"))
    assert len(spread.inputFiles()) == 6
