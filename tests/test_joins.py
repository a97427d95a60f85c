import datetime as dt

import pytest
from pyspark.sql import functions as F

from gildhall.operators import (
    const_lookup, decode, first_hit, net_new, period_contains, pick_one, poly_ref, preagg_join, resolve_sk,
)
from gildhall.operators.joins import like_literal


def test_resolve_sk_cases(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d")], "nk int, tag string")
    dim = spark.createDataFrame([(1, 100, True), (2, 200, True), (2, 201, False)], "nk int, sk long, is_current_flag boolean")
    out = {r.tag: r.sk for r in resolve_sk(df, dim, "nk", "sk").collect()}
    assert out == {"a": 100, "b": 200, "c": -1, "d": -1}
    na = {r.tag: r.sk for r in resolve_sk(df, dim, "nk", "sk", null_key_missing=-2).collect()}
    assert na["c"] == -2 and na["d"] == -1


def test_resolve_sk_rejects_two_current_rows(spark):
    df = spark.createDataFrame([(1,)], "nk int")
    dim = spark.createDataFrame([(1, 100, True), (1, 101, True)], "nk int, sk long, is_current_flag boolean")
    with pytest.raises(Exception, match="key not unique"):
        resolve_sk(df, dim, "nk", "sk").collect()


def test_decode_keeps_unknown_code(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "cd string")
    lk = spark.createDataFrame([("A", "Alpha")], "cd string, description string")
    assert [r.description for r in decode(df, lk, "cd", "description").orderBy("cd").collect()] == [None, "Alpha", "Z"]


def test_preagg_join_keeps_left_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, 5), (1, 7), (2, 1)], "k int, v int")
    out = {r.k: r.total for r in preagg_join(left, right, "k", [F.sum("v").alias("total")], fill={"total": 0}).collect()}
    assert out == {1: 12, 2: 1, 3: 0}


def test_pick_one_min(spark):
    b = spark.createDataFrame([(1, 30), (1, 10), (2, 5)], "award int, ia int")
    assert {r.award: r.ia for r in pick_one(b, "award", "ia").collect()} == {1: 10, 2: 5}


def test_period_contains_edges(spark):
    d = dt.date
    items = spark.createDataFrame([(1, "equal", d(2024, 1, 1), d(2024, 1, 31)), (1, "inside", d(2024, 1, 5), d(2024, 1, 6)),
                                   (1, "straddle", d(2024, 1, 20), d(2024, 2, 5))], "k int, name string, s date, e date")
    periods = spark.createDataFrame([(1, d(2024, 1, 1), d(2024, 1, 31))], "k int, ps date, pe date")
    got = sorted(r.name for r in period_contains(items, periods, "k", "s", "e", "ps", "pe").collect())
    assert got == ["equal", "inside"]


def _period_rows(seed, n_items, n_periods):
    import random
    rng = random.Random(seed)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(-400, 800))
    def span(longest):
        a = day()
        return a, a + dt.timedelta(days=rng.choice([0, 1, rng.randrange(longest), rng.randrange(longest)]))
    items = [(rng.choice([1, 1, 2, None]), i, *span(40)) for i in range(n_items)]
    periods = [(rng.choice([1, 1, 2, None]), i, *span(90)) for i in range(n_periods)]
    periods += [(1, n_periods, dt.date(1900, 1, 1), dt.date(9999, 12, 31)), (1, n_periods + 1, None, dt.date(2021, 1, 1)),
                (1, n_periods + 2, dt.date(2021, 1, 9), dt.date(2021, 1, 2)), (2, n_periods + 3, dt.date(2020, 5, 5), dt.date(2020, 5, 5))]
    items += [(1, n_items, dt.date(2020, 5, 9), dt.date(2020, 5, 1)), (1, n_items + 1, None, dt.date(2020, 1, 1)),
              (1, n_items + 2, dt.date(2020, 1, 1), None), (2, 0, dt.date(2020, 5, 5), dt.date(2020, 5, 5))]
    return items, periods


@pytest.mark.parametrize("how", ["inner", "left"])
def test_period_contains_is_the_plain_predicate(spark, how):
    """All pairs, with endless, inverted and NULL periods and items that end before they start."""
    items, periods = _period_rows(3, 300, 200)
    want = []
    for ik, i, s, e in items:
        hit = [(ik, i, s, e, p, ps, pe) for k, p, ps, pe in periods
               if None not in (ik, k, s, e, ps, pe) and ik == k and ps <= s and e <= pe]
        want += hit or ([(ik, i, s, e, None, None, None)] if how == "left" else [])
    got = period_contains(spark.createDataFrame(items, "k int, i int, s date, e date"),
                          spark.createDataFrame(periods, "k int, p int, ps date, pe date"), "k", "s", "e", "ps", "pe", how)
    assert got.columns == ["k", "i", "s", "e", "p", "ps", "pe"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want)) and len(want) > 400


def test_period_contains_spreads_a_hot_key(spark):
    """One key with 10,000 monthly periods and a third of the items: no (key, bin) holds more than a few periods."""
    periods = spark.range(10_000).selectExpr("1 AS k", "id AS p", "date_add(DATE'1300-01-01', CAST(id * 30 AS INT)) AS ps",
                                             "date_add(DATE'1300-01-01', CAST(id * 30 + 29 AS INT)) AS pe")
    items = spark.range(30_000).selectExpr("IF(id % 3 = 0, 1, CAST(id AS INT)) AS k", "id AS i",
                                           "date_add(DATE'1300-01-01', CAST(id * 10 AS INT)) AS s",
                                           "date_add(DATE'1300-01-01', CAST(id * 10 AS INT)) AS e")
    got = period_contains(items, periods, "k", "s", "e", "ps", "pe")
    assert got.count() == 10_001 and got.filter("p <> floor(i / 3)").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_pc_bin#" in plan


def test_poly_ref_escapes_underscore(spark):
    ev = spark.createDataFrame([(1, "AWARD"), (2, "FOO_IA"), (3, "IA"), (4, "MEDIA"), (5, None)], "id long, code string")
    ia = spark.createDataFrame([(i, i * 10) for i in range(1, 6)], "ia_id long, ia_sk long")
    match = F.upper(F.col("code")).like("%" + like_literal("_IA")) | (F.col("code") == "IA")
    out = {r.id: r.ia_sk for r in poly_ref(ev, "code", "id", {"ia_sk": (match, ia, "ia_id", "ia_sk")}).collect()}
    assert out == {1: None, 2: 20, 3: 30, 4: None, 5: None}       # MEDIA no longer resolves (D-28)


def test_const_lookup_scalar_and_guard(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    dim = spark.createDataFrame([("COLLABORATION", 7), ("OTHER", 8)], "code string, sk int")
    out = const_lookup(df, dim, F.col("code") == "COLLABORATION", ["sk"])
    assert [r.sk for r in out.collect()] == [7, 7]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    dup = dim.unionByName(dim)
    with pytest.raises(Exception, match="more than one row"):
        const_lookup(df, dup, F.col("code") == "COLLABORATION", ["sk"]).collect()


def test_first_hit(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "a int, b int")
    p1 = spark.createDataFrame([(1, "x")], "a int, name string")
    p2 = spark.createDataFrame([(10, "y"), (20, "z")], "b int, name string")
    out = {r.a: r.hit for r in first_hit(df, [(p1, {"a": "a"}, "name"), (p2, {"b": "b"}, "name")], "hit").collect()}
    assert out == {1: "x", 2: "z", 3: None}


def test_net_new(spark):
    inc = spark.createDataFrame([(1,), (5,)], "k int")
    ex = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r.k for r in net_new(inc, ex, "k").collect()] == [5]
