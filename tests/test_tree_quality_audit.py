import datetime as dt

from pyspark.sql import functions as F

from gildhall.operators import avg_of_counts, gate, id_list, org_checks, org_paths, profile, run_outcome, run_state
from gildhall.operators import quality as Q


def _org(spark):
    return spark.createDataFrame([
        ("A", None, "Agency"), ("B", "A", "Bureau"), ("C", "B", "Office"),   # root, two levels
        ("O", "missing", "Orphan"),                                         # parent not a node → own root
        ("S", "S", "Self"),                                                 # self-loop
        ("X", "Y", "X"), ("Y", "X", "Y"),                                   # 2-cycle
    ], "node_id string, parent_id string, node_name string")


def test_org_paths_and_checks(spark):
    nodes = _org(spark)
    p = {r.node_id: (r.level, r.path, r.root_id) for r in org_paths(nodes).collect()}
    assert p == {"A": (1, "Agency", "A"), "B": (2, "Agency / Bureau", "A"), "C": (3, "Agency / Bureau / Office", "A"),
                 "O": (1, "Orphan", "O")}
    issues = sorted((r.node_id, r.issue) for r in org_checks(nodes, org_paths(nodes), warn_depth=2).collect())
    assert issues == [("C", "deep"), ("S", "self_reference"), ("S", "unreached"), ("X", "unreached"), ("Y", "unreached")]


def test_deep_chains_and_long_cycles(spark):
    """A chain of 5,000 levels and cycles of 1 to 300 nodes with tails: depths right, only cycles unreached."""
    rows = [(f"c{i}", f"c{i - 1}" if i else None, "n") for i in range(5000)]
    for size in (1, 2, 7, 300):
        rows += [(f"y{size}_{i}", f"y{size}_{(i + 1) % size}", "n") for i in range(size)]
        rows += [(f"t{size}_{i}", f"t{size}_{i - 1}" if i else f"y{size}_0", "n") for i in range(50)]
    nodes = spark.createDataFrame(rows, "node_id string, parent_id string, node_name string")
    paths = org_paths(nodes, sep="")
    got = {r.node_id: (r.level, len(r.path), r.root_id) for r in paths.collect()}
    assert got == {f"c{i}": (i + 1, i + 1, "c0") for i in range(5000)}
    issues = org_checks(nodes, paths, warn_depth=4990).collect()
    assert sum(r.issue == "deep" for r in issues) == 10
    assert {r.node_id for r in issues if r.issue == "unreached"} == {r[0] for r in rows if r[0][0] in "yt"}
    assert [r.node_id for r in issues if r.issue == "self_reference"] == ["y1_0"]


def test_rounds_follow_the_logarithm_of_the_depth(spark):
    from gildhall.operators.tree import _doubled
    state = spark.createDataFrame([(i, i - 1 if i else None, 1, None, None if i else 0) for i in range(300)],
                                  "node_id int, _anc int, level int, path string, root_id int")
    joins = []
    arrived, going = _doubled(state, lambda above, own: joins.append(1) or F.lit(None).cast("string"))
    assert len(joins) == 9 and going.count() == 0    # 2 ** 9 > 300
    assert {r.node_id: r.level for r in arrived.collect()} == {i: i + 1 for i in range(300)}


def test_null_node_ids_are_roots_of_nothing(spark):
    nodes = spark.createDataFrame([(None, None, "x"), ("a", None, "A"), ("b", "a", "B")], "node_id string, parent_id string, node_name string")
    assert sorted((r.node_id or "", r.path) for r in org_paths(nodes).collect()) == [("", "x"), ("a", "A"), ("b", "A / B")]
    empty = nodes.limit(0)
    assert org_paths(empty).collect() == [] and org_checks(empty, org_paths(empty)).collect() == []


def test_profile_is_one_pass(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, None), (3, None, None)], "id int, f boolean, g string")
    prof = profile(df, {"rows": (F.count(F.lit(1)), Q.eq(3)), "true": (Q.true_count("f"), None),
                        "null": (Q.null_count("f"), Q.eq(0)), "gap_not_null": (Q.not_null_count("g"), Q.eq(0))})
    got = {r.check: (int(r.value), r.ok) for r in prof.collect()}
    assert got == {"rows": (3, True), "true": (1, None), "null": (1, False), "gap_not_null": (0, True)}
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Scan") == 1   # every check from one scan


def test_sentinel_report_and_parity(spark):
    df = spark.createDataFrame([(-1, None), (-1, 5), (3, 5)], "sk int, nk int")
    r = Q.sentinel_report(df, ["sk"], {"sk": F.col("nk").isNull()}).first()
    assert (r.expected_sentinels, r.unexpected_sentinels) == (1, 1)
    p = Q.row_parity(df, df.limit(2)).first()
    assert (p.source_rows, p.target_rows, p.ok) == (3, 2, False)


def test_expected_codes_and_preflight(spark):
    df = spark.createDataFrame([("A",), ("B",)], "c string")
    assert [r.c for r in Q.expected_codes(df, "c", ["A", "B", "C"]).collect()] == ["C"]
    pf = {r.input_name: r.has_rows for r in Q.preflight({"df": df, "empty": df.filter("false")}).collect()}
    assert pf == {"df": True, "empty": False}


def test_run_state_terminal_beats_running_at_same_instant(spark):
    t = dt.datetime(2024, 1, 1, 10)
    audit = spark.createDataFrame([("r1", "t0", "RUNNING", t), ("r1", "t0", "SUCCESS", t),
                                   ("r1", "t1", "RUNNING", t), ("r1", "t1", "FAILED", t + dt.timedelta(minutes=5))],
                                  "run_id string, target_table string, run_status string, event_ts timestamp_ntz")
    st = {r.target_table: r.run_status for r in run_state(audit).collect()}
    assert st == {"t0": "SUCCESS", "t1": "FAILED"}
    out = run_outcome(run_state(audit), critical=["t1"]).first()
    assert out.outcome == "FAILURE"
    assert run_outcome(run_state(audit), critical=["t0"]).first().outcome == "WARNING"


def test_gate(spark):
    states = spark.createDataFrame([("r1", "a", "SUCCESS"), ("r1", "b", "FAILED"), ("r2", "a", "SUCCESS"),
                                    ("r2", "b", "SUCCESS")], "run_id string, target_table string, run_status string")
    deps = spark.createDataFrame([("fact", "a", True), ("fact", "b", True), ("fact", "c", False)],
                                 "step string, upstream string, is_critical boolean")
    got = {r.run_id: r.may_run for r in gate(states, deps).collect()}
    assert got == {"r1": False, "r2": True}


def test_id_list_and_avg_of_counts(spark):
    df = spark.createDataFrame([(1, 30), (1, 10), (1, 10), (2, 5)], "k int, id int")
    assert {r.k: r.ids for r in id_list(df, ["k"], "id", out="ids").collect()} == {1: "10,30", 2: "5"}
    a = avg_of_counts(spark.createDataFrame([("n", 1), ("n", 1), ("n", 2)], "p string, e int"), ["e"], ["p"]).first()
    assert float(a.avg_count) == 1.5 and a.n_entities == 2


def test_quality_suite_is_one_scan_and_tells_keys_apart(spark, tmpdir_run):
    rows = [("a", "b|c", 1, -1), ("a|b", "c", 1, -1), (None, "x", 2, 5), (None, "x", 2, -1), ("n", "x", 2, None), ("", None, 3, 7)]
    spark.createDataFrame(rows, "p string, q string, v int, sk int").write.parquet(f"{tmpdir_run}/t")
    df = spark.read.parquet(f"{tmpdir_run}/t")
    suite = Q.quality_suite(df, unique={"pq": ["p", "q"], "q": ["q"]}, sentinels={"sk": F.col("p").isNull()}, distributions={"v": 2, "q": 1})
    got = sorted(((r.check, r.item, r.n) for r in suite.collect()), key=str)
    assert got == [("sentinel:sk", "expected", 1), ("sentinel:sk", "unexpected", 2), ("unique:pq", None, 1), ("unique:q", None, 1),
                   ("values:q", "x", 3), ("values:v", "1", 2), ("values:v", "2", 3)]
    plan = suite._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Aggregate [") == 2
    assert Q.quality_suite(df.limit(0), unique={"pq": ["p", "q"]}).collect() == []


def test_write_observed_counts_what_is_written_without_a_second_scan(spark, tmpdir_run):
    from gildhall.plans.domain.load import load_target
    from gildhall.sources import write_observed
    scans = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b
    df = spark.range(1000).selectExpr("id", "IF(id % 10 = 0, -1, id) AS sk", "CAST(id AS DECIMAL(15,2)) AS amt").mapInArrow(touch, "id long, sk long, amt decimal(15,2)")
    checks = {"total": F.sum("amt"), "sentinels": F.count_if(F.col("sk") == -1)}
    status, seen = write_observed(df, f"{tmpdir_run}/t", {"rows": F.count(F.lit(1)), **checks})
    assert (status, seen["rows"], int(seen["total"]), seen["sentinels"]) == ("SUCCESS", 1000, 499500, 100)
    assert scans.value == 1000
    load_target(df, "t", f"{tmpdir_run}/t2", f"{tmpdir_run}/audit", "r1", "2024-01-01T00:00:00", metrics=checks)
    assert scans.value == 2000
    done = run_state(spark.read.parquet(f"{tmpdir_run}/audit")).first()
    assert done.rows_written == 1000 and '"sentinels": 100' in done.message
    # a skipped load has nothing to observe, and does not wait for it
    for n, status in ((1000, "SUCCESS"), (0, "SKIPPED")):
        load_target(df, "s", f"{tmpdir_run}/s", f"{tmpdir_run}/audit2_{status}", "r", "2024-01-01T00:00:00", mode="insert_only")
        r = run_state(spark.read.parquet(f"{tmpdir_run}/audit2_{status}")).first()
        assert (r.run_status, r.rows_written) == (status, n)
