import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gildhall.llm import ann as N
from gildhall.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def plain(ids, x, query, k=20):
    score = x @ x[list(ids).index(query)]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:k]
    return [ids[i] for i in order], score[order]


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    found = {}
    for r in QUERIES["op8_ann"](spark, SF).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == sorted(i for i in ids if i % 20 == 0)
    hit = total = 0
    place = {v: i for i, v in enumerate(ids)}
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in itertools.pairwise(got))
        assert np.allclose([g[2] for g in got], [x[place[q]] @ x[place[g[1]]] for g in got], rtol=0, atol=1e-12)
        want = plain(ids, x, q)[0]
        hit, total = hit + len({g[1] for g in got} & set(want)), total + len(want)
    assert hit / total >= 0.9


def test_narrow_windows_on_clustered_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    x = np.repeat(centres, 50, axis=0) + 0.05 * rng.normal(size=(2000, 16))
    x *= rng.uniform(0.98, 1.02, size=(2000, 1))
    monkeypatch.setattr(N, "BLOCK", 64)
    monkeypatch.setattr(N, "WINDOW_ROWS", 64)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in N.nearest(table, F.col("vec_id") % 20 == 0, share=0.08).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(got[q] & set(plain(np.arange(2000), x, q)[0])) / 20 for q in got]
    assert len(hits) == 100 and np.mean(hits) >= 0.9


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (20, [0.0, 2.0], "x"), (3, [0.0, 0.0], "x"), (4, None, "x"), (5, [1.0, None], "x"),
            (6, [float("nan"), 1.0], "x"), (40, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x"), (7, [], "x"), (8, [1.0, 2.0, 3.0], "x"), (1, [1.0, 0.0], "x"), (60, [-1.0, 0.5], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.nearest(table, F.col("vec_id") % 20 == 0).collect())
    ids, x = np.array([0, 1, 2, 20, 60]), np.array([[1, 0], [1, 0], [1, 0], [0, 2], [-1, 0.5]])
    expected = []
    for q in (0, 20, 60):
        near, score = plain(ids, x, q)
        expected += [(q, i + 1, int(v), float(s)) for i, (v, s) in enumerate(zip(near, score, strict=True))]
    assert got == sorted(expected)
    assert N.nearest(table.where("vec_id = 3"), F.lit(True)).collect() == []
    assert N.nearest(table.limit(0), F.lit(True)).collect() == []
    assert N.nearest(table.where("vec_id = 20"), F.lit(True)).collect() == []


def test_hilbert_steps_are_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = N.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_copies_of_one_vector(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 8))
    x[rng.permutation(1500)[:500]] = x[0]
    x[:, 0] = np.where(np.arange(1500) % 2, 0.0, -0.0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    group = np.flatnonzero((x == x[0]).all(axis=1))
    monkeypatch.setattr(N, "BLOCK", 64)
    monkeypatch.setattr(N, "WINDOW_ROWS", 64)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in N.nearest(table, F.col("vec_id") % 10 == 0, share=0.08).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(got) == list(range(0, 1500, 10))
    inside = [q for q in got if q in set(group.tolist())]
    assert len(inside) > 30
    for q in inside:
        assert [v for _, v in sorted(got[q])] == [i for i in group.tolist() if i != q][:20]


def test_a_block_is_scored_in_slices():
    """However many queries meet a block, they are answered as they come, in bounded parts."""
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(100, 4)), rng.normal(size=(5000, 4))
    rows = [(0, 7, 0, i, v.tobytes(), np.array([i]).tobytes()) for i, v in enumerate(x)] + [(0, 7, 1, 1000 + i, v.tobytes(), None) for i, v in enumerate(q)]
    names, read = ("curve", "block", "ask", "rep", "v", "ids"), []

    def batches():
        for at in range(0, len(rows), 500):
            read.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at:at + 500], strict=True)], names)

    found, sizes, early = {}, [], 0
    for b in N._rerank(batches(), 5):
        sizes.append(b.num_rows)
        early += len(read) < len(rows) / 500
        found.update(zip(b.column("rep").to_pylist(), b.column("ids").to_pylist(), strict=True))
    assert sum(sizes) == len(found) == 5000 and max(sizes) <= 1024 and early
    for i in range(0, 5000, 97):
        assert np.frombuffer(found[1000 + i], dtype=np.int64).tolist() == np.argsort(-(x @ q[i]), kind="stable")[:5].tolist()
