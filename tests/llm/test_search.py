import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import ann, topk
from lodestar.llm.vectors import runs

SCHEMA = "vec_id long, embedding array<float>"
NAN, INF = float("nan"), float("inf")
BAD = [(9000, None), (9020, [1.0, None]), (9040, [NAN, 1.0]), (9060, [INF, 1.0]), (None, [1.0, 1.0])]


def table(spark, vectors, ids=None, more=()):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows + list(more), SCHEMA).repartition(3).withColumn("row", F.lit(1)).withColumn("near", F.lit(0)).withColumn("w", F.lit("x"))


def brute_top(vectors, ids, queries, k, score):
    out = []
    for q in queries:
        best = sorted(((-score(vectors[q], v), i, j) for j, (i, v) in enumerate(zip(ids, vectors)) if j != q))[:k]
        out += [(ids[q], n + 1, i, -s) for n, (s, i, _) in enumerate(best)]
    return sorted(out)


def floor_product(a, b):
    f = lambda v: [int(np.floor(256 * float(np.float32(x)))) for x in v]
    return sum(x * y for x, y in zip(f(a), f(b)))


@pytest.mark.parametrize("kind", ["random", "equal", "ties", "large"])
def test_exact_top_k(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "BLOCKS", 3)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "SUMMARIES", 7)
    rng = np.random.default_rng(7)
    n = 400
    v = {"random": rng.normal(size=(n, 8)), "equal": np.ones((n, 8)), "ties": rng.integers(-1, 2, (n, 8)).astype(float), "large": rng.normal(size=(n, 8)) * 1e6}[kind]
    ids = rng.permutation(n * 3)[:n].tolist()
    got = sorted(map(tuple, topk.exact_top_k(table(spark, v, ids, BAD), F.col("vec_id") % 10 == 0, k=5).collect()))
    queries = [j for j, i in enumerate(ids) if i % 10 == 0]
    assert got == brute_top(v, ids, queries, 5, floor_product)


def test_exact_top_k_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.exact_top_k(empty, F.col("vec_id") % 10 == 0).collect() == []
    assert topk.exact_top_k(spark.createDataFrame(BAD, SCHEMA), F.lit(True)).collect() == []
    assert topk.exact_top_k(table(spark, [[1, 2]], [10]), F.col("vec_id") % 10 == 0).collect() == []
    three = topk.exact_top_k(table(spark, [[1, 2], [3], [0, 1], [2, 2]], [10, 11, 12, 12]), F.col("vec_id") % 10 == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in three) == [(1, 12, 393216), (2, 11, 196608), (3, 12, 131072)]  # [3] counts as [3, 0]; 12 repeats
    twice = topk.exact_top_k(table(spark, [[1.0], [1.0]], [10, 10]), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, twice)) == [(10, 1, 10, 65536)] * 2  # repeated rows are rows of their own


def test_exact_top_k_scores_few_rows_of_clustered_vectors(spark):
    """Bounds prune: of rows around 60 centres a query scores less than 15 %; every answer is exact all the same."""
    rng = np.random.default_rng(11)
    n, d = 20000, 16
    centres = rng.normal(size=(60, d))
    v = centres[rng.integers(0, 60, n)] + 0.05 * rng.normal(size=(n, d))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    got = topk.exact_top_k(table(spark, v), F.col("vec_id") % 50 == 0, work=True).collect()
    w = np.floor(256 * v.astype(float)).astype(np.int64)
    scored, best = {}, {}
    for r in got:
        scored[r.query_id] = r.scored
        best.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(best) == list(range(0, n, 50))
    for q, rows in best.items():
        s = w @ w[q]
        s[q] = -(1 << 40)
        order = np.lexsort((np.arange(n), -s))[:5]
        assert sorted(rows) == [(i + 1, int(j), int(s[j])) for i, j in enumerate(order)]
    assert np.mean(list(scored.values())) / n < 0.15


def test_exact_top_k_of_many_copies(spark, monkeypatch):
    """Of a third of equal rows a query scores the blocks with the smallest ids only."""
    monkeypatch.setattr(topk, "QUERIES", 64)
    rng = np.random.default_rng(12)
    v = rng.normal(size=(6000, 8))
    v[::3] = v[0] * 2
    got = topk.exact_top_k(table(spark, v), F.col("vec_id") % 150 == 0, work=True).collect()
    for r in got:
        assert r.vec_id == 3 * (r["rank"] - (r.query_id >= 3 * r["rank"])) and r.scored < 3000


def test_runs_are_never_cut():
    batches = [pa.RecordBatch.from_pydict({"k": k, "v": k}) for k in ([1, 1, 2], [2, 2], [2], [], [2, 3], [4, 5], [5])]
    got = [t["k"].to_pylist() for t in runs(iter(batches), "k")]
    assert sum(got, []) == [1, 1, 2, 2, 2, 2, 2, 3, 4, 5, 5]
    for a, b in zip(got, got[1:]):
        assert a[-1] != b[0]


@pytest.mark.parametrize("kind", ["random", "clusters", "copies"])
def test_ann_recall(spark, kind, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 1500)
    rng = np.random.default_rng(3)
    n, d = 2500, 24
    v = rng.normal(size=(n, d))
    if kind == "clusters":
        v = rng.normal(size=(10, d))[rng.integers(0, 10, n)] * 2 + v * 0.3
    if kind == "copies":
        v[:900] = v[0]
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    got = ann.nearest_neighbours(table(spark, v, None, [*BAD, (9080, [0.0] * d)]), F.col("vec_id") % 20 == 0, k=20).collect()
    s = v.astype(float) @ v.astype(float).T
    np.fill_diagonal(s, -9)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert sorted(found) == list(range(0, n, 20))
    hits = 0
    for q, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and len({r.vec_id for r in rows}) == 20
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        for r in rows:
            assert r.score == pytest.approx(s[q, r.vec_id], abs=1e-12) and r.vec_id != q
        least = np.sort(s[q])[-20]
        hits += sum(r.score >= least - 1e-12 for r in rows)
    assert hits / (20 * len(found)) >= 0.9


def test_ann_small_tables(spark):
    assert ann.nearest_neighbours(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    assert ann.nearest_neighbours(spark.createDataFrame([*BAD, (1, [0.0, 0.0])], SCHEMA), F.lit(True)).collect() == []
    assert ann.nearest_neighbours(table(spark, [[1.0, 0]], [20]), F.col("vec_id") % 20 == 0).collect() == []
    few = ann.nearest_neighbours(table(spark, [[1.0, 0], [2.0, 0], [0, 1.0], [2.0, 0], [0, -1.0]], [20, 7, 5, 6, 5]), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in few) == [(1, 6, 2.0), (2, 7, 2.0), (3, 5, 0.0), (4, 5, 0.0)]


@pytest.mark.parametrize("shard", [1 << 14, 200])
def test_ann_copies_by_smallest_id(spark, monkeypatch, shard):
    """Of many equal vectors a query gets those with the smallest vec_ids, whatever was met first."""
    monkeypatch.setattr(ann, "SHARD", shard)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(1800, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    hot = rng.permutation(1800)[:1400]  # more copies than a list holds
    v[hot] = [0.0, *v[0, 1:]]
    v[hot[:300], 0] = -0.0  # equal all the same
    ids = rng.permutation(9000)[:1800]
    got = {}
    for r in ann.nearest_neighbours(table(spark, v, ids), F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    asked = [int(i) for i in ids[hot] if i % 20 == 0]
    assert len(asked) > 20
    for q in asked:
        assert sorted(got[q]) == [(n + 1, i) for n, i in enumerate(sorted(int(i) for i in ids[hot] if i != q)[:20])]


def test_ann_ranks_the_whole_list(spark):
    """More than 2 k rows equal in single precision: the best in double precision come first."""
    rng = np.random.default_rng(6)
    order = rng.permutation(60)
    rows = [(20, [1.0, 0.0])] + [(int(i) + 101, [1.0 + float(i) * 1e-12, float(j)]) for j, i in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(ann.nearest_neighbours(df, F.col("vec_id") == 20, k=5).collect(), key=lambda r: r["rank"])
    assert [r.vec_id for r in got] == [160, 159, 158, 157, 156]


@pytest.mark.parametrize("scale", [1e-9, 1e200])
def test_ann_does_not_depend_on_the_size_of_values(spark, scale):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(1000, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in r * scale]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=20).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert sorted(found) == list(range(0, 1000, 20)) and all(len(set(x)) == 20 for x in found.values())
    if 1e-150 < scale < 1e150:  # else all products are zero or infinite in double precision
        s = v @ v.T
        np.fill_diagonal(s, -9)
        best = np.argsort(-s, axis=1)[:, :20]
        assert sum(len(set(best[q]) & set(x)) for q, x in found.items()) / (20 * len(found)) >= 0.9
