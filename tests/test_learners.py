"""Models fitted by aggregations, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from lodestar.functions.hashing import with_hash_bucket
from lodestar.operators import features, learners
from lodestar.plans import QUERIES, models_q
from lodestar.sources.files import write_observed
from lodestar.sources.tables import load

from conftest import SMALL


def test_kmeans_is_the_same_on_every_layout(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(-5, 5) + 100 * (i % 3), rng.randint(-5, 5)) for i in range(300)] + [(7, 1, 1)] * 40
    df = spark.createDataFrame(rows, "id long, a long, b long")
    found = [learners.kmeans_centres(df.repartition(n), ["id"], ["a", "b"], k=3) for n in (1, 7, 40)]
    assert found[0] == found[1] == found[2] and len({tuple(c) for c in found[0]}) == 3
    assert sorted(round(c[0] / 100) for c in found[0]) == [0, 1, 2]
    assert learners.kmeans_centres(df.limit(0), ["id"], ["a", "b"]) == []
    same = spark.createDataFrame([(1, 4, 4)] * 5, "id long, a long, b long")
    assert learners.kmeans_centres(same, ["id"], ["a", "b"], k=2) == [[4, 4], [4, 4]]


def brute_tree(x, y, w, depth, bins, tree=0, m=None):
    """Splits by trying every feature and bin, compared as exact fractions."""
    d = x.shape[1]

    def score(rows):
        return sum(int(w[rows][y[rows] == c].sum()) ** 2 for c in set(y[rows])), int(w[rows].sum())

    def grow(rows, node, left):
        classes = sorted(set(y[rows]))
        heavy = max(classes, key=lambda c: (w[rows][y[rows] == c].sum(), -classes.index(c)))
        best = None
        some = range(d) if m is None else sorted(sorted(range(d), key=lambda f: hashlib.md5(f"{tree}-{node}-{f}".encode()).hexdigest())[:m])
        whole = score(rows)
        for f in some if left else []:
            for b in sorted(set(x[rows, f]))[:-1]:
                (a, na), (c, nc) = score(rows[x[rows, f] <= b]), score(rows[x[rows, f] > b])
                top = a * nc + c * na, na * nc
                if top[0] * whole[1] > whole[0] * top[1] and (best is None or top[0] * best[0][1] > best[0][0] * top[1]):
                    best = top, f, b
        if best is None:
            return lambda r: heavy
        _, f, b = best
        lo, hi = grow(rows[x[rows, f] <= b], 2 * node, left - 1), grow(rows[x[rows, f] > b], 2 * node + 1, left - 1)
        return lambda r: (lo if r[f] <= b else hi)(r)

    return grow(np.flatnonzero(w > 0), 1, depth)


def poisson(key, tree):
    u = int(hashlib.md5(f"{key}-{tree}".encode()).hexdigest()[:8], 16) / (1 << 32)
    return sum(u >= sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) for i in range(8))


@pytest.mark.parametrize("trees,sample", [(1, False), (4, True)])
def test_trees_against_brute_force(spark, trees, sample):
    rng = np.random.default_rng(5)
    n, d, bins, depth, m = 220, 6, 8, 3, (2 if sample else None)
    x = rng.normal(size=(n, d))
    y = np.array(["ab"[int(v)] for v in (x[:, 1] + 0.4 * rng.normal(size=n) > 0)])
    y[:20] = "c"
    rows = [(i, x[i].tolist(), str(y[i])) for i in range(n)]
    predictions = []
    for parts in (1, 9):
        df = spark.createDataFrame(rows, "id long, x array<double>, y string").repartition(parts)
        low, width = learners.bin_edges(df, "x", bins)
        df = df.withColumn("bins", learners.binned("x", low, width, bins))
        model = learners.grow_forest(df, "id", "y", "bins", d, trees, depth, m, sample, bins)
        predictions.append({r.id: r.prediction for r in learners.forest_predict(df, model, "bins").collect()})
    assert predictions[0] == predictions[1]
    low, width = np.array(low), np.array(width)
    b = np.clip(np.floor((x - low) / width), 0, bins - 1).astype(int)
    grown = [brute_tree(b, y, np.array([poisson(i, t) if sample else 1 for i in range(n)]), depth, bins, t, m) for t in range(trees)]
    for i in range(n):
        votes = [g(b[i]) for g in grown]
        assert predictions[0][i] == min(set(votes), key=lambda v: (-votes.count(v), v))


def test_forest_of_no_rows_and_one_class(spark):
    df = spark.createDataFrame([(1, [0, 1], 2.0), (2, [1, 1], 2.0)], "id long, bins array<int>, y double")
    none = learners.grow_forest(df.limit(0), "id", "y", "bins", 2)
    assert [r.prediction for r in learners.forest_predict(df, none, "bins").collect()] == [None, None]
    one = learners.grow_forest(df, "id", "y", "bins", 2, depth=2)
    assert [r.prediction for r in learners.forest_predict(df, one, "bins").collect()] == [2.0, 2.0]


def start(keys, rank):
    raw = np.array([[(int(hashlib.md5(f"{k}-{i}".encode()).hexdigest()[:8], 16) + 0.5) / (1 << 32) for i in range(rank)] for k in keys])
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def test_als_against_brute_force_with_a_hot_user(spark):
    rng = random.Random(3)
    # one user has a third of all ratings; keys beyond 32 bits
    rows = [(5_000_000_000, f"i{j}", rng.random() * 5) for j in range(120)] + [(rng.randint(0, 40), f"i{rng.randint(0, 119)}", rng.random() * 5) for _ in range(240)]
    df = spark.createDataFrame([*rows, (None, "i1", 1.0), (1, None, 1.0)], "user long, item string, rating double").repartition(5)
    rank, reg = 4, 0.05
    users, items = learners.als_factors(df, rank=rank, iterations=3, reg=reg)
    us, it = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    v = dict(zip(it, start(it, rank)))
    for _ in range(3):
        solve = lambda mine, other: np.linalg.solve(sum(np.outer(other[o], other[o]) for o, _ in mine) + reg * len(mine) * np.eye(rank),
                                                    sum(x * other[o] for o, x in mine))
        u = {k: solve([(i, x) for a, i, x in rows if a == k], v) for k in us}
        v = {k: solve([(a, x) for a, i, x in rows if i == k], u) for k in it}
    ask = spark.createDataFrame([(a, i, 0.0) for a, i, _ in rows[::7]] + [(-1, "i1", 0.0), (us[0], "new", 0.0)], "user long, item string, r double")
    for r in learners.als_score(ask, users, items).collect():
        if r.user == -1 or r.item == "new":
            assert math.isnan(r.prediction)
        else:
            assert r.prediction == pytest.approx(float(u[r.user] @ v[r.item]), abs=1e-8)


@pytest.mark.parametrize("swap", [False, True])
def test_als_deals_its_ratings_once(spark, monkeypatch, swap):
    """Half steps for the larger side shuffle nothing, those for the smaller side one sum per key and bucket;
    hot keys or none, broadcast or not: the same factors."""
    rng = random.Random(8)
    rows = [(rng.randint(0, 90) if rng.random() < 0.7 else 7, rng.randint(0, 30), rng.random() * 5) for _ in range(600)]
    rows = [(i, u, r) if swap else (u, i, r) for u, i, r in rows]
    df = spark.createDataFrame(rows, "user long, item long, rating double").repartition(3)
    larger = "als-items" if swap else "als-users"
    plans, real = [], learners.materialize

    def written(frame, name="stage"):
        plans.append((name, frame._jdf.queryExecution().executedPlan().toString()))
        return real(frame, name)

    monkeypatch.setattr(learners, "materialize", written)
    results = []
    for hot, most in ((1, 1000), (8, 1000), (100_000, 1000), (1, 0), (8, 0)):
        monkeypatch.setattr(learners, "HOT_KEYS", hot)
        monkeypatch.setattr(learners, "DEFAULT_BROADCAST_ROWS", most)
        plans.clear()
        results.append([{r[0]: r.v for r in f.collect()} for f in learners.als_factors(df, rank=3, iterations=2, reg=0.1)])
        if (hot, most) == (1, 1000):
            steps = [executed for name, executed in plans if name == larger]
            assert len(steps) == 2 and not any("Exchange hashpartitioning" in p for p in steps)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lodestar_als")]
    for other in results[1:]:
        for mine, theirs in zip(results[0], other):
            assert mine.keys() == theirs.keys()
            for k in mine:
                assert theirs[k] == pytest.approx(mine[k], abs=1e-8)


def test_als_table_query_fits_its_ratings(spark):
    out = QUERIES["als_table_predict"](spark, SMALL)
    assert out.columns == ["user", "item", "rating", "prediction"] and out.count() > 0
    ratings = models_q._ratings(spark, SMALL).filter("split = 'train'")
    users, items = learners.als_factors(ratings)
    scored = learners.als_score(ratings, users, items)
    rmse, spread = scored.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2)), F.stddev_pop("rating")).first()
    assert rmse < 0.9 * spread


def test_pca_project_against_numpy(spark):
    rows = load(spark, SMALL, "embeddings", "vec_id", "embedding").collect()
    x = np.array([[float(v) for v in r.embedding] for r in rows])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    axes = vectors[:, ::-1][:, :3]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), range(3)] >= 0, 1, -1)
    want = {r.vec_id: p for r, p in zip(rows, x @ axes)}
    for r in QUERIES["pca_project"](spark, SMALL).collect():
        assert [r.pc1, r.pc2, r.pc3] == pytest.approx(list(want[r.vec_id]), abs=1e-6)


def test_hash_buckets_equal_hashing_tf(spark):
    rng = random.Random(1)
    words = ["", "a", "ab", "abc", "abcd", "é", "日本", "x" * 5000, "\0"] + [
        "".join(chr(rng.choice([97, 233, 0x4E2D, 0x1F600, 32, 0, 0xFF])) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in [*words, None]], "w string")
    for n in (1 << 18, 1000):
        tf = HashingTF(numFeatures=n)
        assert {r.w: r.b for r in with_hash_bucket(df, "w", "b", n).collect()} == {None: None, **{w: tf.indexOf(w) for w in words}}


def test_text_classify_predicts_as_the_pipeline(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF

    from lodestar.operators import models

    labels = load(spark, SMALL, "labels", "doc_id", "quality").filter("quality IS NOT NULL")
    docs = load(spark, SMALL, "documents", "doc_id", "text").join(labels, "doc_id").withColumn("label", F.col("quality").cast("double"))
    mine = {r.doc_id: r.prediction for r in QUERIES["text_classify"](spark, SMALL).collect()}
    assert {type(s) for s in models.text_classifier().getStages()} >= {HashingTF, IDF, NaiveBayes}
    model = models.text_classifier().fit(docs.filter(~F.col("doc_id").isin(list(mine))))
    theirs = {r.doc_id: r.prediction for r in model.transform(docs.filter(F.col("doc_id").isin(list(mine)))).collect()}
    assert mine == theirs and len(mine) > 5


def test_label_index_any_layout_nulls_and_clashes(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 8 + [f"k{j}" for j in range(30)] + [None])) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, s string").withColumn("n", F.lit("kept")).withColumn("label", F.lit(1))
    index = features.label_index(df.repartition(7), "s")
    counts = {}
    for _, s in rows:
        if s is not None:
            counts[s] = counts.get(s, 0) + 1
    want = {s: float(i) for i, s in enumerate(sorted(counts, key=lambda s: (-counts[s], s)))}
    assert {r.label: r["index"] for r in index.collect()} == want
    assert {r.label: r["index"] for r in features.label_index(df.repartition(1), "s").collect()} == want
    more = df.unionByName(spark.createDataFrame([(1000, "unseen", "kept", 1)], df.schema))
    got = {r.id: (r.i, r.n) for r in features.apply_label_index(more, index, "s", "i", unseen="keep").collect()}
    assert got == {**{i: (want.get(s, float(len(want))), "kept") for i, s in rows}, 1000: (float(len(want)), "kept")}
    skipped = features.apply_label_index(more, index, "s", "i")
    assert skipped.columns == ["id", "s", "n", "label", "i"] and skipped.count() == sum(counts.values())
    back = features.apply_labels(spark.createDataFrame([(1, 0.0), (2, 999.0), (3, None), (4, 0.5)], "id long, i double"), index, "i", "name")
    assert {r.id: r.name for r in back.collect()} == {1: "hot", 2: None, 3: None, 4: None}
    assert features.label_index(df.limit(0), "s").collect() == []


def test_observed_metrics_count_every_row_once(spark, tmp_path):
    df = spark.range(1000).repartition(6)
    seen = write_observed(df, str(tmp_path / "o"), keep=F.col("id") % 3 == 0, rows=F.count(F.lit(1)), total=F.sum("id"))
    assert seen == {"rows": 1000, "total": 499_500} and spark.read.parquet(str(tmp_path / "o")).count() == 334
    assert write_observed(df.limit(0), str(tmp_path / "e"), rows=F.count(F.lit(1)), total=F.sum("id")) == {"rows": 0, "total": None}
