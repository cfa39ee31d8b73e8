"""Rows-only queries: invariants that must hold whatever the random state."""

from pyspark.sql import functions as F

from lodestar.operators.cleanse import deterministic_split
from lodestar.plans import QUERIES
from lodestar.sources.tables import load

from conftest import SMALL


def _test_split_size(spark, table, key, pct):
    df = load(spark, SMALL, table, key)
    return df.filter(deterministic_split(F.col(key), pct) == "test").count()


def test_kmeans_sizes_cover_all_rows(spark):
    out = QUERIES["kmeans_sizes"](spark, SMALL).collect()
    assert len(out) == 4
    assert sum(r["n"] for r in out) == load(spark, SMALL, "lineitem").count()


def test_tree_and_forest_score_every_test_row(spark):
    n_test = _test_split_size(spark, "embeddings", "vec_id", 70)
    for name in ("decision_tree", "random_forest"):
        df = QUERIES[name](spark, SMALL)
        assert df.count() == n_test
        labels = {r[0] for r in df.select("prediction").distinct().collect()}
        assert labels <= set(float(i) for i in range(10))


def test_pca_three_components(spark):
    df = QUERIES["pca_project"](spark, SMALL)
    assert df.columns == ["vec_id", "pc1", "pc2", "pc3"]
    assert df.count() == load(spark, SMALL, "embeddings").count()


def test_als_scores_each_test_pair(spark):
    df = QUERIES["als_predict"](spark, SMALL)
    assert df.columns == ["user", "item", "rating", "prediction"]
    assert df.count() > 0


def test_text_classify_predicts_known_classes(spark):
    df = QUERIES["text_classify"](spark, SMALL)
    preds = {r[0] for r in df.select("prediction").distinct().collect()}
    assert preds <= {0.0, 1.0}
    assert df.count() > 0


def test_hashed_pipeline_accuracy_close_to_exact(spark):
    from conftest import MEDIUM

    hashed = QUERIES["text_classify"](spark, MEDIUM)
    exact = QUERIES["naive_bayes_predict"](spark, MEDIUM)
    acc = lambda df: df.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert abs(acc(hashed) - acc(exact)) <= 0.1
    assert hashed.count() == exact.count()


def test_kmeans_assigns_nearest_centre(spark):
    from lodestar.operators import features, models, stats

    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = load(spark, SMALL, "lineitem", *cols)
    z = stats.standardize(li, cols)
    vec = features.assemble(z, [f"z_{c}" for c in cols])
    model = models.kmeans(vec, k=4, seed=1)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    scored = model.transform(vec)
    dist = [sum((F.col(f"z_{c}") - F.lit(centre[i])) ** 2 for i, c in enumerate(cols)) for centre in centres]
    nearest = F.lit(0)
    best = dist[0]
    for j in range(1, len(dist)):
        nearest = F.when(dist[j] < best, F.lit(j)).otherwise(nearest)
        best = F.least(best, dist[j])
    assert scored.filter(nearest != F.col("prediction")).count() == 0
