"""Feature, model and recommendation queries."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodestar.functions.fixed import (
    CLASSIFIER_TRAIN_PERCENT, KMEANS_K, KMEANS_SEED, PCA_K, RECOMMENDER_TRAIN_PERCENT, REGRESSION_TRAIN_PERCENT,
)
from lodestar.functions import hashing
from lodestar.operators import features, learners, metrics, models, stats, text
from lodestar.operators.cleanse import deterministic_split
from lodestar.operators.partitioning import spread
from lodestar.operators.relational import group_count
from lodestar.plans.analytics_q import labelled_texts
from lodestar.plans.registry import query
from lodestar.session import materialize
from lodestar.sources.tables import load


def _split_sql(key: str, train_percent: int) -> str:
    return f"((({key}) % 100003 + 100003) % 100003 * 7919 % 100003) % 100 < {train_percent}"


@query(
    "string_index",
    sql="""
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
     i AS (SELECT o_orderpriority,
                  CAST(row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS DOUBLE) AS priority_index
           FROM c)
SELECT o.o_orderkey, o.o_orderpriority, i.priority_index
FROM orders o JOIN i ON o.o_orderpriority = i.o_orderpriority
""",
)
def string_index(spark, sf_dir):
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    index = features.label_index(orders, "o_orderpriority")
    return features.apply_label_index(orders, index, "o_orderpriority", "priority_index").select("o_orderkey", "o_orderpriority", "priority_index")


@query(
    "label_index_table",
    sql="""
WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1),
     i AS (SELECT l_partkey, CAST(row_number() OVER (ORDER BY n DESC, l_partkey) - 1 AS DOUBLE) AS part_index FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, part_index FROM lineitem JOIN i USING (l_partkey)
""",
    note="M1 over a column of any number of labels: the index is a table",
)
def label_index_table(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return features.apply_label_index(li, features.label_index(li, "l_partkey"), "l_partkey", "part_index")


@query("index_to_string", sql="SELECT o_orderkey, o_orderpriority AS priority_label FROM orders")
def index_to_string(spark, sf_dir):
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    index = features.label_index(orders, "o_orderpriority")
    indexed = features.apply_label_index(orders, index, "o_orderpriority", "priority_index")
    return features.apply_labels(indexed, index, "priority_index", "priority_label").select("o_orderkey", "priority_label")


# Regression of price on quantity and discount, trained on 90% of orders.
LR_TRAIN_PERCENT = REGRESSION_TRAIN_PERCENT
_LR_FEATURES = ["l_quantity", "l_discount"]


def _lr_split(spark, sf_dir):
    li = spread(load(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice", *_LR_FEATURES))
    li = li.withColumn("split", deterministic_split(F.col("l_orderkey"), LR_TRAIN_PERCENT))
    data = features.assemble(li, _LR_FEATURES).withColumnRenamed("l_extendedprice", "label")
    return data.filter("split = 'train'"), data.filter("split = 'test'")


_LR_SQL = f"""
WITH t AS (SELECT l_extendedprice AS y, l_quantity AS q, l_discount AS d FROM lineitem
           WHERE {_split_sql('l_orderkey', LR_TRAIN_PERCENT)}),
     m AS (SELECT avg(y) AS my, avg(q) AS mq, avg(d) AS md,
                  covar_pop(y, q) AS syq, covar_pop(y, d) AS syd, var_pop(q) AS sqq,
                  var_pop(d) AS sdd, covar_pop(q, d) AS sqd FROM t),
     b AS (SELECT (syq * sdd - syd * sqd) / (sqq * sdd - sqd * sqd) AS b1,
                  (syd * sqq - syq * sqd) / (sqq * sdd - sqd * sqd) AS b2, my, mq, md FROM m),
     coef AS (SELECT my - b1 * mq - b2 * md AS b0, b1, b2 FROM b)
"""


@query(
    "linear_regression",
    sql=_LR_SQL + """
SELECT round(b0, 4) + 0.0 AS intercept, round(b1, 4) + 0.0 AS coef_l_quantity, round(b2, 4) + 0.0 AS coef_l_discount FROM coef
""",
)
def linear_regression(spark, sf_dir):
    train, _ = _lr_split(spark, sf_dir)
    model = models.linear_regression(train)
    coefs = model.coefficients.toArray().tolist()
    # The fitted model is three numbers; return them as a one-row table.
    return spark.createDataFrame(
        [(float(model.intercept), *[float(c) for c in coefs])],
        "intercept double, coef_l_quantity double, coef_l_discount double",
    ).select(*[F.round(c, 4).alias(c) for c in ["intercept", "coef_l_quantity", "coef_l_discount"]])


@query(
    "regression_metrics",
    sql=_LR_SQL + f"""
, s AS (SELECT l_extendedprice AS y, b0 + b1 * l_quantity + b2 * l_discount AS p
        FROM lineitem, coef WHERE NOT ({_split_sql('l_orderkey', LR_TRAIN_PERCENT)}))
SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2,
       count(*) AS n
FROM s
""",
)
def regression_metrics(spark, sf_dir):
    train, test = _lr_split(spark, sf_dir)
    model = models.linear_regression(train)
    scored = model.transform(test)
    out = metrics.regression_metrics(scored, "label", "prediction")
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), "n")


_KMEANS_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KMEANS_KEYS = ["l_orderkey", "l_linenumber"]
_KMEANS_FEATURES = [f"f{i}" for i in range(len(_KMEANS_COLS))]
KMEANS_ITERATIONS = 10


def _kmeans_rows(spark, sf_dir):
    """Standardised columns in millionths: whole numbers, whose sums no order of rows changes."""
    li = load(spark, sf_dir, "lineitem", *_KMEANS_KEYS, *_KMEANS_COLS)
    z = stats.standardize(li, _KMEANS_COLS, keep=_KMEANS_KEYS)
    return materialize(z.select(*_KMEANS_KEYS, *[F.round(F.col(f"z_{c}") * 1_000_000).cast("long").alias(f)
                                                 for c, f in zip(_KMEANS_COLS, _KMEANS_FEATURES)]), "kmeans-rows")


def _kmeans_sql() -> str:
    f = _KMEANS_FEATURES
    stat = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(_KMEANS_COLS))
    cols = ", ".join(f"CAST(round((({c} - m{i}) / s{i}) * 1000000) AS BIGINT) AS f{i}" for i, c in enumerate(_KMEANS_COLS))
    names, far = ", ".join(f), " + ".join(f"(z.{x} - c.{x}) * (z.{x} - c.{x})" for x in f)
    steps = [f"s AS (SELECT {stat} FROM lineitem)",
             f"y AS (SELECT l_orderkey, l_linenumber, {cols} FROM lineitem, s)",
             "z AS MATERIALIZED (SELECT row_number() OVER () AS r, md5(concat_ws('-', l_orderkey, l_linenumber, " + names + f")) AS h, {names} FROM y)",
             f"i0 AS MATERIALIZED (SELECT 0 AS c, {names} FROM z ORDER BY h LIMIT 1)"]
    for k in range(1, KMEANS_K):
        farthest = f"SELECT {', '.join('any_value(z.' + x + ') AS ' + x for x in f)}, any_value(h) AS h, min({far}) AS d FROM z, i{k - 1} c GROUP BY r ORDER BY d DESC, h DESC LIMIT 1"
        steps.append(f"i{k} AS MATERIALIZED (SELECT * FROM i{k - 1} UNION ALL SELECT {k}, {names} FROM ({farthest}))")
    near = lambda t: (f"SELECT r, {', '.join('any_value(z.' + x + ') AS ' + x for x in f)}, "  # noqa: E731
                      f"arg_min(c.c, ({far}) * {KMEANS_K} + c.c) AS c FROM z, {t} c GROUP BY r")
    last = f"i{KMEANS_K - 1}"
    for n in range(KMEANS_ITERATIONS):
        mean = ", ".join(f"CAST(floor((2 * sum({x}) + count(*)) / (2.0::DOUBLE * count(*))) AS BIGINT) AS {x}" for x in f)
        kept = ", ".join(f"coalesce(m.{x}, o.{x}) AS {x}" for x in f)
        steps.append(f"m{n} AS MATERIALIZED (SELECT o.c, {kept} FROM {last} o LEFT JOIN (SELECT c, {mean} FROM ({near(last)}) GROUP BY c) m USING (c))")
        last = f"m{n}"
    return "WITH " + ",\n".join(steps) + f"\nSELECT c AS prediction, count(*) AS n FROM ({near(last)}) GROUP BY c"


@query("kmeans_sizes", sql=_kmeans_sql(), note="M12: farthest-first centres, ten rounds of Lloyd over whole numbers")
def kmeans_sizes(spark, sf_dir):
    rows = _kmeans_rows(spark, sf_dir)
    centres = learners.kmeans_centres(rows, _KMEANS_KEYS, _KMEANS_FEATURES, KMEANS_K, KMEANS_ITERATIONS)
    return group_count(rows.select(learners.nearest_centre(_KMEANS_FEATURES, centres).alias("prediction")), "prediction")


@query("kmeans_facts", sql=f"SELECT {KMEANS_K} AS clusters, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_not_nearest FROM lineitem",
       note="what holds for Spark ML's estimator on any layout: k clusters, every row in one, no row nearer to another centre")
def kmeans_facts(spark, sf_dir):
    data = _kmeans_rows(spark, sf_dir).select(*[(F.col(c) / 1_000_000).alias(c) for c in _KMEANS_FEATURES])
    vec = features.assemble(data, _KMEANS_FEATURES).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = models.kmeans(vec, k=KMEANS_K, seed=KMEANS_SEED)
        x = vector_to_array("features")
        far = [sum(((x[d] - F.lit(float(v))) ** 2 for d, v in enumerate(c)), F.lit(0.0)) for c in model.clusterCenters()]
        own = F.element_at(F.array(*far), F.col("prediction") + 1)
        return materialize(model.transform(vec).agg(
            F.count_distinct("prediction").cast("int").alias("clusters"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(own > F.array_min(F.array(*far)) + 1e-9).alias("n_not_nearest")), "kmeans-facts")
    finally:
        vec.unpersist()


def _embedding_split(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    data = emb.select("vec_id", F.col("label").cast("double").alias("label"),
                      F.transform("embedding", lambda x: x.cast("double")).alias("x"), features.array_features("embedding").alias("features"),
                      deterministic_split(F.col("vec_id"), CLASSIFIER_TRAIN_PERCENT).alias("split"))
    return data.filter("split = 'train'"), data.filter("split = 'test'")


FOREST_TREES, FOREST_DEPTH = 20, 5


def _forest(train, test, trees: int, sample: bool):
    """``test`` with the predictions of trees grown on ``train`` (key vec_id, features x, label)."""
    low, width = learners.bin_edges(train, "x")
    per_node = max(1, round(len(low) ** 0.5)) if sample else None
    train = train.withColumn("bins", learners.binned("x", low, width))
    model = learners.grow_forest(train, "vec_id", "label", "bins", len(low), trees, FOREST_DEPTH, per_node, sample)
    return learners.forest_predict(test.withColumn("bins", learners.binned("x", low, width)), model, "bins")


def _on_axes(train, test):
    """Both splits with x on the principal axes of the training split."""
    axes = features.principal_axes(train, PCA_K)
    return tuple(d.withColumn("x", F.array(*features.project(F.col("x"), axes))) for d in (train, test))


@query("decision_tree", note="rows-only: the tests hold it against a brute-force tree")
def decision_tree(spark, sf_dir):
    train, test = _embedding_split(spark, sf_dir)
    return _forest(train, test, 1, False).select("vec_id", "label", "prediction")


_CHAIN_SQL = f"""
SELECT count(*) AS n_test, count(DISTINCT vec_id) AS n_keys, CAST(0 AS BIGINT) AS n_unknown, count(*) AS n_matrix, true AS accuracy_agrees,
       true AS learned
FROM embeddings WHERE NOT ({_split_sql('vec_id', CLASSIFIER_TRAIN_PERCENT)})
"""


def _chain_facts(spark, sf_dir, fit):
    """The reference's whole chain: label index -> model -> index back to label ->
    confusion matrix -> accuracy, reduced to facts; ``learned``: on its own training rows the
    model is right clearly more often than the largest class."""
    train, test = _embedding_split(spark, sf_dir)
    train, test = (d.withColumn("category", F.concat(F.lit("c"), F.col("label").cast("int").cast("string"))).drop("label") for d in (train, test))
    index = features.label_index(train, "category")
    indexed = features.apply_label_index(train, index, "category", "label")
    both = test.withColumn("label", F.lit(-1.0)).unionByName(indexed)
    scored = materialize(fit(indexed, both).select("vec_id", "category", "split", "prediction"), "chain")
    named = materialize(features.apply_labels(scored, index, "prediction", "predicted"), "chain-named")
    seen, named = named.filter("split = 'train'"), named.filter("split = 'test'")
    matrix = metrics.confusion_matrix(named, "category", "predicted")
    right = matrix.filter("category = predicted").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    share = metrics.accuracy(named, "category", "predicted").select("accuracy").scalar()
    fitted = metrics.accuracy(seen, "category", "predicted").select("accuracy").scalar()
    largest = seen.groupBy("category").count().agg(F.max("count")).scalar()
    rows = seen.agg(F.count(F.lit(1))).scalar()
    return named.agg(
        F.count("vec_id").alias("n_test"), F.count_distinct("vec_id").alias("n_keys"), F.count_if(F.col("predicted").isNull()).alias("n_unknown"),
    ).select("*", matrix.agg(F.sum("n")).scalar().alias("n_matrix"),
             (F.abs(right / F.col("n_test") - share) < 1e-12).alias("accuracy_agrees"), (fitted > 1.2 * largest / rows).alias("learned"))


@query("decision_tree_facts", sql=_CHAIN_SQL, note="M1 -> M11 -> M2 -> M18 -> M17 end to end")
def decision_tree_facts(spark, sf_dir):
    return _chain_facts(spark, sf_dir, lambda train, rows: _forest(train, rows, 1, False))


@query("random_forest_facts", sql=_CHAIN_SQL, note="M1 -> M4 -> M13 -> M2 -> M18 -> M17 end to end")
def random_forest_facts(spark, sf_dir):
    return _chain_facts(spark, sf_dir, lambda train, rows: _forest(*_on_axes(train, rows), FOREST_TREES, True))


@query("pca_project", note="rows-only: the tests hold it against a brute-force decomposition")
def pca_project(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding")
    data = emb.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"), features.array_features("embedding").alias("features"))
    axes = features.principal_axes(data, PCA_K)
    return data.select("vec_id", *[c.alias(f"pc{i + 1}") for i, c in enumerate(features.project(F.col("x"), axes))])


@query("pca_facts", sql="SELECT count(*) AS n_rows, true AS uncorrelated, true AS falling FROM embeddings",
       note="what holds whatever the signs: components are uncorrelated and their variances fall")
def pca_facts(spark, sf_dir):
    p = pca_project(spark, sf_dir)
    pairs = [F.abs(F.corr(a, b)) < 1e-6 for a, b in (("pc1", "pc2"), ("pc1", "pc3"), ("pc2", "pc3"))]
    var = [F.var_pop(c) for c in ("pc1", "pc2", "pc3")]
    return p.agg(F.count("vec_id").alias("n_rows"), (pairs[0] & pairs[1] & pairs[2]).alias("uncorrelated"),
                 ((var[0] >= var[1]) & (var[1] >= var[2])).alias("falling"))


@query("random_forest", note="rows-only: the tests hold it against a brute-force forest")
def random_forest(spark, sf_dir):
    train, test = _on_axes(*_embedding_split(spark, sf_dir))
    return _forest(train, test, FOREST_TREES, True).select("vec_id", "label", "prediction")


def _ratings(spark, sf_dir):
    """user, item, rating, split: how much of a supplier's parts a customer orders on average."""
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_quantity")
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    ratings = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"))
        .agg(F.avg("l_quantity").alias("rating"))
    )
    split = deterministic_split(F.col("user") % 100_003 * 1009 + F.col("item") % 100_003, RECOMMENDER_TRAIN_PERCENT)
    # the ratings table feeds both training and scoring: build it once
    return materialize(ratings.withColumn("split", split), "ratings")


@query("als_predict", note="rows-only: Spark ML's factors depend on the random initialisation; see als_facts")
def als_predict(spark, sf_dir):
    ratings = models.int_ids(models.int_ids(_ratings(spark, sf_dir), "user"), "item")
    model = models.als(ratings.filter("split = 'train'"))
    scored = model.transform(ratings.filter("split = 'test'"))
    return scored.select(F.col("user_key").alias("user"), F.col("item_key").alias("item"), "rating", "prediction")


@query("als_table_predict", note="rows-only: the tests hold it against brute-force least squares; see als_facts")
def als_table_predict(spark, sf_dir):
    ratings = _ratings(spark, sf_dir)
    users, items = learners.als_factors(ratings.filter("split = 'train'"))
    return learners.als_score(ratings.filter("split = 'test'"), users, items).select("user", "item", "rating", "prediction")


_RATED_SPLIT = _split_sql("user_key % 100003 * 1009 + item_key % 100003", RECOMMENDER_TRAIN_PERCENT)


@query("als_facts", sql=f"""
WITH r AS (SELECT o_custkey AS user_key, l_suppkey AS item_key, avg(l_quantity) AS rating
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
     t AS (SELECT * FROM r WHERE {_RATED_SPLIT})
SELECT user_key, item_key, round(rating, 4) AS rating,
       user_key IN (SELECT user_key FROM t) AND item_key IN (SELECT item_key FROM t) AS scored
FROM r WHERE NOT ({_RATED_SPLIT})
""", note="every test pair once, under its own keys; a finite prediction exactly where user and item were in training")
def als_facts(spark, sf_dir):
    return als_predict(spark, sf_dir).select(
        F.col("user").alias("user_key"), F.col("item").alias("item_key"), F.round("rating", 4).alias("rating"),
        (~F.isnan("prediction") & (F.abs("prediction") < 1e6)).alias("scored"))


HASHED_FEATURES = 1 << 18


def _hashed_sql() -> str:
    ws = text.WHITESPACE.removesuffix("+")
    times = lambda a, c: f"((({a}) * {c & 0xFFFF} + ((({a}) * {c >> 16}) % 65536) * 65536) % 4294967296)"
    turn = lambda a, n: f"((({a}) * {1 << n}) % 4294967296 + ({a}) // {1 << (32 - n)})"
    byte = lambda at: f"substr(x, CAST({at} AS BIGINT), 2)"
    word = "CAST('0x' || " + " || ".join(byte(f"8 * i + {7 - 2 * j}") for j in range(4)) + " AS BIGINT)"
    tail = "CAST('0x0' || " + " || ".join(f"CASE WHEN n % 4 > {j} THEN {byte(f'8 * (n // 4) + {2 * j + 1}')} ELSE '' END" for j in (2, 1, 0)) + " AS BIGINT)"
    c1, c2 = hashing.C1, hashing.C2
    return f"""
WITH ld AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, lower(d.text) AS t,
                   regexp_replace(lower(d.text), '{ws}+$', '') AS s, {_split_sql('d.doc_id', CLASSIFIER_TRAIN_PERCENT)} AS is_train
            FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
     words AS (SELECT doc_id, label, is_train,
                      unnest(CASE WHEN t = '' THEN [''] WHEN s = '' THEN [] ELSE regexp_split_to_array(s, '{ws}') END) AS word FROM ld),
     -- Murmur3 of every distinct word, four bytes at a time
     b0 AS (SELECT word, hex(encode(word)) AS x, octet_length(encode(word)) AS n FROM (SELECT DISTINCT word FROM words)),
     b1 AS (SELECT word, n, [{word} FOR i IN range(n // 4)] AS ws, {tail} AS tail FROM b0),
     b2 AS (SELECT word, n, [{times('w', c1)} FOR w IN ws] AS ks, {times('tail', c1)} AS tail FROM b1),
     b3 AS (SELECT word, n, [{times(turn('k', 15), c2)} FOR k IN ks] AS ks, {times(turn('tail', 15), c2)} AS tail FROM b2),
     b4 AS (SELECT word, xor(xor(list_reduce(ks, lambda h, k: ({turn('xor(h, k)', 13)} * 5 + {hashing.ADD}) % 4294967296, CAST({hashing.SEED} AS BIGINT)), tail), n) AS h FROM b3),
     b5 AS (SELECT word, xor(h, h // 65536) AS h FROM b4), b6 AS (SELECT word, {times('h', hashing.FINAL1)} AS h FROM b5),
     b7 AS (SELECT word, xor(h, h // 8192) AS h FROM b6), b8 AS (SELECT word, {times('h', hashing.FINAL2)} AS h FROM b7),
     feature AS (SELECT word, xor(h, h // 65536) % {HASHED_FEATURES} AS token FROM b8),
     tf AS (SELECT doc_id, label, is_train, token, count(*) AS tf FROM words JOIN feature USING (word) GROUP BY ALL),
     n AS (SELECT count(*) AS n_docs FROM ld WHERE is_train),
     w AS (SELECT token, ln((any_value(n_docs) + 1.0) / (count(*) + 1.0)) AS idf FROM tf, n WHERE is_train GROUP BY token),
     f AS (SELECT label, token, sum(tf * idf) AS f FROM tf JOIN w USING (token) WHERE is_train GROUP BY ALL),
     fc AS (SELECT label, sum(f) AS fc FROM f GROUP BY label),
     cnt AS (SELECT label, count(*) AS c FROM ld WHERE is_train GROUP BY label),
     cls AS (SELECT label AS c, ln((c + 1.0) / ((SELECT sum(c) FROM cnt) + (SELECT count(*) FROM cnt))) AS lpr,
                    ln(1.0 / (fc + {HASHED_FEATURES}.0)) AS lpu FROM cnt JOIN fc USING (label)),
     theta AS (SELECT f.label, token, ln((f + 1.0) / (fc + {HASHED_FEATURES}.0)) AS lp FROM f JOIN fc USING (label)),
     x AS (SELECT doc_id, token, tf * coalesce(idf, ln(n_docs + 1.0)) AS x FROM tf LEFT JOIN w USING (token), n WHERE NOT is_train),
     xs AS (SELECT x.doc_id, cls.c, sum(x * coalesce(lp, lpu)) AS v
            FROM x CROSS JOIN cls LEFT JOIN theta ON theta.token = x.token AND theta.label = cls.c GROUP BY ALL),
     sc AS (SELECT t.doc_id, t.label, cls.c, lpr + coalesce(v, 0.0) AS s
            FROM (SELECT doc_id, label FROM ld WHERE NOT is_train) t CROSS JOIN cls LEFT JOIN xs ON xs.doc_id = t.doc_id AND xs.c = cls.c)
SELECT doc_id, label, first(c ORDER BY s DESC, c) AS prediction FROM sc GROUP BY doc_id, label
"""


@query("text_classify", sql=_hashed_sql(), note="M5-M9 as the reference has them: words, hashed term frequencies, IDF, Naive Bayes")
def text_classify(spark, sf_dir):
    docs = labelled_texts(spark, sf_dir)
    labels = load(spark, sf_dir, "labels", "doc_id", "quality").filter("quality IS NOT NULL").select(
        "doc_id", F.col("quality").cast("double").alias("label"), deterministic_split(F.col("doc_id"), CLASSIFIER_TRAIN_PERCENT).alias("split"))
    ids = load(spark, sf_dir, "documents", "doc_id").join(labels, "doc_id")
    tf = materialize(text.hashed_term_frequency(docs, "doc_id", "text", HASHED_FEATURES).join(labels, "doc_id"), "hashed-tf")
    train, test = ids.filter("split = 'train'"), ids.filter("split = 'test'")
    vocab, priors = text.naive_bayes_model(tf.filter("split = 'train'"), train, "label", n_features=HASHED_FEATURES)
    unseen = math.log(train.count() + 1.0)
    found = text.naive_bayes_predict(tf.filter("split = 'test'"), test, "doc_id", vocab, priors, "label", unseen_idf=unseen)
    return test.select("doc_id", "label").join(found, "doc_id")


@query("text_classify_facts", sql=f"""
SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, true AS known
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE NOT ({_split_sql('d.doc_id', CLASSIFIER_TRAIN_PERCENT)})
""", note="Spark ML's own pipeline: every test document once, with one of the classes")
def text_classify_facts(spark, sf_dir):
    docs = labelled_texts(spark, sf_dir)
    labels = load(spark, sf_dir, "labels", "doc_id", "quality")
    data = docs.join(labels, "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"),
        deterministic_split(F.col("doc_id"), CLASSIFIER_TRAIN_PERCENT).alias("split"))
    data = materialize(data, "labelled-text")  # read by the IDF fit, the Naive Bayes fit and the scoring
    model = models.text_classifier().fit(data.filter("split = 'train'"))
    return model.transform(data.filter("split = 'test'")).select("doc_id", "label", F.col("prediction").isin(0.0, 1.0).alias("known"))
