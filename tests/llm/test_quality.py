import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401
from lodestar.llm import quality

DEBUG = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=3
  If (feature 0 <= 0.5)
   If (feature 0 <= 0.25)
    Predict: 0.0
   Else (feature 0 > 0.25)
    Predict: 1.0
  Else (feature 0 > 0.5)
   If (feature 2 <= 1.5E-4)
    Predict: 1.0
   Else (feature 2 > 1.5E-4)
    Predict: 0.0
"""


def made_up(n=400, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 80))]
        bad = rng.random() < 0.25
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * len(words)
        docs.append((i, " ".join(words), "en", "a"))
        labels.append((i, 0 if bad else 1, None))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"
EDGES = [(5000, None, None, None), (5001, "", None, None), (5002, " \n\t", None, None), (5003, "x " * 200_000, None, "b"), (None, "no id here", None, "b"),
         (5004, "twice told", None, "b"), (5004, "twice told", None, "b"), (5005, "é日本\U0001F600", None, "b")]


def test_paths_of_a_printed_tree():
    assert quality.tree_paths(DEBUG) == {
        ((0, True, 0.5),), ((0, True, 0.25),), ((0, False, 0.25), (0, True, 0.5)), ((0, False, 0.5),),
        ((0, False, 0.5), (2, True, 0.00015)), ((0, False, 0.5), (2, False, 0.00015))}


def test_compiled_score_equals_the_rules(spark):
    model = quality.RuleModel(-0.3, ((1.5, ((0, True, 2.0), (1, False, 0.5))), (-2.0, ((1, True, 0.5),)), (0.25, ((2, False, -1.0),))))
    rows = [(i, [float(i % 4), (i % 3) / 2, float(i - 5)]) for i in range(12)]
    got = {r.id: r.s for r in spark.createDataFrame(rows, "id int, f array<double>").select("id", model.score(F.col("f")).alias("s")).collect()}
    for i, f in rows:
        z = -0.3 + 1.5 * (f[0] <= 2 and f[1] > 0.5) - 2.0 * (f[1] <= 0.5) + 0.25 * (f[2] > -1)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)))
    assert len(model.describe()) == 3


def test_held_out_documents_are_told_apart(spark, docs_of):
    docs, labels = made_up()
    df = docs_of(docs + EDGES).withColumn("stats", F.lit("x")).withColumn("label", F.lit(9)).withColumn("quality", F.lit(9))
    marks = spark.createDataFrame(labels + [(1, None, 0), (None, 1, 0), (2, labels[2][1], 1), (2, labels[2][1], 1)], LABELS)
    got = quality.classify(df, marks).collect()
    assert len(got) == len(docs) + len(EDGES)
    want = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 60 and sum(r.predicted == want[r.doc_id] for r in held) >= 0.95 * len(held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
    twice = {r.score for r in got if r.doc_id == 5004}
    blank = {r.score for r in got if r.doc_id in (5000, 5001, 5002)}
    assert len(twice) == len(blank) == 1
    kept = quality.accepted(df, marks)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)


def test_held_out_labels_and_other_columns_are_not_learned_from(spark, docs_of):
    docs, labels = made_up(200)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, None) for i, q, _ in labels]
    a = quality.fit(docs_of(docs), spark.createDataFrame(labels, LABELS))
    b = quality.fit(docs_of([(i, t, "xx", "other") for i, t, *_ in docs]), spark.createDataFrame(flipped, LABELS))
    assert a == b


def test_model_depends_on_no_layout(spark, docs_of):
    """Files, their order, and the number of tasks change neither rules nor weights."""
    docs, labels = made_up()
    one = quality.fit(docs_of(docs).coalesce(1), spark.createDataFrame(labels, LABELS).coalesce(1))
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        many = quality.fit(docs_of(docs[::-1]).repartition(7), spark.createDataFrame(labels[::-1], LABELS).repartition(5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    assert one.rules and one == many


def test_sample_is_bounded(spark, docs_of):
    docs, labels = made_up(200)
    sample = quality.training_sample(docs_of(docs + docs[:50]), spark.createDataFrame(labels, LABELS), "doc_id", "text", rows=40)
    assert sample.count() == 40


def test_tables_without_lessons(spark, docs_of):
    docs, labels = made_up(30)
    none = spark.createDataFrame([], LABELS)
    assert quality.classify(docs_of([]), none).collect() == []
    assert {r.score for r in quality.classify(docs_of(docs), none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i, *_ in labels], LABELS)
    assert {r.predicted for r in quality.classify(docs_of(docs), ones).collect()} == {1}


def test_whole_texts_count():
    clean = "some words that differ from one another here now " * 3
    assert quality.text_statistics(clean + "LOUD!! " * 500) != quality.text_statistics(clean)
    assert len(quality.text_statistics("a")) == len(quality.FEATURES) == len(quality.text_statistics(None))
