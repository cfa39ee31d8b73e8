import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lodestar.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [a + " " + b for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target, percent=25, least=20):
    corpus, aim = [0] * 10_000, [0] * 10_000
    for _, text in rows:
        for g in grams(text)[1]:
            corpus[bucket(g)] += 1
    for text in target:
        for g in grams(text)[1]:
            aim[bucket(g)] += 1
    S, T = sum(corpus), sum(aim)
    gain = [math.floor(1000 * math.log((t + 1) * (S + 10_000) / ((s + 1) * (T + 10_000)))) for s, t in zip(corpus, aim)]
    out = []
    for doc_id, text in rows:
        words, fs = grams(text)
        weight = sum(gain[bucket(g)] for g in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(may[:len(may) * percent // 100])}
    return sorted(((*r, ranks.get(id(r))) for r in out), key=str)


def run(spark, rows, target, parts=3, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    # extra columns whose names clash with the operator's
    docs = docs.withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("tie", F.lit(None).cast("int")).withColumn("n", F.lit(2))
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, aim, **kw).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["Alpha", "béta", "x9", "the", "of", "a", "Ünï", "z" * 70, "q" * 200, "数据"]
    seps = [" ", "  ", "\n", "-", "_", ".", "\t,"]
    out = [(i, "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    return [*out, (1000, None), (1001, ""), (1002, " .,-\n"), (None, "the of a " * 10), (1003, "The OF " * 30)]


def test_against_brute_force(spark, rows):
    target = ["the of béta x9", "Alpha " * 9, None, ""]
    assert run(spark, rows, target) == brute(rows, target)
    assert run(spark, rows, target, 7) == brute(rows, target)


def test_long_texts_in_pieces(spark, rows, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 64)
    import pyarrow as pa

    texts = [t for _, t in rows] + ["w" * 1000 + " b " + "c" * 300, "a" * 500]
    n = [[0, 0] for _ in texts]
    got = [[] for _ in texts]
    for first, size, words, found in resampling.features(pa.array(texts)):
        for i in range(size):
            n[first + i][0] += int(words[i])
        for b, row in found:
            for x, r in zip(b.tolist(), row.tolist()):
                got[first + r].append(x)
    for text, (count, _), codes in zip(texts, n, got):
        words, fs = grams(text)
        assert count == len(words) and sorted(codes) == sorted(map(bucket, fs))


def test_ties_repeats_and_percent(spark):
    # equal rows, a third of the table: as many are drawn as asked, ranks have no gap
    rows = [(5, "one two three four five " * 5)] * 40 + [(i, f"w{i} " * 25) for i in range(80)]
    got = run(spark, rows, ["one two"], percent=50)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 61))
    assert got == brute(rows, ["one two"], percent=50)


def test_cutoff_widens_a_wrong_bracket(spark):
    values = [(int(x), i) for i, x in enumerate([0] * 300 + list(range(1, 101)))]
    df = spark.createDataFrame(values, "score long, tie long").repartition(4)
    order = sorted(values, key=lambda r: (-r[0], r[1]))
    for k in (1, 100, 250):
        for accuracy in (1, 1000):
            assert resampling.cutoff(df, k, accuracy) == order[k - 1]


def test_empty_tables(spark, rows):
    assert run(spark, [], ["a b"]) == []
    assert run(spark, rows[:50], []) == brute(rows[:50], [])
    short = [(1, "a b"), (2, None)]
    assert run(spark, short, ["a"]) == brute(short, ["a"])
