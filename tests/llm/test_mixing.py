import random

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401
from lodestar.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """Share, stop at the limit, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = sum(w[s] for s in names if s not in capped)
        left = total - sum(limit * sizes[s] for s in capped)
        target = {s: limit * sizes[s] if s in capped else w[s] * left / rest for s in names}
        over = {s for s in names if s not in capped and target[s] > limit * sizes[s]}
        if not over:
            return target
        capped |= over


def check(rows, got):
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    target = brute_targets(sizes)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
    for s in sizes:
        longest = max(r.size for r in got if r.source == s)
        assert abs(taken[s] - target[s]) <= longest / 2 + 1e-6, s
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for i in range(900):
        source = rng.choice(["src0"] * 6 + ["b", "é", "z", "src10", "src2", None])
        out.append((i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 60))), "en", source))
    out += [(1000, None, None, "b"), (1001, "", None, "b"), (1002, "\t\n x", None, None), (1003, "y " * 20_000, None, "z"), (None, "no id", None, "b")]
    out += [(1004, "the same row twice", None, "src2")] * 2
    return out


def test_targets_and_taken_words(spark, docs_of, rows):
    df = docs_of(rows).withColumn("size", F.lit("x")).withColumn("h", F.lit(1)).withColumn("target", F.lit(None).cast("double"))
    out = mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken")
    ids = {(r.doc_id, r.text): r.source for r in df.collect()}
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {i: s for (i, _), s in ids.items()}
    class Row:  # noqa: E306
        def __init__(self, r):
            self.source, self.size, self.taken, self.target, self.source_size, self.doc_id = by_id[r.doc_id], r["size"], r.taken, r.target, r.source_size, r.doc_id
    named = [Row(r) for r in got]
    target = check(rows, named)
    for r in named:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sum(x.size for x in named if x.source == r.source)
    size = {r.doc_id: r.size for r in named}
    assert size[1000] == size[1001] == 0 and size[1002] == 1 and size[1003] == 20_000
    twice = [r.taken for r in named if r.doc_id == 1004]
    assert len(twice) == 2 and twice[0] == twice[1]
    again = mixing.mix(docs_of(rows, 7)).collect()
    assert sorted(map(str, (tuple(r) for r in again))) == sorted(map(str, (tuple(r) for r in got)))


def test_thresholds_are_nested(spark):
    slim = spark.range(500).select(F.lit("s").alias("source"), (F.col("id") % 7).alias("size"), (F.xxhash64("id").bitwiseAND(F.lit((1 << 60) - 1))).alias("h"))
    below = [mixing.hash_thresholds(slim, spark.createDataFrame([("s", float(b))], "source string, budget double")).first().below for b in (0, 10, 300, 900, 1400)]
    assert below == sorted(below)
    taken = [slim.filter(F.col("h") < b).agg(F.sum("size")).first()[0] or 0 for b in below]
    assert taken[0] == 0 and all(abs(t - b) <= 3 for t, b in zip(taken[1:], (10, 300, 900, 1400)))


def test_mixed_documents_repeat_rows(spark, docs_of, rows):
    df = docs_of(rows)
    copies = {}
    for r in mixing.mixed_documents(df).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for r in mixing.mix(df).filter("doc_id <> 1004 and size > 0").collect():
        assert copies.get(r.doc_id, 0) == r.taken / r["size"]
    assert mixing.mixed_documents(df).columns == df.columns


def test_edge_tables(spark, docs_of):
    empty = docs_of([])
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    blank = mixing.mix(docs_of([(1, None, None, "a"), (2, "", None, None)])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)] * 2
    one = mixing.mix(docs_of([(1, "a b c", None, None)])).first()
    assert (one["size"], one.source_size, one.target) == (3, 3, 4.5) and one.taken in (3, 6)


def test_hot_source_and_single_source_capped(spark, docs_of):
    # the small heavy source is capped at twice its size; the hot one takes the rest
    rows = [(i, "w " * 10, None, "hot") for i in range(300)] + [(1000 + i, "w " * 10, None, "a") for i in range(3)]
    got = mixing.mix(docs_of(rows)).collect()
    targets = {r.target for r in got}
    assert targets == {60.0, 1.5 * 3030 - 60}


def test_columns_named_like_our_own_keep_their_values(spark, docs_of, rows):
    names = ["_ls", "_ls_s", "_ls_salt", "_ls_copy", "_ls_h", "_ls_plan", "_ls_source", "size", "h", "below"]
    plain = docs_of(rows[:200])
    df = plain
    for i, name in enumerate(names):
        df = df.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    out = got.collect()
    for i, name in enumerate(names):
        assert all(r[name] == f"{i}:{'-' if r.doc_id is None else r.doc_id}" for r in out)
    count = lambda found: sorted((str(r.doc_id), r.text) for r in found)
    assert count(out) == count(mixing.mixed_documents(plain).collect())
