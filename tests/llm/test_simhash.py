import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestar.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, distance):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None:
            least[r] = min(least.get(r, x), x)
    return [least.get(find(i)) for i in range(len(ids))]


TEXTS = [
    None, "", " \t\n", "one", "One", "one two", "a b c d", "A  b\tc\nd", "\x0b\x0c", "É a b c d e f", "é a b c d e f",
    "x\x1cy z\xa0w v", "\ud83d\ude00 smile ok fine yes".encode("utf-16", "surrogatepass").decode("utf-16"),
    "to be or not to be or not to be or not", "w " * 1000, "long " + " ".join(f"t{i % 977}" for i in range(60_000)),
]


def test_fingerprints_match_the_definition():
    for t in TEXTS:
        assert simhash._fingerprint(t, 4) % 2**64 == brute_fingerprint(t), repr(t)[:60]
    assert simhash._fingerprint("a b c", 2) % 2**64 == brute_fingerprint("a b c", 2)


def test_very_long_text_is_hashed_in_blocks(monkeypatch):
    text = " ".join(f"t{i % 311}" for i in range(5000))
    whole = simhash._fingerprint(text, 4)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    assert simhash._fingerprint(text, 4) == whole


def test_embedding_is_a_lower_bound_and_cells_cover_all_links(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(400):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 6)):
            y ^= 1 << b
        pairs.append((x - 2**64 * (x >> 63), y - 2**64 * (y >> 63)))
    df = spark.createDataFrame(pairs, "x long, y long")
    rows = df.select("x", "y", F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).alias("hamming"),
                     F.bit_count(simhash.embedding(F.col("x")).bitwiseXOR(simhash.embedding(F.col("y")))).alias("manhattan")).collect()
    segments = lambda v: [((v >> 2 * i) & 3).bit_count() for i in range(32)]
    for r in rows:
        a, b = segments(r.x % 2**64), segments(r.y % 2**64)
        assert r.manhattan == sum(abs(p - q) for p, q in zip(a, b)) <= r.hamming
    cells = {fp: {r.cell for r in g} for fp, g in _grouped(simhash._cells(df.select(F.col("x").alias("fp")).union(df.select("y")).distinct(), 4).collect())}
    assert all(cells[r.x] & cells[r.y] for r in rows if r.hamming <= 4)


def _grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.fp, []).append(r)
    return out.items()


@pytest.mark.parametrize("seed", [3, 4])
def test_components_of_dense_and_sparse_fingerprints(spark, seed):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for centre in prints[:3]:  # dense groups: many mutual links, some only through others
        for _ in range(120):
            x = centre
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
            prints.append(x)
    chain = rng.getrandbits(64)  # a chain of links
    for i in range(0, 40, 4):
        chain ^= 0xF << i
        prints.append(chain)
    prints += prints[:20]  # exact copies
    signed = [(p - 2**64 * (p >> 63),) for p in prints]
    got = {r.fp: r.root for r in simhash.link_components(spark.createDataFrame(signed, "fp long"), 4).collect()}
    want = brute_components([s[0] for s in signed], prints, 4)
    assert got == {s[0]: w for s, w in zip(signed, want)}


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(9)
    base = " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(300))
    rows = [(5, base), (2, base), (2, base), (None, base), (9, base.upper()), (7, None), (3, ""), (4, " \n"), (8, "short"), (None, "alone here"), (11, "w " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1)).withColumn("row", F.lit(2))
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    prints = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], prints, 4)
    assert got == sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, want)), key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    groups = {}
    for (i, t), c in zip(rows, brute_components([i for i, _ in rows], prints, 4)):
        groups.setdefault((c, None if c is not None else t), []).append(i)
    assert kept.count() == len(groups)
    assert {r.doc_id for r in kept.collect()} == {c for c, _ in groups}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_distance_bounds():
    assert len(simhash._cell_masks(4)) == 126
    with pytest.raises(ValueError):
        simhash._cell_masks(40)
    assert np.bitwise_or.reduce([m % 2**64 for m in simhash._cell_masks(0)]) == 2**64 - 1
