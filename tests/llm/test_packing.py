import random

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401
from lodestar.llm import packing


def brute_best_fit(sizes, sources, clusters, capacity):
    """Tightest compatible bin by trying all; of equal ones any (only the residuals are compared)."""
    bins, used = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [b for b in bins if b[0] >= size and s not in b[1] and (c is None or c not in b[2])]
        best = min(fits, key=lambda b: b[0], default=None)
        if best is None:
            best = [capacity, set(), set()]
            bins.append(best)
        used.append(best[0])
        best[0] -= size
        best[1].add(s)
        if c is not None:
            best[2].add(c)
    return used


def validate(sizes, sources, clusters, capacity, bins, offsets):
    held = {}
    for size, s, c, b, o in zip(sizes, sources, clusters, bins, offsets):
        used, seen = held.setdefault(b, [0, set()])
        assert o == used and used + size <= capacity
        marks = {("s", s)} | ({("c", c)} if c is not None else set())
        assert not marks & seen
        held[b] = [used + size, seen | marks]


@pytest.mark.parametrize("seed,sources,clusters", [(1, 3, 400), (2, 50, 5), (3, 1, 10), (4, 400, 400), (5, 8, 1)])
def test_every_piece_goes_to_a_tightest_compatible_bin(seed, sources, clusters):
    rng = random.Random(seed)
    capacity = 64
    sizes = sorted((rng.randint(1, 63) for _ in range(300)), reverse=True)
    src = [rng.choice(["hot", None, rng.randrange(sources)]) for _ in sizes]
    clu = [rng.choice([None, rng.randrange(clusters), rng.randrange(clusters)]) for _ in sizes]
    bins, offsets = packing.best_fit(sizes, src, clu, capacity)
    validate(sizes, src, clu, capacity, bins, offsets)
    # replay: with the bins as they stood, no compatible bin was tighter
    state = {}
    for size, s, c, b, o in zip(sizes, src, clu, bins, offsets):
        fits = [r for r, ss, cc in state.values() if r >= size and s not in ss and (c is None or c not in cc)]
        assert capacity - o == (min(fits) if fits else capacity)
        r, ss, cc = state.get(b, (capacity, set(), set()))
        state[b] = (r - size, ss | {s}, cc | ({c} if c is not None else set()))
    if sources == clusters == 400:
        assert len(set(bins)) <= 1.3 * sum(sizes) / capacity


def test_unconflicted_packing_equals_plain_best_fit():
    sizes = [50, 40, 30, 24, 20, 14, 10, 4]
    bins, offsets = packing.best_fit(sizes, list(range(8)), [None] * 8, 64)
    assert [64 - o for o in offsets] == brute_best_fit(sizes, list(range(8)), [None] * 8, 64)


def test_many_conflicting_copies_stay_fast():
    n = 6000
    bins, _ = packing.best_fit([30] * n, ["a"] * n, [1] * n, 64)
    assert len(set(bins)) == n


def rows():
    rng = random.Random(5)
    out = [(i, " ".join(["w%d" % rng.randrange(10**6)] * rng.randint(1, 90)), "en", rng.choice(["hot", "hot", "a", "b", "c", None])) for i in range(400)]
    out += [(1000 + i, "the same text " * 7, None, rng.choice("abc")) for i in range(60)]
    return out + [(2000, None, None, "a"), (2001, "", None, None), (2002, " \n", None, "a"), (2003, "x " * 5003, None, "a"), (2004, "y " * 200, None, "b"),
                  (2005, "Twice  HERE", None, "a"), (2005, "Twice  HERE", None, "a"), (None, "twice here", None, "b")]


@pytest.mark.parametrize("group", [50, 20_000])
def test_pieces_cover_documents_and_bins_hold(spark, docs_of, group):
    df = docs_of(rows(), 5).withColumn("bin", F.lit(1)).withColumn("length", F.lit("x")).withColumn("cluster", F.lit(0)).withColumn("at", F.lit(0))
    got = packing.pack_documents(df, capacity=100, group=group).collect()
    size = {r.doc_id: r.n for r in df.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).alias("n")).collect()}
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    assert set(pieces) == set(size)
    for d, p in pieces.items():
        if d == 2005:
            assert p == [(0, 0, 2)] * 2
            continue
        assert [x[:2] for x in sorted(p)] == [(i, 100 * i) for i in range(max(1, -(-size[d] // 100)))]
        assert sum(x[2] for x in p) == size[d] and all(x[2] == 100 for x in sorted(p)[:-1])
    bins = {}
    for r in got:
        if r.length == 0:
            assert r.bin_id is None
        else:
            bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        end = 0
        for r in sorted(b, key=lambda r: r.bin_offset):
            assert r.bin_offset == end
            end += r.length
        assert end <= 100
        assert len({r.source for r in b}) == len(b)
        clusters = [r.cluster for r in b if r.cluster is not None]
        assert len(set(clusters)) == len(clusters)


def test_empty_table(spark, docs_of):
    assert packing.pack_documents(docs_of([])).collect() == []


def test_conflicts_may_be_left_out(spark, docs_of):
    df = docs_of([(i, f"a{i} b c d e", None, "hot") for i in range(40)])
    size, cluster = packing.word_count(F.col("text")), packing.copy_cluster(F.col("text"))
    alone = packing.pack(df, size, cluster, capacity=100).select("bin_id").distinct().count()
    shared = packing.pack(df, size, cluster, capacity=100, conflicts=("cluster",)).select("bin_id").distinct().count()
    assert (alone, shared) == (40, 2)
