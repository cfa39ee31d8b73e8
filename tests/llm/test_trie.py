import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lodestar.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuilt=True):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in convs.items()}
    if rebuilt:
        full = {}
        for c in convs:
            h = zlib.crc32(str(c).encode()) % 9
            base = c - (c % 5 if c >= 0 else -(-c % 5))
            full[c] = convs.get(base, [])[:h] + convs[c][h:]
        convs = full
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        childless = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0) for p in below)
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in below), len(childless), saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, shard=trie.SHARD, rebuilt=True, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for c in ("pos", "name", "bytes", "shard", "at", "key"):  # names the operator uses itself
        df = df.withColumn(c, F.lit("x"))
    turns = trie.numbered_turns(df).checkpoint()
    turns, ids = trie.rebuild(turns) if rebuilt else (turns, turns.select("conv_id").distinct())
    return sorted((tuple(r) for r in trie.prefix_trie(turns, ids, shard).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for c in [*range(40), -3, -7, 1000]:
        for t in range(rng.randint(1, 6)):
            out.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", None, "", "b" * 3000])))
    out += [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(4)]  # a large group of equal conversations
    return [*out, (None, 0, "user", "no id"), (None, None, None, None)]


@pytest.mark.parametrize("shard", [4, 64, trie.SHARD])
def test_rebuilt_against_brute_force(spark, rows, shard):
    assert run(spark, rows, shard, parts=shard % 5 + 1) == brute(rows)


def test_plain_trie_long_and_repeated(spark):
    rows = [(1, t, "user", str(t)) for t in range(1500)] + [(2, t, "user", str(t)) for t in range(900)]
    rows += [(3, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, "user", "x"), (4, 1, "user", "x")]  # one turn number twice
    got = run(spark, rows, shard=500, rebuilt=False)
    assert len(got) == 1 + 1500 + 2
    by = {(r[0], r[1]): r for r in got}
    assert by[1, 0][3:6] == (4, 2, 2) and by[1, 900][3:5] == (2, 1) and by[1, 901][3] == 1
    assert by[3, 2][3] == 2 and by[3, 2][7] == hashlib.sha256(b"3,4").hexdigest()
    assert by[1, 0][6] == sum(len(str(t)) for t in range(900)) + 2


def test_roles_and_texts_do_not_run_together(spark):
    assert len(run(spark, [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, None, "abc")], rebuilt=False)) == 4


def test_empty_and_turnless(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "a", "b")]) == []
    # a conversation that loses all turns is a member, and an end, of the root
    lost = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][0]
    assert run(spark, [(lost, 0, "user", "x")]) == brute([(lost, 0, "user", "x")])
    assert brute([(lost, 0, "user", "x")])[0][1:4] == (0, None, 1)
