import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import suffixes

SMALL = {"PIECE": 512, "HASHED": 300, "SORTED": 200, "HOT": 6, "PART_BYTES": 4096}


def brute(rows, span):
    """Removed bytes by comparing every window with all windows of smaller documents."""
    order = [(float("inf") if i is None else i, i, (t or "").encode()) for i, t in rows]
    first = {}
    for key, _, body in order:
        for p in range(len(body) - span + 1):
            s = body[p:p + span]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, i, body in order:
        gone = np.zeros(len(body), bool)
        for p in range(len(body) - span + 1):
            if first[body[p:p + span]] < key:
                gone[p:p + span] = True
        runs = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        out.append((i, len(body), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for c in ("doc", "h", "spans", "whole", "codes", "bucket", "kept"):  # names the operator uses itself
        df = df.withColumn(c, F.lit(1))
    return df


def run(spark, rows, span=50, parts=3):
    return sorted((tuple(r) for r in suffixes.remove_repeats(frame(spark, rows, parts), span=span).collect()), key=str)


@pytest.fixture()
def small(spark, monkeypatch):
    """Pieces, runs and groups so small that every path is taken."""
    for name, value in SMALL.items():
        monkeypatch.setattr(suffixes, name, value)


def texts(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(9, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 5))]
        rows.append((i * 7 % n, " | ".join(parts)))
    whole = [(200 + k, rows[3][1] or passages[0]) for k in range(12)]  # a large group of equal documents
    near = [(300 + k, passages[0] + f" {k} " + passages[1]) for k in range(25)]  # and of near copies
    odd = [(400, None), (401, ""), (402, "x" * 49), (403, "x" * 50), (404, "x" * 700), (405, "ab" * 300 + "x" * 60), (406, "\0" * 80 + "end"),
           (407, "\0" * 79), (408, "é" * 300), (None, passages[2]), (None, passages[2] * 2), (5, passages[3]), (5, passages[3]), (-4, passages[1][5:])]
    return rows + whole + near + odd


@pytest.mark.parametrize("span,parts", [(50, 3), (20, 5)])
def test_against_brute_force(spark, span, parts):
    rows = texts(span)
    assert run(spark, rows, span, parts) == brute(rows, span)


def test_kernels_in_small_pieces(small):
    """The chain of kernels without Spark: many runs, merges, hot seeds, long texts cut into pieces."""
    import pyarrow as pa

    span, seed, bits = 50, suffixes.seed_length(50), 3
    rows = [(i if i is not None else suffixes._LAST, t or "") for i, t in texts(7, 90)] + [(900, "q " + "long text of many pieces " * 200), (901, os.urandom(800).hex() * 3)]
    batches = lambda extra={}: [pa.RecordBatch.from_pydict(
        {"doc": [r[0] for r in rows[a:a + 40]], "h": [hash(r) for r in rows[a:a + 40]], "text": [r[1] for r in rows[a:a + 40]],
         **{k: v[a:a + 40] for k, v in extra.items()}}) for a in range(0, len(rows), 40)]
    hashed = [b for b in suffixes._hash_runs(span, seed, bits)(iter(batches()))]
    flat = pa.Table.from_batches(hashed).sort_by("bucket").to_batches()
    found = pa.Table.from_batches(list(suffixes._shared_seeds(iter(flat)))).to_pylist()
    hot = {r["code"] for r in found if r["h"] is None}
    assert hot
    codes = {}
    for r in found:
        if r["h"] is not None:
            codes.setdefault(r["h"], []).append(2 * r["code"] + (r["code"] in hot))
    lists = pa.array([codes.get(hash(r), []) for r in rows], pa.list_(pa.int64()))
    named = batches({"codes": lists})
    keys = [r for b in suffixes._sample(span, seed, bits, 3)(iter(named)) for r in b.to_pylist()]
    cuts = {k: np.unique(np.array(sorted(r["key"] for r in keys if r["kind"] == k)[::9], f"S{w}")) for k, w in ((0, seed), (1, span))}
    assert all(len(c) > 2 for c in cuts.values())
    runs = pa.Table.from_batches(list(suffixes._suffix_runs(span, seed, bits, cuts)(iter(named)))).sort_by("part")
    assert runs.num_rows > 100
    spans = {}
    for b in suffixes._merged(span, seed)(iter(runs.to_batches(max_chunksize=7))):
        for r in b.to_pylist():
            spans.setdefault((r["doc"], r["h"]), []).append(r["spans"])
    want = brute(rows, span)
    got = []
    for doc, text in rows:
        body, gone = text.encode(), np.zeros(len(text.encode()), bool)
        for s in spans.get((doc, hash((doc, text))), []):
            for a, b in np.frombuffer(s, "<u4").reshape(-1, 2):
                gone[a:b] = True
        n = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        got.append((doc, len(body), int(gone.sum()), n, hashlib.sha256(bytes(np.frombuffer(body, np.uint8)[~gone])).hexdigest()))
    assert sorted(got, key=str) == want


def test_loser_tree_never_compares_known_bytes():
    rng = random.Random(3)

    class Read(bytes):
        seen = 0

        def __getitem__(self, at):
            Read.seen += len(self) - at.start
            return bytes.__getitem__(self, at)

    runs = [sorted(Read("".join(rng.choice("ab") for _ in range(40)).encode()) for _ in range(rng.randint(0, 60))) for _ in range(9)]
    plain = [np.frombuffer(b"".join(r), np.uint8).reshape(-1, 40) for r in runs]
    taken, common = suffixes.merge_runs(runs, [suffixes._common(p).tolist() for p in plain])
    at, merged = [0] * 9, []
    for r in taken:
        merged.append(bytes(runs[r][at[r]]))
        at[r] += 1
    assert merged == sorted(bytes(x) for r in runs for x in r)
    assert common == suffixes._common(np.frombuffer(b"".join(merged), np.uint8).reshape(-1, 40)).tolist()
    for known in (1, 20, 39):  # two runs that are known to share bytes are read behind them only
        Read.seen = 0
        one, two = Read(b"a" * known + b"b" * (40 - known)), Read(b"a" * known + b"c" * (40 - known))
        suffixes.merge_runs([[Read(b"a" * 40), one], [Read(b"a" * 40), two]], [[0, known], [0, known]])
        assert Read.seen == 2 * 40 + 2 * (40 - known)
    assert suffixes.merge_runs([], []) == ([], []) and suffixes.merge_runs([[], [b"x"]], [[], [0]]) == ([1], [0])


def test_kept_texts_and_empty_tables(spark):
    rows = [(1, "a passage that is long enough to be found again, surely so"), (2, "before: a passage that is long enough to be found again, surely so :after"), (3, "none"), (4, None),
            (5, "a passage that is long enough to be found again, surely so")]
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(frame(spark, rows), with_text=True).collect()}
    assert kept == {1: rows[0][1].encode(), 2: b"before: " + b" :after", 3: b"none", 4: b"", 5: b""}
    assert run(spark, []) == [] and run(spark, [(1, None)]) == brute([(1, None)], 50)


def test_spans_leave_the_merge_packed(spark, small, monkeypatch):
    """Rows that the merge hands on do not grow with parts times documents; a document's spans come as one row."""
    rows, stages = texts(5, 120), {}
    real_write = suffixes.materialize
    monkeypatch.setattr(suffixes, "materialize", lambda df, name="stage": stages.setdefault(name, real_write(df, name)))
    assert run(spark, rows) == brute(rows, 50)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = stages["suffix-spans"]
    assert spans.count() == spans.select("doc", "h").distinct().count() > 3 * buckets
    part = [{"doc": [d], "h": [d * 7919 - 300_000], "spans": [np.array([d, d + 60], "<u4").tobytes()]} for d in range(100)]
    table = pa.concat_tables([pa.Table.from_pydict(p) for p in part]).combine_chunks()
    packed = [b for _ in range(3) for b in suffixes._packed(iter, 8)(iter(table.to_batches()))]
    assert sum(b.num_rows for b in packed) == 3 * 8  # three parts, eight buckets, a hundred documents in each
    back = [r for b in suffixes._by_document(iter(pa.Table.from_batches(packed).sort_by("bucket").to_batches())) for r in b.to_pylist()]
    assert sorted(back, key=lambda r: r["doc"]) == table.to_pylist()
