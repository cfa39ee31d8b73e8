"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integer term weights (a term per dimension).  The rows are
ordered so that similar ones are neighbours and cut into document-range
blocks; a block holds its forward index (ids and a dense weight matrix) and a
summary: per term the largest and smallest weight in it, and its smallest id.
For a query, the sum over terms of the larger product is a bound for the whole
block.  Blocks are taken in falling order of their bounds until the bound is
below the query's k-th score so far (at a tie: until no smaller id is left).

Bounds are looked at before any weight moves.  Queries begin with the k-th
score inside their own block.  A first round joins batches of neighbouring
queries with summaries only, and scores the few blocks of highest bound; that
raises the k-th scores.  A second round does the same with the raised ones and
all blocks that still reach them.  In either round a block goes to the batches
that need it and to no other, in cells of (batch of queries) x (group of
blocks), so no task sees all queries or all blocks, whatever their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import hash60, materialize, ship
from lodestar.llm.vectors import from_bytes, matrix, usable

BLOCK = 64  # rows per document-range block
BLOCKS, QUERIES = 256, 512  # blocks and queries per cell
SUMMARIES = 4096  # summaries per cell
HEAD = 4  # blocks per query in the first round
STEP = 4  # blocks that a query scores at first between two looks at its bounds; doubles
PIVOTS = 2048  # rows are ordered by the nearest of at most so many sampled rows
_NONE, _MOST = -(1 << 63), (1 << 63) - 1  # no k-th score yet; no bound


def _reach(a: np.ndarray, b: np.ndarray) -> float:
    """No sum of products of a row of a and a row of b is larger."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest kind of numbers in which sums of their products are exact integers."""
    reach = _reach(a, b)
    return np.float32 if reach < 2.0**24 else np.float64 if reach < 2.0**52 else np.int64


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in exact integers."""
    kind = _exact(a, b)
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No row of a block scores more for the query; products near 64 bits are not bounded."""
    if _reach(q, high) + _reach(q, low) >= 2.0**62:
        return np.full((len(q), len(high)), _MOST)
    return _products(np.maximum(q, 0), high) + _products(np.minimum(q, 0), low)


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score, then smallest id, then row."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((rows[keep], ids[keep], -scores[keep]))[:k]]


def _chain(points: np.ndarray) -> np.ndarray:
    """The points in an order in which each follows its nearest predecessor that is left."""
    left, order = np.arange(len(points)), []
    at = 0
    while len(left):
        order.append(left[at])
        here, left = points[left[at]], np.delete(left, at)
        at = int(((points[left] - here) ** 2).sum(axis=1).argmin()) if len(left) else 0
    return points[order]


def _near(width: int, pivots: np.ndarray):
    """Number of the nearest sampled row, for every row."""
    half = (pivots**2).sum(axis=1) / 2

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = matrix(batch.column("w"), width).astype(np.float64)
            near = (w @ pivots.T - half).argmax(axis=1) if len(pivots) and len(w) else np.zeros(len(w), int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int64())], [*batch.schema.names, "near"])

    return number


_BUILT = ("kind string, part int, nth long, vec_id long, row long, floor long, floor_id long, n int, ids binary, rows binary, "
          "weights binary, high binary, low binary")
_TYPES = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("nth", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()),
                    ("floor", pa.int64()), ("floor_id", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()),
                    ("weights", pa.binary()), ("high", pa.binary()), ("low", pa.binary())])


def _build(width: int, k: int, kind, size: int):
    """Sorted rows of a partition -> its blocks, and its queries with their k-th score and id in their own block.

    A block's vec_id is the smallest one in it."""

    def cut(ids, rows, asks, weights, part: int, nth: int, asked: int) -> list[dict]:
        out = [{"kind": "block", "part": part, "nth": nth, "n": len(ids), "vec_id": int(ids.min()), "ids": ids.tobytes(), "rows": rows.tobytes(),
                "weights": weights.tobytes(), "high": weights.max(axis=0).tobytes(), "low": weights.min(axis=0).tobytes()}]
        at = np.flatnonzero(asks)
        for i, scores in zip(at, _products(weights[at], weights)):
            others = np.delete(np.arange(len(ids)), i)
            best = others[_best(scores[others], ids[others], rows[others], k)]
            floor = (int(scores[best[-1]]), int(ids[best[-1]])) if len(best) == k else (_NONE, _MOST)
            out.append({"kind": "query", "part": part, "nth": asked, "vec_id": int(ids[i]), "row": int(rows[i]),
                        "floor": floor[0], "floor_id": floor[1], "weights": weights[i].tobytes()})
            asked += 1
        return out

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, asked, held = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            more = (batch.column("vec_id").to_numpy(), batch.column("row").to_numpy(),
                    batch.column("asks").to_numpy(zero_copy_only=False).astype(bool), matrix(batch.column("w"), width, kind))
            held = more if held is None else tuple(np.concatenate(x) for x in zip(held, more))
            while len(held[0]) >= size:
                out = cut(*(x[:size] for x in held), part, nth, asked)
                yield pa.RecordBatch.from_pylist(out, _TYPES)
                held, nth, asked = tuple(x[size:] for x in held), nth + 1, asked + len(out) - 1
        if held is not None and len(held[0]):
            yield pa.RecordBatch.from_pylist(cut(*held, part, nth, asked), _TYPES)

    return build


def _reaches(bounds: np.ndarray, least: np.ndarray, floor: np.ndarray, floor_id: np.ndarray) -> np.ndarray:
    """Whether a block may hold a row that comes before the query's k-th."""
    return (bounds > floor) | ((bounds == floor) & (least <= floor_id))


_NEEDS = pa.schema([("qb", pa.int64()), ("query_row", pa.int64()), ("id", pa.int64()), ("bound", pa.int64()), ("least", pa.int64())])


def _look(width: int, kind, head: int | None):
    """Queries of a batch x summaries -> the ``head`` blocks of highest bound of every query, or all blocks any of them needs."""

    def look(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        if not queries.num_rows or not blocks.num_rows:
            return _NEEDS.empty_table()
        row, floor, floor_id = (queries[c].to_numpy() for c in ("row", "floor", "floor_id"))
        number, least = blocks["id"].to_numpy(), blocks["least"].to_numpy()
        bounds = _bounds(from_bytes(queries["weights"], kind, width), *(from_bytes(blocks[c], kind, width) for c in ("high", "low")))
        needs = _reaches(bounds, least, floor[:, None], floor_id[:, None])
        if head is None:
            at = np.flatnonzero(needs.any(axis=0))
            who, bound = np.zeros(len(at), np.int64), bounds[:, at].max(axis=0)
        else:
            order = np.lexsort((np.broadcast_to(least, bounds.shape), -bounds), axis=1)[:, :head]
            i, j = np.nonzero(np.take_along_axis(needs, order, 1))
            at = order[i, j]
            who, bound = row[i], bounds[i, at]
        qb = np.full(len(at), queries["qb"][0].as_py())
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (qb, who, number[at], bound, least[at])], schema=_NEEDS)

    return look


_FOUND = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "vec_id", "row", "score", "scored")])


def _search(width: int, k: int, kind):
    """One cell: best k of every query among the cell's blocks; one more row per query, without vec_id, says how many rows it scored."""

    def search(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        if not queries.num_rows or not blocks.num_rows:
            return _FOUND.empty_table()
        q = from_bytes(queries["weights"], kind, width)
        high, low = (from_bytes(blocks[c], kind, width) for c in ("high", "low"))
        least, sizes = blocks["least"].to_numpy(), blocks["n"].to_numpy()
        ids, rows = (np.frombuffer(b"".join(blocks[c].to_pylist()), np.int64) for c in ("ids", "rows"))
        weights = np.frombuffer(b"".join(blocks["forward"].to_pylist()), kind).reshape(len(ids), width)
        ends = np.cumsum(sizes)
        bounds, fast = _bounds(q, high, low), _exact(q, weights)
        asked, weights = q.astype(fast), weights.astype(fast)
        out = []
        for i, (vec_id, row, floor, floor_id) in enumerate(zip(*(queries[c].to_pylist() for c in ("vec_id", "row", "floor", "floor_id")))):
            found = (np.zeros(0, np.int64),) * 3  # score, id, row
            order = np.lexsort((least, -bounds[i]))
            scored, at, step = 0, 0, STEP
            while at < len(order):
                use = order[at:at + step]
                use = use[_reaches(bounds[i, use], least[use], floor, floor_id)]
                if not len(use):  # no later block reaches more: bounds fall, and ids rise within equal ones
                    break
                pick = np.concatenate([np.arange(ends[b] - sizes[b], ends[b]) for b in use])
                scores = (weights[pick] @ asked[i]).astype(np.int64)
                scored, at, step = scored + len(pick), at + step, 2 * step
                keep = np.flatnonzero((scores >= floor) & (rows[pick] != row))
                merged = tuple(np.concatenate(x) for x in zip(found, (scores[keep], ids[pick[keep]], rows[pick[keep]])))
                best = _best(*merged, k)
                found = tuple(x[best] for x in merged)
                if len(best) == k and (-found[0][-1], found[1][-1]) < (-floor, floor_id):
                    floor, floor_id = int(found[0][-1]), int(found[1][-1])
            out += [{"query_row": row, "query_id": vec_id, "vec_id": v, "row": r, "score": s} for s, v, r in zip(*(x.tolist() for x in found))]
            out.append({"query_row": row, "query_id": vec_id, "scored": scored})
        return pa.Table.from_pylist(out, _FOUND)

    return search


def exact_top_k(rows: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding",
                k: int = 5, scale: int = 256, work: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query row.

    Components x become floor(scale * x); the score is the integer inner
    product and must fit 64 bits.  Candidates are all rows but the query's
    own; ties go to the smaller vec_id.  Rows without an id, without a vector,
    or with null or non-finite components take no part; shorter vectors are
    padded with zeros.  Rows that repeat a vec_id are rows of their own.  An
    empty table gives an empty result; other columns are ignored.  With
    ``work`` a column ``scored`` says how many rows were scored for the query.
    """
    spark = rows.sparkSession
    ship(spark)
    whole = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    used = rows.filter(usable(vec_id, embedding))
    used = used.select(F.col(vec_id).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), whole.alias("w"))
    used = materialize(used.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    facts = used.agg(F.count("*"), F.max(F.size("w")), F.max(F.array_max("w")), F.min(F.array_min("w"))).first()
    width = max(1, facts[1] or 0)
    kind = np.int32 if max(facts[2] or 0, -(facts[3] or 0)) < 1 << 31 else np.int64
    # a bounded sample: orders the rows, decides nothing
    sample = used.orderBy(hash60(F.col("vec_id")), "row").limit(min(PIVOTS, 4 * math.isqrt(facts[0]))).select("w").collect()
    pivots = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        pivots[i, :len(r["w"])] = r["w"]
    ordered = used.mapInArrow(_near(width, _chain(pivots)), "vec_id long, asks boolean, w array<long>, row long, near long")
    ordered = ordered.repartitionByRange(F.col("near"), F.col("vec_id"), F.col("row")).sortWithinPartitions("near", "vec_id", "row")
    built = materialize(ordered.select("vec_id", "row", "asks", "w").mapInArrow(_build(width, k, kind, BLOCK), _BUILT), "topk-blocks")

    # blocks and queries are numbered in their order, so batches and groups hold neighbours
    counts = sorted(map(tuple, built.groupBy("kind", "part").count().collect()))  # two rows per partition
    total, offsets = {"block": 0, "query": 0}, []
    for name, part, n in counts:
        offsets.append((name, part, total[name]))
        total[name] += n
    numbered = built.join(F.broadcast(spark.createDataFrame(offsets, "kind string, part int, before long")), ["kind", "part"])
    numbered = numbered.withColumn("id", F.col("before") + F.col("nth"))
    batch, group, chunk = (F.floor(F.col("id") / n) for n in (QUERIES, BLOCKS, SUMMARIES))
    queries = numbered.filter("kind = 'query'").select(batch.alias("qb"), "vec_id", "row", "floor", "floor_id", "weights")
    blocks = numbered.filter("kind = 'block'").select(
        group.alias("bg"), "id", F.col("vec_id").alias("least"), "n", "ids", "rows", F.col("weights").alias("forward"), "high", "low")
    spread = lambda n, size: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, -(-n // size) - 1)).cast("long")))
    summaries = numbered.filter("kind = 'block'").select(
        spread(total["query"], QUERIES).alias("qb"), chunk.alias("chunk"), "id", F.col("vec_id").alias("least"), "high", "low")

    def needed(asking: DataFrame, head: int | None) -> DataFrame:
        asked = asking.select(spread(total["block"], SUMMARIES).alias("chunk"), "qb", "row", "floor", "floor_id", "weights")
        return asked.groupBy("qb", "chunk").cogroup(summaries.groupBy("qb", "chunk")).applyInArrow(
            _look(width, kind, head), "qb long, query_row long, id long, bound long, least long")

    def searched(asking: DataFrame, needs: DataFrame, name: str) -> DataFrame:
        """``needs``: distinct (qb, id)."""
        sent = needs.join(blocks, "id")
        cells = needs.select("qb", F.floor(F.col("id") / BLOCKS).alias("bg")).distinct()
        found = asking.join(cells, "qb").groupBy("qb", "bg").cogroup(sent.groupBy("qb", "bg")).applyInArrow(
            _search(width, k, kind), "query_row long, query_id long, vec_id long, row long, score long, scored long")
        return materialize(found, name)

    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = lambda found: (found.filter("vec_id is not null").withColumn("rank", F.row_number().over(best))
                            .filter(F.col("rank") <= k))
    first = Window.partitionBy("query_row").orderBy(F.desc("bound"), "least", "id")
    heads = (needed(queries, HEAD).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= HEAD)
             .select("qb", "id").distinct())
    heads = materialize(heads, "topk-heads")
    early = searched(queries, heads, "topk-early")
    kth = ranked(early).filter(F.col("rank") == k).select(
        F.col("query_row").alias("row"), F.col("score").alias("s"), F.col("vec_id").alias("v"))
    raised = (F.col("s") > F.col("floor")) | ((F.col("s") == F.col("floor")) & (F.col("v") < F.col("floor_id")))
    queries = materialize(queries.join(kth, "row", "left").select(
        "qb", "vec_id", "row", F.when(raised, F.col("s")).otherwise(F.col("floor")).alias("floor"),
        F.when(raised, F.col("v")).otherwise(F.col("floor_id")).alias("floor_id"), "weights"), "topk-queries")
    rest = materialize(needed(queries, None).select("qb", "id").distinct().join(heads, ["qb", "id"], "left_anti"), "topk-rest")
    found = early.unionByName(searched(queries, rest, "topk-late"))
    out = ranked(found).select("query_row", "query_id", "rank", "vec_id", "score")
    if work:
        out = out.join(found.groupBy("query_row").agg(F.sum("scored").alias("scored")), "query_row")
    return out.drop("query_row")
