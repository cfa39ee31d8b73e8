"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Classes.  Equal vectors are one node, whatever their number; a node names the
rows of its class by rising vec_id, one more than asked
for, since a row is never its own neighbour.

Build.  Sampled hyperplanes deal the nodes into small leaves (several times);
neighbours inside a leaf start the graph.  Then rounds of NN-descent: every
node introduces its neighbours, forward and reverse, to each other - a Spark
join of neighbours of neighbours - and a pair stays if it beats the worst
neighbour of one of them.  Vectors travel in half precision here.

Search.  Nodes are dealt over shards of bounded expected size, each with its own
graph; (shard) x (block of queries) cells are searched in tasks that hold one
shard, a few queries at once.  Every query keeps a list of the best nodes seen, expands the best
unexpanded ones, and stops when the whole list is expanded.  The whole list is
then scored in double precision on the original vectors, and its best nodes are
expanded to the rows of their classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import hash60, materialize, ship
from lodestar.llm.vectors import dimension, from_bytes, matrix, runs, usable
from lodestar.operators.joins import bounded_broadcast

NEIGHBOURS = 20  # per node of the graph
LEAF, TREES = 200, 3  # expected rows per leaf; leaves per row
ROUNDS = 2  # of NN-descent
JOINED = 12  # neighbours per direction that a node introduces in a round
LIST, EXPAND = 320, 16  # search: list length, nodes expanded at once
SHARD, QUERIES = 1 << 14, 1024  # expected rows per shard and queries per cell
TOGETHER = 128  # queries of a cell searched at once: bounds what is held beside the shard
ENTRIES = 64  # nodes of a shard that a search begins with


def _binary(width: int, unit: float):
    """Vectors as float64 bytes (exact) and, in multiples of ``unit``, as float16 bytes (for the build)."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch.column("e"), width) + 0.0  # -0.0 counts as 0.0: equal vectors get equal bytes
            keep = np.flatnonzero((m != 0).any(axis=1))  # zero vectors take no part
            half = (m[keep] / unit).astype(np.float16)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(keep)), "asks": batch.column("asks").take(pa.array(keep)),
                "v": pa.array([r.tobytes() for r in m[keep]], pa.binary()), "h": pa.array([r.tobytes() for r in half], pa.binary())})

    return convert


def _leaves(planes: np.ndarray, offsets: np.ndarray, width: int):
    """(tree, code) of every row: the sides of that tree's hyperplanes it lies on."""
    trees, bits = planes.shape[:2]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = from_bytes(batch.column("h"), np.float16, width).astype(np.float32)
            for t in range(trees):
                code = ((m @ planes[t].T > offsets[t]) << np.arange(bits, dtype=np.int64)).sum(axis=1) if bits else np.zeros(len(m), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("node", "shard", "h")), pa.array(np.full(len(m), t, np.int64)), pa.array(code.astype(np.int64))],
                    ["node", "shard", "h", "tree", "code"])

    return deal


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("s", pa.float32())])


def _edges(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s.astype(np.float32))], schema=_EDGES)


def _inside(width: int, k: int):
    """Best k neighbours of every row inside its leaf."""

    def best(leaf: pa.Table) -> pa.Table:
        node = leaf["node"].to_numpy()
        m = from_bytes(leaf["h"], np.float16, width).astype(np.float32)
        out = []
        for a in range(0, len(node), 512):
            s = m[a:a + 512] @ m.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
            n = min(k, len(node) - 1)
            top = np.argpartition(-s, n - 1, axis=1)[:, :n] if n > 0 else np.zeros((len(s), 0), int)
            out.append(_edges(np.repeat(node[a:a + 512], n), node[top].ravel(), np.take_along_axis(s, top, 1).ravel()))
        return pa.Table.from_batches(out, _EDGES)

    return best


def _introduce(width: int):
    """Rows (w; u, worst score of u's list, vector of u) sorted by w -> pairs of one w that beat a list."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "w"):
            w, u, worst = (table[c].to_numpy() for c in ("w", "u", "worst"))
            m = from_bytes(table["h"], np.float16, width).astype(np.float32)
            cuts = np.flatnonzero(np.diff(w, prepend=w[0] - 1))
            parts = []
            for a, b in zip(cuts, np.append(cuts[1:], len(w))):
                s = m[a:b] @ m[a:b].T
                i, j = np.nonzero((s > worst[a:b, None]) & (u[a:b, None] != u[a:b]))
                parts.append((u[a:b][i], u[a:b][j], s[i, j]))
            if parts:
                yield _edges(*(np.concatenate(x) for x in zip(*parts)))

    return join


def _closest(edges: DataFrame, k: int) -> DataFrame:
    """The k best distinct neighbours of every node (partial limits before the shuffle)."""
    order = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    unique = edges.groupBy("a", "b").agg(F.max("s").alias("s"))
    return unique.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)


def build_graph(nodes: DataFrame, width: int, k: int = NEIGHBOURS, rounds: int = ROUNDS, leaf: int = LEAF,
                trees: int = TREES) -> DataFrame:
    """Edges (a, b, s, r): the k neighbours found for every node in its shard, r their rank.

    ``nodes``: node long (unique), shard, h binary (float16 vector).  Every
    node with another in its shard is in the graph; a leaf that is much fuller than expected (many equal vectors)
    is dealt over several tasks by hash."""
    rows = nodes.agg(F.count("node"), F.max("shard")).first()
    bits = max(0, math.ceil(math.log2(max(1, rows[0] / ((rows[1] or 0) + 1) / leaf))))
    sample = nodes.orderBy(hash60(F.col("node")), "node").limit(2 * bits * trees).select("h").collect()  # a bounded sample: places hyperplanes
    points = np.array([np.frombuffer(r["h"], np.float16) for r in sample], np.float32).reshape(-1, width)
    while len(points) < 2 * bits * trees:
        points = np.concatenate((points, points))
    points = points[:2 * bits * trees].reshape(trees, bits, 2, width)
    planes = points[:, :, 0] - points[:, :, 1]
    offsets = (planes * (points[:, :, 0] + points[:, :, 1]) / 2).sum(axis=-1)
    dealt = materialize(nodes.select("node", "shard", "h").mapInArrow(
        _leaves(planes, offsets, width), "node long, shard long, h binary, tree long, code long"), "ann-leaves")
    key = ["shard", "tree", "code"]
    # only overfull leaves are split, so the table of splits is small; its size is checked all the same
    full = dealt.groupBy(*key).agg(F.ceil(F.count("node") / (2 * leaf)).alias("split")).filter("split > 1")
    part = F.pmod(F.xxhash64("node", "tree"), F.coalesce("split", F.lit(1)))
    dealt = dealt.join(bounded_broadcast(full), key, "left").withColumn("part", part)
    start = dealt.groupBy(*key, "part").applyInArrow(_inside(width, k), "a long, b long, s float")
    graph = materialize(_closest(start, k), "ann-graph")
    for turn in range(rounds):
        # forward and reverse neighbours that each node introduces; a hub keeps a hashed choice of its reverse ones
        pick = F.xxhash64("a", "b", F.lit(turn))
        forward = graph.withColumn("p", F.row_number().over(Window.partitionBy("a").orderBy(pick))).filter(F.col("p") <= JOINED)
        reverse = graph.withColumn("p", F.row_number().over(Window.partitionBy("b").orderBy(pick))).filter(F.col("p") <= JOINED)
        around = (forward.select(F.col("a").alias("w"), F.col("b").alias("u"))
                  .unionByName(reverse.select(F.col("b").alias("w"), F.col("a").alias("u")))
                  .unionByName(graph.select(F.col("a").alias("w"), F.col("a").alias("u")).distinct()).distinct())
        lists = graph.groupBy("a").agg(F.when(F.count("b") < k, float("-inf")).otherwise(F.min("s")).cast("float").alias("worst"))
        carried = nodes.select("node", "h").join(lists, F.col("node") == F.col("a"))
        pairs = (around.join(carried, F.col("u") == F.col("node")).select("w", "u", "worst", "h")
                 .repartition(F.col("w")).sortWithinPartitions("w").mapInArrow(_introduce(width), "a long, b long, s float"))
        graph = materialize(_closest(graph.select("a", "b", "s").unionByName(pairs), k), "ann-graph")
    return graph


def _beam(adjacent: np.ndarray, points: np.ndarray, asked: np.ndarray, own: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of several queries at once: (positions, scores) of each query's list.

    ``adjacent``: neighbours of every position, -1 for none.  ``own``: the
    query's own position, or -1; a search begins there too."""
    n, q = len(points), len(asked)
    size = min(size, n)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # "no neighbour" counts as seen
    row = np.arange(q)[:, None]

    def score(found: np.ndarray) -> np.ndarray:
        """Scores of positions (q, m); those seen before, and second mentions, get -inf."""
        order = np.argsort(found, axis=1, kind="stable")
        twice = np.zeros_like(found, bool)
        ranked = np.take_along_axis(found, order, 1)
        np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
        out = np.einsum("qd,qmd->qm", asked, points[np.minimum(found, n - 1)])
        out[seen[row, found] | twice] = -np.inf
        seen[row, found] = True
        return out

    first = np.unique(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64))
    nodes = np.broadcast_to(first, (q, len(first))).copy()
    near = np.where(own[:, None] >= 0, adjacent[own], n)  # a query that is in the graph also begins with its neighbours
    nodes = np.concatenate((nodes, np.where(near < 0, n, near), np.where(own < 0, n, own)[:, None]), axis=1)
    scores = score(nodes)
    done = np.isneginf(scores)
    active = np.arange(q)
    result_nodes, result_scores = np.full((q, size), -1, np.int64), np.full((q, size), -np.inf, np.float32)
    while True:
        best = np.argsort(-scores, axis=1, kind="stable")[:, :size]
        nodes, scores, done = (np.take_along_axis(x, best, 1) for x in (nodes, scores, done))
        open_ = ~done.all(axis=1)
        for part in np.flatnonzero(~open_):
            result_nodes[active[part], :nodes.shape[1]], result_scores[active[part], :nodes.shape[1]] = nodes[part], scores[part]
        if not open_.any():
            return result_nodes, result_scores
        if not open_.all():
            nodes, scores, done, seen, asked, active = (x[open_] for x in (nodes, scores, done, seen, asked, active))
            row = np.arange(len(active))[:, None]
        turn = np.argsort(done, axis=1, kind="stable")[:, :EXPAND]  # best unexpanded ones
        use = ~np.take_along_axis(done, turn, 1)
        np.put_along_axis(done, turn, True, 1)
        at = np.take_along_axis(nodes, turn, 1)
        found = np.where(use[:, :, None], adjacent[at], -1).reshape(len(active), -1)
        found[found < 0] = n
        new = score(found)
        nodes, scores = np.concatenate((nodes, found), axis=1), np.concatenate((scores, new), axis=1)
        done = np.concatenate((done, np.isneginf(new)), axis=1)


def _search(width: int, k: int, size: int, unit: float):
    """One cell: the k nearest rows found in a shard for every query of a block."""

    def padded(lists: pa.ChunkedArray) -> np.ndarray:
        """Rows of a list column, -1 after their ends."""
        lists = lists.combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        out = np.full((len(lists), max(1, lengths.max(initial=0))), -1, np.int64)
        out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
        return out

    def search(queries: pa.Table, shard: pa.Table) -> pa.Table:
        if not queries.num_rows or not shard.num_rows:
            return _FOUND.empty_table()
        shard = shard.sort_by("node")
        node, ids, rows, near = shard["node"].to_numpy(), padded(shard["ids"]), padded(shard["rows"]), padded(shard["near"])
        exact = from_bytes(shard["v"], np.float64, width)
        adjacent = np.where(near < 0, -1, np.searchsorted(node, near))
        points = (exact / unit).astype(np.float32)
        return pa.concat_tables([found(queries.slice(a, TOGETHER), node, ids, rows, exact, points, adjacent)
                                 for a in range(0, queries.num_rows, TOGETHER)])

    def found(queries: pa.Table, node: np.ndarray, ids: np.ndarray, rows: np.ndarray, exact: np.ndarray,
              points: np.ndarray, adjacent: np.ndarray) -> pa.Table:
        """The k nearest rows found for each of a few queries."""
        q, asked = queries["q"].to_numpy(), from_bytes(queries["x"], np.float64, width)
        own = np.searchsorted(node, q)
        own = np.where((own < len(node)) & (node[np.minimum(own, len(node) - 1)] == q), own, -1)
        at, near = _beam(adjacent, points, (asked / unit).astype(np.float32), own, max(size, 2 * k))
        at = np.where(np.isneginf(near), -1, at)
        with np.errstate(over="ignore", invalid="ignore"):  # products beyond double precision: infinite, or no number
            scores = np.stack([(x * exact[a]).sum(axis=1) for x, a in zip(asked, at)])  # single precision may swap near ties
        # the best k rows are of the best k classes, in the order of their first rows
        order = np.lexsort((rows[at, 0], ids[at, 0], -_ranked(scores), at < 0), axis=1)[:, :k]
        at, scores = np.take_along_axis(at, order, 1), np.take_along_axis(scores, order, 1)
        member, named = np.where(at[:, :, None] < 0, -1, rows[at]), ids[at]
        scores = np.broadcast_to(scores[:, :, None], member.shape)
        member, named, scores = (x.reshape(len(q), -1) for x in (member, named, scores))
        order = np.lexsort((member, named, -_ranked(scores), member < 0), axis=1)[:, :k]
        member, named, scores = (np.take_along_axis(x, order, 1) for x in (member, named, scores))
        keep = member >= 0
        pick = np.broadcast_to(np.arange(len(q))[:, None], member.shape)[keep]
        return pa.Table.from_arrays([pa.array(q[pick]), pa.array(member[keep]), pa.array(named[keep]), pa.array(scores[keep])], schema=_FOUND)

    return search


def _ranked(scores: np.ndarray) -> np.ndarray:
    """Scores to sort by: what is no number comes behind all numbers."""
    return np.where(np.isnan(scores), -np.inf, scores)


_FOUND = pa.schema([(c, pa.int64()) for c in ("q", "row", "vec_id")] + [("s", pa.float64())])


def greedy_search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, width: int, k: int, size: int = LIST,
                  unit: float = 1.0) -> DataFrame:
    """(q, row, vec_id, s): up to k rows per query and shard.

    ``nodes``: node, shard, v (float64 bytes), ids and rows (vec_id and row
    number of the members of its class by rising vec_id, k of them if there are
    as many); ``queries``: q, x (float64 bytes; a q that is a node begins at
    itself and its neighbours); ``unit``: single precision holds multiples of it.  A node is entered through its neighbours and through up to as
    many nodes that name it as neighbour."""
    named = Window.partitionBy("b").orderBy(F.desc("s"), "a")
    back = graph.withColumn("p", F.row_number().over(named)).filter(F.col("p") <= NEIGHBOURS)
    near = (graph.select("a", "b").unionByName(back.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .groupBy("a").agg(F.collect_set("b").alias("near")))  # at most two lists of bounded length
    held = nodes.join(near, nodes["node"] == near["a"], "left").select(
        "shard", "node", "ids", "rows", "v", F.coalesce("near", F.array().cast("array<long>")).alias("near"))
    held = materialize(held, "ann-index")
    shards = (nodes.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = -(-queries.count() // QUERIES) or 1
    asked = queries.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInArrow(
        _search(width, k, size, unit), "q long, row long, vec_id long, s double")


def nearest_neighbours(rows: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding",
                       k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest candidates found per query row.

    Nearness is the inner product, in double precision on the original
    vectors.  Candidates are all rows but the query's own.  Every distinct
    vector is indexed, and a class of equal vectors, of any size, is found or
    missed as a whole: its rows come by rising vec_id.  All that a query finds
    is ranked, and ties go to the smaller vec_id.  Rows without an id or vector, with
    null or non-finite components, or with only zeros take no part; shorter
    vectors are padded with zeros.  Rows that repeat a vec_id are rows of
    their own.  An empty table gives an empty result; other columns are ignored.
    The size of the values does not matter: the build and the search work on
    multiples of the table's largest component.  A score beyond double
    precision is infinite, or no number (such rows come last, by vec_id).
    """
    ship(rows.sparkSession)
    used = rows.filter(usable(vec_id, embedding)).select(
        F.col(vec_id).cast("long").alias("vec_id"), is_query.alias("asks"),
        F.transform(F.col(embedding), lambda x: x.cast("double")).alias("e"))
    width = max(1, dimension(used, "e"))
    largest = used.agg(F.max(F.array_max(F.transform("e", F.abs)))).first()[0] or 1.0
    unit = 2.0 ** math.floor(math.log2(largest)) if largest > 1e-300 else largest  # a power of two: dividing by it is exact
    stored = used.mapInArrow(_binary(width, unit), "vec_id long, asks boolean, v binary, h binary")
    stored = materialize(stored.withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    # k rows of a class can be asked for besides the query's own (partial limits before the shuffle)
    claim = Window.partitionBy("v").orderBy("vec_id", "row")
    members = stored.withColumn("r", F.row_number().over(claim)).filter(F.col("r") <= k + 1)
    classes = members.groupBy("v").agg(F.first("h").alias("h"), F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("m"))
    nodes = materialize(classes.select(
        F.col("m")[0]["row"].alias("node"), "v", "h", F.col("m.vec_id").alias("ids"), F.col("m.row").alias("rows")), "ann-classes")
    shards = max(1, math.ceil(nodes.count() / SHARD))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("long"))
    graph = build_graph(nodes, width, max(k, NEIGHBOURS))
    asking = stored.filter("asks").select(F.col("vec_id").alias("query_id"), F.col("row").alias("self"), "v")
    asking = materialize(asking.join(nodes.select("v", F.col("node").alias("of")), "v").select("query_id", "self", "of"), "ann-queries")
    queries = nodes.join(asking.select(F.col("of").alias("node")).distinct(), "node", "left_semi")
    found = greedy_search(graph, nodes, queries.select(F.col("node").alias("q"), F.col("v").alias("x")), width, k + 1, unit=unit)
    ranked = F.when(F.isnan("s"), float("-inf")).otherwise(F.col("s"))
    best = Window.partitionBy("q").orderBy(ranked.desc(), "vec_id", "row")
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    # the queries of one class share its answer, each without itself: at most one of its k + 1 rows
    answers = asking.join(found, (F.col("of") == F.col("q")) & (F.col("self") != F.col("row")))
    order = Window.partitionBy("self").orderBy("r")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.col("s").alias("score"))
