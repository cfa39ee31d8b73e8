"""Models fitted by plain aggregations, the same on every layout.

Spark ML's estimators draw from partitions, so their results change with files,
settings and cores.  Here whatever is drawn is drawn from a hash of the row's
key, sums that steer a model are sums of integers, and every choice has a tie
rule: one table gives one model.  What is collected is the model (centres,
splits), never rows.
"""

from __future__ import annotations

import functools
import hashlib
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.fixed import ALS_MAX_ITER, ALS_REG_PARAM, KMEANS_K
from lodestar.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS
from lodestar.session import materialize, scratch_path

# --- k-means (M12) --------------------------------------------------------------------------------------------


def _squares(features: Sequence[str], centre: Sequence[int]) -> Column:
    return sum(((F.col(c) - F.lit(int(v))) * (F.col(c) - F.lit(int(v))) for c, v in zip(features, centre)), F.lit(0).cast("long"))


def nearest_centre(features: Sequence[str], centres: Sequence[Sequence[int]]) -> Column:
    """Number of the nearest centre, the first of equally near ones."""
    far = F.array(*[_squares(features, c) for c in centres])
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def kmeans_centres(rows: DataFrame, keys: Sequence[str], features: Sequence[str], k: int = KMEANS_K,
                   iterations: int = 10) -> list[list[int]]:
    """Centres of k-means over integer features (fixed-point numbers below about 2^30).

    The first centre is the row whose key has the least hash, every further
    one the row farthest from the centres so far (ties by the larger hash);
    then ``iterations`` rounds of Lloyd.  Each step is one aggregation with a
    row per centre; sums are of integers and means are rounded to integers, so
    neither partitions nor their order change a digit.  A centre that loses all
    rows stays.  Fewer distinct rows than ``k`` give equal centres; no rows give none."""
    # rows of one key are told apart by their features; rows equal in both are the same point
    name = F.md5(F.encode(F.concat_ws("-", *[F.col(c).cast("string") for c in (*keys, *features)]), "UTF-8"))
    point = F.struct(*features)
    first = rows.agg(F.min_by(point, name)).first()[0]
    if first is None:
        return []
    centres = [list(first)]
    while len(centres) < k:
        far = F.array_min(F.array(*[_squares(features, c) for c in centres], F.lit(1 << 62).cast("long")))
        centres.append(list(rows.agg(F.max_by(point, F.struct(far, name))).first()[0]))
    for _ in range(iterations):
        sums = rows.groupBy(nearest_centre(features, centres).alias("c")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{i}") for i, c in enumerate(features)]).collect()
        moved = [list(c) for c in centres]
        for r in sums:
            moved[r["c"]] = [(2 * int(r[f"s_{i}"]) + r["n"]) // (2 * r["n"]) for i in range(len(features))]
        if moved == centres:
            break
        centres = moved
    return centres


# --- trees (M11, M13) -----------------------------------------------------------------------------------------

BINS = 32


def bin_edges(rows: DataFrame, features: str, bins: int = BINS) -> tuple[list[float], list[float]]:
    """Smallest value of every feature and width of its bins (one aggregation, a row per feature)."""
    spans = rows.select(F.posexplode(features).alias("f", "x")).groupBy("f").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    found = {r["f"]: (float(r["low"]), (float(r["high"]) - float(r["low"])) / bins) for r in spans.collect()}
    return [found[f][0] for f in sorted(found)], [found[f][1] for f in sorted(found)]


def binned(features: str, low: Sequence[float], width: Sequence[float], bins: int = BINS) -> Column:
    """Bin number (0 .. bins - 1) of every feature; values beyond the edges are in the outer bins."""
    edges = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(w).alias("w")) for a, w in zip(low, width)])
    number = lambda x, e: F.when(e["w"] > 0, F.floor((x.cast("double") - e["a"]) / e["w"])).otherwise(F.lit(0).cast("long"))
    return F.zip_with(features, edges, lambda x, e: F.greatest(F.lit(0), F.least(F.lit(bins - 1), number(x, e))).cast("int"))


def row_weight(key: Column, tree: Column) -> Column:
    """Poisson(1) count of a row in a tree's sample, drawn from a hash of both."""
    digits = F.substring(F.md5(F.encode(F.concat_ws("-", key.cast("string"), tree.cast("string")), "UTF-8")), 1, 8)
    u = F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))
    return sum(((u >= F.lit(sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)))).cast("int") for i in range(8)), F.lit(0))


def chosen_features(tree: int, node: int, d: int, m: int) -> list[int]:
    """The features that a node may split on: those with the least hashes."""
    return sorted(sorted(range(d), key=lambda f: hashlib.md5(f"{tree}-{node}-{f}".encode()).hexdigest())[:m])


def best_split(counts: np.ndarray, features: Sequence[int]) -> tuple[int, int] | None:
    """(feature, bin) of the best split ``bin <= b`` of one node, None if none makes the node purer.

    ``counts``: weights by feature, bin and class (integers).  Purity is
    compared as sum of squared class weights over side weights, as exact
    fractions; ties go to the smaller feature, then the smaller bin."""
    best = None
    for i, f in enumerate(features):
        left = np.cumsum(counts[i], axis=0)
        whole = left[-1]
        n = int(whole.sum())
        for b in range(len(left) - 1):
            a, nl = left[b], int(left[b].sum())
            if not 0 < nl < n:
                continue
            c, nr = whole - a, n - nl
            top = sum(int(v) ** 2 for v in a) * nr + sum(int(v) ** 2 for v in c) * nl, nl * nr  # of the two sides together
            if top[0] * n > sum(int(v) ** 2 for v in whole) * top[1] and (best is None or top[0] * best[0][1] > best[0][0] * top[1]):
                best = (top, f, b)
    return best and best[1:]


def _walk(bins: str, trees: int, depth: int, steps: int, feature: list[int], cut: list[int]) -> list[Column]:
    """Node of a row in every tree after so many steps (1: root; children 2n, 2n + 1); a leaf keeps its rows."""
    size = 1 << (depth + 1)
    turns = F.sequence(F.lit(1), F.lit(steps)) if steps else F.array().cast("array<int>")

    def walk(t: int) -> Column:
        f_, c_ = (F.array(*map(F.lit, x[t * size:(t + 1) * size])) for x in (feature, cut))

        def down(node: Column, _: Column) -> Column:
            f = F.element_at(f_, node + 1)
            return F.when(f < 0, node).otherwise(node * 2 + (F.element_at(F.col(bins), f + 1) > F.element_at(c_, node + 1)).cast("int"))

        return F.aggregate(turns, F.lit(1), down)

    return [walk(t) for t in range(trees)]


def grow_forest(rows: DataFrame, key: str, label: str, bins: str, d: int, trees: int = 1, depth: int = 5,
                per_node: int | None = None, sample: bool = False, n_bins: int = BINS) -> dict:
    """A forest of classification trees, all trees level by level together.

    ``rows``: key, label (any type), bins (array of bin numbers).  A level is
    one aggregation to (tree, node, feature, bin, label) weights, combined
    map-side, and one choice per node from its own histogram.  ``sample``
    weighs rows by a Poisson draw from (key, tree); ``per_node`` features are
    hashed per node (default: all).  A node of one class, or one that no split
    makes purer, is a leaf; a leaf predicts its heaviest label, the smallest of
    equals.  Returns the model: splits and leaf labels, at most
    trees x 2^(depth + 1) numbers.  No rows give a model without trees."""
    size = 1 << (depth + 1)
    feature, cut, answer = [-1] * (trees * size), [0] * (trees * size), [None] * (trees * size)
    weighed = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: row_weight(F.col(key), t) if sample else F.lit(1))
    held = materialize(rows.select(key, F.col(label).alias("label"), F.col(bins).alias("bins"), weighed.alias("w")), "forest-rows")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        t, node = int(pdf["t"].iloc[0]), int(pdf["node"].iloc[0])
        classes = np.unique(pdf["label"].to_numpy())
        some = chosen_features(t, node, d, per_node) if per_node else list(range(d))
        place = {f: i for i, f in enumerate(some)}
        counts = np.zeros((len(some), n_bins, len(classes)), np.int64)
        for f, b, c, n in zip(pdf["f"], pdf["b"], np.searchsorted(classes, pdf["label"].to_numpy()), pdf["n"]):
            if f in place:
                counts[place[f], b, c] += n
        split = best_split(counts, some) if node < size // 2 else None
        heavy = classes[counts[0].sum(axis=0).argmax()]
        return pd.DataFrame({"t": [t], "node": [node], "f": [split[0] if split else -1], "b": [split[1] if split else 0], "label": [heavy]})

    kind = held.schema["label"].dataType.simpleString()
    for level in range(depth + 1):
        at = held.select("label", "bins", F.posexplode(F.arrays_zip(F.array(*_walk("bins", trees, depth, level, feature, cut)).alias("node"), F.col("w").alias("w"))).alias("t", "z"))
        at = at.filter((F.col("z.w") > 0) & (F.col("z.node") >= (1 << level)))
        if level == depth:  # the last level only needs its labels
            at = at.withColumn("bins", F.slice("bins", 1, 1))
        hist = at.select("label", "t", F.col("z.node").alias("node"), F.col("z.w").alias("w"), F.posexplode("bins").alias("f", "b"))
        hist = hist.groupBy("t", "node", "f", "b", "label").agg(F.sum("w").cast("long").alias("n"))
        if level == depth:
            weights = hist.groupBy("t", "node", "label").agg(F.sum("n").alias("n"))
            heavy = weights.groupBy("t", "node").agg(F.max("n").alias("n"))
            found = weights.join(heavy, ["t", "node", "n"]).groupBy("t", "node").agg(
                F.min("label").alias("label"), F.lit(-1).alias("f"), F.lit(0).alias("b")).collect()
        else:
            found = hist.groupBy("t", "node").applyInPandas(choose, f"t int, node int, f int, b int, label {kind}").collect()
        for r in found:
            i = r["t"] * size + r["node"]
            feature[i], cut[i], answer[i] = r["f"], r["b"], r["label"]
        if all(r["f"] < 0 for r in found):
            break
    return {"trees": trees, "depth": depth, "feature": feature, "cut": cut, "label": answer, "type": kind}


def forest_predict(rows: DataFrame, model: dict, bins: str, output: str = "prediction") -> DataFrame:
    """``rows`` with the label that most trees give, the smallest of equals (null if the model has no tree)."""
    size = 1 << (model["depth"] + 1)
    nodes = _walk(bins, model["trees"], model["depth"], model["depth"], model["feature"], model["cut"])
    answers = [F.array(*[F.lit(x).cast(model["type"]) for x in model["label"][t * size:(t + 1) * size]]) for t in range(model["trees"])]
    votes = F.array(*[F.element_at(a, n + 1) for a, n in zip(answers, nodes)])
    tally = F.transform(F.array_sort(F.array_distinct(votes)), lambda v: F.struct(
        (-F.size(F.filter(votes, lambda x: x == v))).alias("n"), v.alias("v")))
    return rows.withColumn(output, F.array_min(tally).getField("v"))


# --- alternating least squares (M14) --------------------------------------------------------------------------

HOT_KEYS = 10_000
BUCKET_KEYS = 2_000_000  # keys whose factors are one task's hash table


def start_factors(keys: DataFrame, key: str, rank: int) -> DataFrame:
    """(key, v): a unit vector of positive numbers per key, from hashes of the key."""
    digits = [F.substring(F.md5(F.encode(F.concat_ws("-", F.col(key).cast("string"), F.lit(i)), "UTF-8")), 1, 8) for i in range(rank)]
    raw = F.array(*[(F.conv(x, 16, 10).cast("double") + 0.5) / float(1 << 32) for x in digits])
    out = keys.select(key, raw.alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return out.select(key, F.transform("v", lambda x: x / length).alias("v"))


def _key_counts(pairs: DataFrame, by: str, total: int) -> tuple[DataFrame, int, DataFrame, int]:
    """The keys with their numbers of ratings, how many keys there are, and those that hold at least
    1 / HOT_KEYS of the ratings (at most HOT_KEYS of them) with their number."""
    counts = materialize(pairs.groupBy(by).agg(F.count(F.lit(1)).alias("n")), "als-counts")
    hot = counts.filter(F.col("n") * HOT_KEYS >= total).select(by)
    return counts, counts.count(), hot, hot.count()


def _may_broadcast(n: int, rank: int) -> bool:
    """Whether ``n`` factors keep the bounds of a broadcast."""
    return n <= DEFAULT_BROADCAST_ROWS and n * 8 * (rank + 2) <= DEFAULT_BROADCAST_BYTES


def _with_factors(pairs: DataFrame, known: DataFrame, by: str, hot: DataFrame, others: bool) -> DataFrame:
    """Ratings with the factors of their ``by`` keys: frequent keys by broadcast (a bounded number), the rest by shuffle."""
    hot = F.broadcast(hot)
    joined = pairs.join(F.broadcast(known.join(hot, by)), by)
    return joined.unionByName(pairs.join(hot, by, "left_anti").join(known, by)) if others else joined


def _solved(joined: DataFrame, ask: str, rank: int, reg: float) -> DataFrame:
    """Factors of the ``ask`` keys from ratings with the other side's factors: one aggregation and small solves.

    Every rating adds its part of the normal equations (the upper triangle of
    v v', and r v); parts are summed map-side, so a key with a third of all
    ratings arrives as one row per task.  The regularisation grows with the
    key's number of ratings."""
    upper = [(i, j) for i in range(rank) for j in range(i, rank)]
    v = F.col("v")
    sums = joined.groupBy(ask).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(v[i] * v[j]).alias(f"a{i}_{j}") for i, j in upper],
        *[F.sum(F.col("rating") * v[i]).alias(f"b{i}") for i in range(rank)])
    parts = sums.select(ask, "n", F.array(*[F.col(f"a{i}_{j}") for i, j in upper]).alias("a"), F.array(*[F.col(f"b{i}") for i in range(rank)]).alias("b"))
    row, column = np.array(upper).T

    @F.pandas_udf("array<double>")
    def solve(n: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(n):
            return pd.Series([], dtype=object)
        whole = np.zeros((len(n), rank, rank))
        whole[:, row, column] = whole[:, column, row] = np.stack(a.to_numpy())
        whole[:, range(rank), range(rank)] += reg * n.to_numpy()[:, None]
        return pd.Series(list(np.linalg.solve(whole, np.stack(b.to_numpy())[:, :, None])[:, :, 0]))

    return parts.select(ask, solve("n", "a", "b").alias("v"))


def als_factors(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating", rank: int = 10,
                iterations: int = ALS_MAX_ITER, reg: float = ALS_REG_PARAM) -> tuple[DataFrame, DataFrame]:
    """User and item factors (key, v) of least squares by turns, for keys of any type and number.

    Starts from hashed item factors; each half step is written as a table (see ``_dealt``).
    Rows with a null key or rating take no part; a pair rated twice counts twice."""
    if reg <= 0:
        raise ValueError("reg must be positive: it keeps the normal equations solvable")
    pairs = ratings.filter(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(rating).isNotNull())
    pairs = materialize(pairs.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("rating")), "als-ratings")
    total = pairs.count()
    known = {by: _key_counts(pairs, by, total) for by in ("user", "item")}
    many, few = ("user", "item") if known["user"][1] >= known["item"][1] else ("item", "user")
    users, items = None, start_factors(known["item"][0].select("item"), "item", rank)
    with _dealt(pairs, many, few, known, rank, reg) as solved:
        for _ in range(iterations):
            users = materialize(solved("user", items), "als-users")
            items = materialize(solved("item", users), "als-items")
    return users, items


@contextmanager
def _dealt(pairs: DataFrame, many: str, few: str, known: dict, rank: int, reg: float) -> Iterator[Callable[[str, DataFrame], DataFrame]]:
    """A half step, ``solved(ask, other side's factors)``, on ratings that are dealt once, by the side with more keys.

    Ratings lie in a bucketed table, a bucket per core (more if a bucket's keys
    were too many), and are not shuffled again: a key of the larger side is
    solved where its ratings lie, from broadcast factors of the smaller side;
    for the smaller side every bucket sends one sum per key.  What a half step
    shuffles grows with the number of keys, not of ratings.  Hot keys of the
    larger side lie in a table of their own, read in splits; their sums are
    few.  If the smaller side is too large to broadcast, its factors are joined
    by shuffle and each rating takes its factors, not its part of the normal
    equations, to its key."""
    spark = pairs.sparkSession
    (_, n_many, hot_many, n_hot), (_, n_few, hot_few, n_hot_few) = known[many], known[few]
    hot = materialize(pairs.join(F.broadcast(hot_many), many, "left_semi"), "als-hot") if n_hot else None
    cold, name = None, f"lodestar_als_{uuid.uuid4().hex[:12]}"
    if n_hot < n_many:
        rows = pairs.join(F.broadcast(hot_many), many, "left_anti") if n_hot else pairs
        buckets = max(spark.sparkContext.defaultParallelism, -(-n_many // BUCKET_KEYS))
        rows.write.bucketBy(buckets, many).option("path", scratch_path(spark, "als-cold")).saveAsTable(name)
        cold = spark.table(name)
    small = _may_broadcast(n_few, rank)

    def solved(ask: str, factors: DataFrame) -> DataFrame:
        by = few if ask == many else many
        parts = []
        if by == many:
            if hot is not None:
                parts.append(hot.join(F.broadcast(factors.join(F.broadcast(hot_many), by, "left_semi")), by))
            if cold is not None:
                parts.append(cold.join(factors.hint("shuffle_hash"), by))
            return _solved(functools.reduce(DataFrame.unionByName, parts), ask, rank, reg)
        for rows, bounded in ((hot, True), (cold, False)):
            if rows is None:
                continue
            if small:
                joined = rows.join(F.broadcast(factors), by)
            else:
                joined = _with_factors(rows, factors, by, hot_few, n_hot_few < n_few)
                joined = joined if bounded else joined.repartition(ask)
            parts.append(_solved(joined, ask, rank, reg))
        return functools.reduce(DataFrame.unionByName, parts)

    try:
        if cold is None and hot is None:  # no rating at all
            cold = pairs
        yield solved
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def als_score(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str = "user", item: str = "item",
              output: str = "prediction") -> DataFrame:
    """``pairs`` with the product of their factors; NaN where a key was not in training."""
    u, i = users.select(F.col("user").alias("_u"), F.col("v").alias("_uv")), items.select(F.col("item").alias("_i"), F.col("v").alias("_iv"))
    u, i = (F.broadcast(x) if _may_broadcast(*x.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(v)), F.lit(0))).first()) else x for x, v in ((u, "_uv"), (i, "_iv")))
    joined = pairs.join(u, F.col(user) == F.col("_u"), "left").join(i, F.col(item) == F.col("_i"), "left")
    dot = F.aggregate(F.zip_with("_uv", "_iv", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    known = F.col("_uv").isNotNull() & F.col("_iv").isNotNull()
    return joined.withColumn(output, F.when(known, dot).otherwise(F.lit(float("nan")))).drop("_u", "_uv", "_i", "_iv")
