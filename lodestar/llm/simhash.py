"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact check.

A 64-bit fingerprint is cut into 32 two-bit segments and mapped to the vector
of their bit counts.  Changing one bit of the fingerprint changes the vector
by one step, so the Manhattan distance of two vectors is a lower bound of the
Hamming distance of the fingerprints: pairs beyond the limit in the grid can
never be links.

Grid: the segments are dealt into ``distance + AGREE`` groups.  Two vectors
within Manhattan distance ``distance`` differ in at most that many groups, so
they agree exactly on at least ``AGREE`` groups.  A grid cell is (choice of
``AGREE`` groups, their bit counts); every possible link shares a cell.  More
groups make finer cells and more of them per fingerprint: the result is the
same, so ``AGREE`` may be raised for corpora of many million documents.

Inside a cell the pairs are never all produced:

1. equal fingerprints are one node from the start;
2. every member of a cell is compared with three pivots of the cell
   (smallest, largest, a hashed choice): one row per member and pivot;
3. components of these links are formed; a cell whose members are all in one
   component is finished;
4. in the other cells, members outside the cell's largest component are
   compared with members of other components.

Steps 2-4 find a path for every link (a pair of one component needs no row of
its own), and a dense group of copies costs its size, not its square.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import materialize, ship
from lodestar.llm.graph import connected_components

SEGMENTS = 32
AGREE = 5  # groups on which linked vectors surely agree
_LOW = 0x5555555555555555  # lower bit of every two-bit segment
_BLOCK = 200_000  # shingles hashed at once: bounds memory for very long texts


def _fingerprint(text: str | None, width: int) -> int:
    """Signed 64-bit SimHash of one text; 0 when it has no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words) - width + 1
    if not words:
        return 0
    if n < 1:
        width, n = len(words), 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        stop = min(n, at + _BLOCK)
        hashes = np.array([digest(joined[s:e], 42) for s, e in
                           zip(starts[at:stop].tolist(), (ends[at + width - 1:stop + width - 1] - 1).tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    """64-bit SimHash (signed long) of a text column; whole texts, A-Z lower-cased.

    Bit = 1 when set in more than half of the XXH64 (seed 42) hashes of the
    word shingles, repeats included.  Fewer words than a shingle: the whole
    sequence is one shingle.  Null, empty or blank text: 0.
    """

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")

    return simhash(text)


def embedding(fp: Column) -> Column:
    """Bit counts (0, 1, 2) of the 32 two-bit segments, thermometer-coded in one long.

    In this code the Manhattan distance of two vectors is ``bit_count(x ^ y)``
    and "equal counts in some segments" is equality under a mask.
    """
    shifted = F.shiftright(fp, 1)
    some = fp.bitwiseOR(shifted).bitwiseAND(F.lit(_LOW))
    both = fp.bitwiseAND(shifted).bitwiseAND(F.lit(_LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _cell_masks(distance: int) -> list[int]:
    groups = distance + AGREE
    if not AGREE <= groups <= SEGMENTS:
        raise ValueError(f"distance must be between 0 and {SEGMENTS - AGREE}")
    bounds = [round(i * SEGMENTS / groups) for i in range(groups + 1)]
    masks = [sum(3 << (2 * s) for s in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:])]
    chosen = [reduce(int.__or__, c) for c in combinations(masks, AGREE)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _hamming(x: str, y: str) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y)))


def _cells(nodes: DataFrame, distance: int) -> DataFrame:
    """One row per (fingerprint, grid cell); cells are named by a hash, and two
    cells that should share a name only share more candidates."""
    cell = F.array(*[F.xxhash64(F.lit(i), F.col("at").bitwiseAND(F.lit(m))) for i, m in enumerate(_cell_masks(distance))])
    return nodes.withColumn("at", embedding(F.col("fp"))).select("fp", F.explode(cell).alias("cell"))


def link_components(fingerprints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root) for every distinct ``fp``: root names its connected component
    under "at most ``distance`` differing bits" (the smallest fp in it)."""
    tasks = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = materialize(fingerprints.select("fp").distinct(), "simhash-nodes")
    key = ["cell"]

    # Cells with at least two members, each with its pivots.  A fingerprint is in one cell of every
    # grid, so even a group that holds a third of them is a small share of the rows of any one cell.
    members = _cells(nodes.repartition(tasks), distance)  # few bytes, but a row becomes one per grid
    cell = Window.partitionBy("cell")
    shared = materialize(members.select(
        "cell", "fp", F.min("fp").over(cell).alias("p1"), F.max("fp").over(cell).alias("p2"),
        F.min_by("fp", F.xxhash64("fp", "cell")).over(cell).alias("p3")).filter("p1 <> p2"), "simhash-cells")
    pivot = F.explode(F.array_distinct(F.array("p1", "p2", "p3")))
    near = (shared.select("fp", pivot.alias("q"))
            .filter((F.col("fp") != F.col("q")) & (_hamming("fp", "q") <= distance)))
    first = connected_components(near, "fp", "q")
    label = materialize(nodes.join(first.withColumnRenamed("node", "fp"), "fp", "left")
                        .select("fp", F.coalesce("root", "fp").alias("root")), "simhash-labels")

    # cells that still hold several components, and the largest one in each
    rooted = shared.select(*key, "fp").join(label, "fp")
    mixed = (rooted.groupBy(*key, "root").agg(F.count("fp").alias("n")).groupBy(*key)
             .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("root").alias("roots"))
             .filter("roots > 1").drop("roots"))
    open_members = materialize(rooted.join(mixed, key).select(
        *key, "fp", embedding(F.col("fp")).alias("at"), "root", "main"), "simhash-open")
    left = open_members.filter("root <> main").select(
        *key, F.col("fp").alias("fp1"), F.col("at").alias("at1"), F.col("root").alias("root1"))
    right = open_members.select(
        *key, F.col("fp").alias("fp2"), F.col("at").alias("at2"), F.col("root").alias("root2"), "main")
    on = [left[k] == right[k] for k in key] + [
        left["root1"] != right["root2"],
        (right["root2"] == right["main"]) | (left["fp1"] < right["fp2"]),
        _hamming("at1", "at2") <= distance,  # Manhattan lower bound on the grid
        _hamming("fp1", "fp2") <= distance,  # exact
    ]
    bridges = left.join(right, reduce(Column.__and__, on)).select("root1", "root2").distinct()
    second = connected_components(bridges, "root1", "root2")
    joined = label.join(second.withColumnRenamed("root", "top"), label["root"] == second["node"], "left")
    return joined.select("fp", F.coalesce("top", label["root"]).alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    component_id is the smallest non-null doc_id reachable over links of at
    most ``distance`` differing bits, itself included.  Null, empty and blank
    texts have fingerprint zero and link like any other.  A null doc_id takes
    part and gets its component's id (null if the component has only null
    ids); repeated rows stay repeated rows.  A text of any length is hashed
    whole, in blocks of shingles.  Other columns are ignored; an empty table
    gives an empty result.
    """
    ship(docs.sparkSession)
    prints = materialize(docs.select(F.col(doc_id).alias("doc_id"),
                                     fingerprint_column(F.col(text), shingle).alias("fp")), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = materialize(link_components(prints, distance).join(classes, "fp"), "simhash-roots")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = materialize(roots.join(named, "root").select("fp", "component_id"), "simhash-ids")
    return prints.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = 4, distance: int = 4) -> DataFrame:
    """Rows of ``docs`` with one document left of every near-duplicate group.

    The row with the smallest doc_id stays (nulls last; among rows of that id
    the first read).  All columns of ``docs`` come back unchanged.  Null, empty
    and blank texts are copies of each other: one row of them stays.  An empty
    table gives an empty one.
    """
    ship(docs.sparkSession)
    tagged = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                                     fingerprint_column(F.col(text), shingle).alias("fp"))
                         .withColumn("row", F.monotonically_increasing_id()), "simhash-docs")
    rows = tagged.select("row", "fp", F.col("doc").getField(doc_id).alias("id"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    best = rows.groupBy("fp").agg(F.min(order).alias("best"))
    kept = (link_components(rows, distance).join(best, "fp").groupBy("root")
            .agg(F.min("best").getField("row").alias("row")).select("row"))
    return tagged.join(kept, "row", "left_semi").select("doc.*")
