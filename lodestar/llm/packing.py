"""Conflict-constrained best-fit packing of documents into fixed-length sequences.

Documents are cut into pieces of at most ``capacity`` words (only the last
piece of a long document is short).  Full pieces fill a sequence of their own;
the others are dealt by hash into packing groups of a bounded number of
pieces, and each group is packed in one task by best fit, largest piece first.
Dealing by hash also spreads a hot source or a large group of copies evenly.

Inside a group the open bins stand in an index ordered by residual space.
Every bin carries one bitmap: the sources and the duplicate clusters in it.
Every index node carries the bits common to all bins below it, so the search
for the next larger residual passes over whole ranges in which each bin
conflicts, and continues until the tightest compatible bin is found.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import hash60, materialize, ship, word_count

CAPACITY = 2048  # words per sequence
GROUP = 20_000  # pieces per packing group (expected number: dealt by hash)
_ALL = -1  # bitmap with every bit: an empty index range conflicts with everything


class BinIndex:
    """Open bins ordered by residual, with bitmaps; residuals are 1..capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, math.ceil(math.log2(capacity + 1)))
        self.common = [_ALL] * (2 * self.size)  # AND of the bitmaps below each node
        self.leaves: dict[int, dict[int, list[int]]] = {}  # residual -> bitmap -> bins

    def _update(self, residual: int) -> None:
        common = _ALL
        for bitmap in self.leaves.get(residual, ()):
            common &= bitmap
        node = self.size + residual
        self.common[node] = common
        while node > 1:
            node >>= 1
            both = self.common[2 * node] & self.common[2 * node + 1]
            if both == self.common[node]:
                break
            self.common[node] = both

    def add(self, number: int, residual: int, bitmap: int) -> None:
        if residual > 0:
            self.leaves.setdefault(residual, {}).setdefault(bitmap, []).append(number)
            self._update(residual)

    def take_tightest(self, need: int, mask: int) -> tuple[int, int, int] | None:
        """Remove and return (bin, residual, bitmap) with the smallest residual
        >= need whose bitmap shares no bit with ``mask``; None if there is none."""
        node = self.size + need
        while True:
            residual = self._first(node, mask)
            if residual is not None:
                break
            while node & 1:  # right child: its parent ends with it
                node >>= 1
                if node <= 1:
                    return None
            node += 1  # the subtree just to the right
        leaf = self.leaves[residual]
        bitmap = next(b for b in leaf if not b & mask)
        bins = leaf[bitmap]
        number = bins.pop(0)
        if not bins:
            del leaf[bitmap]
        self._update(residual)
        return number, residual, bitmap

    def _first(self, top: int, mask: int) -> int | None:
        """Smallest residual below node ``top`` that holds a compatible bin."""
        stack = [top]
        while stack:
            node = stack.pop()
            if self.common[node] & mask:
                continue  # every bin below conflicts
            if node < self.size:
                stack += (2 * node + 1, 2 * node)
            elif any(not b & mask for b in self.leaves.get(node - self.size, ())):
                return node - self.size
        return None


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each piece, taken in the given order.

    Two pieces of one source, or of one duplicate cluster, never share a bin."""
    bits: dict[tuple, int] = {}
    for kind, values in (("source", sources), ("cluster", clusters)):
        counts: dict = {}
        for v in values:
            counts[v] = counts.get(v, 0) + 1
        for v, n in counts.items():
            if n > 1 and not (kind == "cluster" and v is None):  # a value that occurs once can't conflict
                bits[kind, v] = 1 << len(bits)
    index, bins, offsets, opened = BinIndex(capacity), [], [], 0
    for size, source, cluster in zip(sizes, sources, clusters):
        mask = bits.get(("source", source), 0) | bits.get(("cluster", cluster), 0)
        found = index.take_tightest(size, mask)
        number, residual, bitmap = found or (opened, capacity, 0)
        opened += found is None
        bins.append(number)
        offsets.append(capacity - residual)
        index.add(number, residual - size, bitmap | mask)
    return bins, offsets


def _pack_group(capacity: int, conflicts: tuple[str, ...]) -> Callable[[pa.Table], pa.Table]:
    def pack(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("length", "descending"), ("order", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        marks = [rows[c].to_pylist() if c in conflicts else range(len(rows)) for c in ("source", "cluster")]
        bins, offsets = best_fit(rows["length"].to_pylist(), *marks, capacity)
        return rows.append_column("bin", pa.array(bins, pa.int64())).append_column("at", pa.array(offsets, pa.int64()))

    return pack


def pack(docs: DataFrame, size: Column, cluster: Column, doc_id: str = "doc_id", source: str = "source",
         capacity: int = CAPACITY, group: int = GROUP, conflicts: tuple[str, ...] = ("source", "cluster")) -> DataFrame:
    """One row per piece: bin_id, bin_offset, doc_id, piece, start, length, source, cluster.

    ``size`` and ``cluster`` are columns over ``docs``.  Pieces of a document
    cover [0, size) in words; pieces of one bin do not overlap and end at or
    before ``capacity``; no bin holds two pieces of one source or one cluster
    (of what ``conflicts`` names: a source that fills more than its share of
    bins leaves room unused, and may be left out).
    A null size counts as 0; documents of size 0 get one piece of length 0 in
    no bin (bin_id null).  A null source is a source like any other; a null
    cluster never conflicts.  Repeated rows are packed as often as they occur;
    a document of any length becomes whole bins and a rest.
    Other columns are ignored; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       F.coalesce(size, F.lit(0)).cast("long").alias("total"), cluster.alias("cluster"))
    pieces = slim.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.ceil(F.col("total") / capacity) - 1, F.lit(0)))))
    pieces = pieces.select(
        "doc_id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("total") - F.col("piece") * capacity).alias("length"))
    pieces = pieces.withColumn("row", F.monotonically_increasing_id())
    pieces = materialize(pieces, "pack-pieces")
    whole = pieces.filter(F.col("length") == capacity)
    part = pieces.filter((F.col("length") < capacity) & (F.col("length") > 0))
    groups = max(1, math.ceil(part.count() / group))
    # the row number deals repeated rows over the groups too
    order = hash60(F.col("doc_id"), F.col("cluster"), F.col("source"))
    dealt = part.select("*", order.alias("order"),
                        F.pmod(F.xxhash64(order, F.col("row")), F.lit(groups)).cast("long").alias("bins"))
    schema = dealt.schema.simpleString()[7:-1] + ",bin:long,at:long"
    packed = dealt.groupBy("bins").applyInArrow(_pack_group(capacity, conflicts), schema)
    out = ["doc_id", "piece", "start", "length", "source", "cluster"]
    return (
        packed.select(F.concat_ws("-", F.lit("g"), "bins", "bin").alias("bin_id"), F.col("at").alias("bin_offset"), *out)
        .unionByName(whole.select(F.concat_ws("-", F.lit("w"), "row").alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"), *out))
        .unionByName(pieces.filter("length = 0").select(
            F.lit(None).cast("string").alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"), *out)))


def copy_cluster(text: Column) -> Column:
    """Cluster key of exact copies up to letter case and white space (null for wordless texts)."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(words != "", F.xxhash64(words))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                   capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pack`` with sizes in words and clusters of exact copies, both from the text."""
    return pack(docs, word_count(F.col(text)), copy_cluster(F.col(text)), doc_id, source, capacity, group)
