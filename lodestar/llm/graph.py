"""Connected components by alternating large-star / small-star joins.

Every step is a keyed aggregation plus a keyed join over the edge table, so no
node's neighbour list is ever gathered: a hub's edges are reduced map-side to
one minimum, and the join against it is a plain shuffle join whose hot
partitions AQE splits.  Each round's edges are written to the shared folder,
so a lost executor re-reads one round, not the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a > b): point neighbours at the smallest one."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        moved = both.filter("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        moved = edges.join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the
    smallest node of its component.  Null ends and self loops are ignored."""
    now = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = now.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = materialize(now, "cc-edges")
    state = None
    while True:
        row = now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == tuple(row) or row[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = tuple(row)
        now = materialize(_star(_star(now, True), False), "cc-edges")
