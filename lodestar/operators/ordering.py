"""Ordered previews, top-k and dense row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators.joins import bounded_broadcast


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a defined order (``show``/``take`` made deterministic).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task keeps
    its own top n, so only n rows per task cross the network.
    """
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, k: int, by: str, *tie_breakers: str, descending: bool = True) -> DataFrame:
    """Largest (or smallest) ``k`` rows by ``by``; ties broken by the given keys."""
    first = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(first, *[F.col(c).asc() for c in tie_breakers]).limit(k)


def dense_row_ids(df: DataFrame, key: str, *tie_breakers: str, id_col: str = "row_id",
                  start: int = 1) -> DataFrame:
    """Consecutive ids in ``key`` order without funnelling rows through one task.

    A global ``row_number()`` window would move every row into a single
    partition.  Instead: range-partition and sort by key, tag each row with
    its partition and position (``monotonically_increasing_id`` packs both),
    checkpoint that so the partitioning cannot change between the two uses
    below, count rows per partition (one tiny row per partition), turn the
    counts into offsets, and add each row's offset.  The offsets table has one
    row per partition, so its broadcast is bounded by the partition count.

    The sort key ends with a unique per-row value, so the range bounds can
    cut inside a run of equal keys: a key value held by a third of the rows
    is spread over several partitions instead of landing in one.  Rows with
    equal ``key`` and ``tie_breakers`` get ids in input order.
    """
    from lodestar.session import checkpoint_dir

    order = [F.col(key).asc(), *[F.col(c).asc() for c in tie_breakers], F.col("_seq").asc()]
    tagged = (
        df.withColumn("_seq", F.monotonically_increasing_id())
        .orderBy(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_mid"), 33))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna(0, subset=["_off"])
    out = tagged.join(bounded_broadcast(offsets, 1_000_000), "_part")
    return out.select(*df.columns, (F.col("_off") + F.col("_pos") + F.lit(start)).alias(id_col))
