"""Join helpers.

Broadcasting is only done behind a measured bound: ``bounded_broadcast``
counts the rows and bytes of the candidate side with partial aggregates (one
row per task is moved) and broadcasts only if the side fits both bounds.  Otherwise the
plain join is returned and Spark plans a shuffle join, which AQE can still
turn into a broadcast at runtime from real shuffle statistics, and whose
skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side is copied to every executor: at most 1M rows and about
# 64 MB (measured as the JSON text of the rows) per broadcast.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def fits_rows(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, if given, at most
    about ``max_bytes`` of data.  Counted by a partial aggregate in every task:
    one row per task is moved, whatever the size of ``df``."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return row["n"] <= max_rows and (max_bytes is None or (row["b"] or 0) <= max_bytes)


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: bytes of its strings and binaries, 8 for a fixed-width
    value, the JSON text of nested values."""
    total = F.lit(0)
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
        else:
            total = total + 8
    return total


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its size is proven small (rows and bytes),
    else leave it alone for a shuffle join."""
    return F.broadcast(df) if fits_rows(df, max_rows, max_bytes) else df


def inner_join(left: DataFrame, right: DataFrame, on: Column | str | list, broadcast_right: bool = False,
               max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Inner equi-join; both key columns are kept when they are named differently."""
    if broadcast_right:
        right = bounded_broadcast(right, max_rows)
    return left.join(right, on, "inner")


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Dimension lookup (J4): join a code table to a fact table by its id.

    The dimension is broadcast when it is proven small; the fact side is
    then never shuffled.
    """
    dim = bounded_broadcast(dim, max_rows)
    return fact.join(dim, fact[fact_key] == dim[dim_key], "inner")


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (J3: the
    reference's broadcast value).

    Each column becomes a scalar subquery (``DataFrame.scalar()``): Spark
    evaluates the aggregate once (sibling subqueries over the same aggregate
    are merged) and inlines the value, so there is no join at all.
    """
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])
