"""Projection, filters, grouped and global aggregates.

Aggregates are written so that Catalyst can split them into a map-side
partial and a reduce-side final step (sum, count, max, min); a key that holds
a third of all rows then costs one partial row per map task, not one task
holding all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.scalar import is_numeric, try_double
from lodestar.operators.joins import with_scalars


def select_cols(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_gt(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) > F.lit(value))


def filter_contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.filter(F.col(column).contains(needle))


def filter_startswith(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """Row count as a one-row table (A1)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def group_count(df: DataFrame, *keys: str, alias: str = "n") -> DataFrame:
    """``groupBy(keys).count()``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def keyed_mean(df: DataFrame, key: str, value: str, alias: str = "mean") -> DataFrame:
    """Sum and count per key, then their ratio (A6: reduceByKey + mapValues)."""
    return (
        df.groupBy(key)
        .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
        .select(key, (F.col("_s") / F.col("_n")).alias(alias), F.col("_n").alias("n"))
    )


def keyed_max(df: DataFrame, key: str, value: str, alias: str = "max") -> DataFrame:
    """Maximum per key (A7: what the exercise text asks for)."""
    return df.groupBy(key).agg(F.max(value).alias(alias))


def mean_skip_invalid(df: DataFrame, column: str, alias: str = "mean") -> DataFrame:
    """Mean of a text column over the values that look like plain decimal
    numbers (A5: the reference skips its header line this way).  Values are
    summed as doubles, as the reference does."""
    valid = df.filter(is_numeric(column))
    return valid.agg(F.avg(try_double(column)).alias(alias), F.count(F.lit(1)).alias("n_valid"))


def count_above_mean(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is above the global mean.

    The mean is a scalar subquery evaluated once (J3: the reference's
    broadcast value), then a conditional count: two passes over the data,
    no accumulator.
    """
    mean = df.agg(F.avg(column).alias("_mean"))
    return with_scalars(df.select(column), mean).agg(
        F.count_if(F.col(column) > F.col("_mean")).alias("n_above"),
        F.count(F.lit(1)).alias("n_total"),
    )


def filter_join_aggregate(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    group_key: str,
    mean_of: str,
    predicate: Column,
    max_of: str | None = None,
) -> DataFrame:
    """Filter -> join -> group -> avg/max/count (J2, the flagship chain).

    ``predicate``, ``mean_of`` and ``max_of`` (default: ``mean_of``) may be
    different columns; ``n_rows`` counts rows whether or not they have values.

    The fact table is first reduced to one row per join key (partial sums,
    counts, maxima).  This eager aggregation shrinks the join input to the
    number of distinct keys, and makes the join immune to a hot key: whatever
    share of the fact rows one key holds, it reaches the join as one row.
    """
    max_of = max_of or mean_of
    per_key = (
        fact.filter(predicate)
        .groupBy(F.col(fact_key).alias("_k"))
        .agg(
            F.sum(mean_of).alias("_sum"),
            F.count(mean_of).alias("_cnt"),
            F.max(max_of).alias("_max"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    joined = per_key.join(dim.select(F.col(dim_key).alias("_k"), group_key), "_k")
    return joined.groupBy(group_key).agg(
        F.try_divide(F.sum("_sum"), F.sum("_cnt")).alias(f"avg_{mean_of}"),
        F.max("_max").alias(f"max_{max_of}"),
        F.sum("_rows").alias("n_rows"),
    )
