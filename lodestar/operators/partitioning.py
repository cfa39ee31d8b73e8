"""Partitioning helpers: minimum parallelism and hot-key-safe joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, fits_rows


def spread(scan: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work (tokenising, regex) on a table of few files
    at least one task per core.

    For a bare scan only: it looks at the number of files, which runs no job.
    A table of at least as many files as cores is returned unchanged; a small
    one (a single file is a single split when it is one row group) is dealt
    out.  Results never depend on it."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    files = len(scan.inputFiles())
    return scan.repartition(cores) if files < cores else scan


def split_hot_join(big: DataFrame, small: DataFrame, key: str, count_col: str,
                   total_rows: int | None = None, max_hot_keys: int = 10_000) -> DataFrame:
    """Inner join ``big`` with ``small`` on ``key`` when a few keys may hold a
    large share of ``big``'s rows.

    ``small`` has one row per key and ``count_col`` = number of ``big`` rows
    with that key (e.g. document frequency next to term frequencies), so the
    counts sum to ``total_rows`` (computed when not given).  Keys holding at
    least total / ``max_hot_keys`` rows are *hot*: there are at most
    ``max_hot_keys`` of them, so they are joined by broadcast with a proven
    bound and their rows are never shuffled.  Every other key holds less than
    1/``max_hot_keys`` of the rows, so the shuffle join of the rest has no
    partition dominated by one key.  As many keys as keep the bounds of a
    broadcast (rows and bytes) count as hot, all of them if they can, so that
    few rows are shuffled.  If the hot rows of ``small`` are too large
    to broadcast (very long keys), their keys are salted instead.  No row is
    dropped or sampled.
    """
    if total_rows is None:
        total_rows = small.agg(F.sum(count_col)).first()[0] or 0
    if fits_rows(small, DEFAULT_BROADCAST_ROWS, DEFAULT_BROADCAST_BYTES):
        return big.join(F.broadcast(small), key)
    share = lambda keys: F.col(count_col) * F.lit(keys) >= F.lit(total_rows)  # noqa: E731  true for so many keys at most
    wide = max(max_hot_keys, DEFAULT_BROADCAST_ROWS)
    most = wide if fits_rows(small.filter(share(wide)), wide, DEFAULT_BROADCAST_BYTES) else max_hot_keys
    hot, cold = small.filter(share(most)), small.filter(~share(most))
    if most == wide or fits_rows(hot, max_hot_keys, DEFAULT_BROADCAST_BYTES):
        hot_part = big.join(F.broadcast(hot), key)
        cold_rows = big.join(F.broadcast(hot.select(key)), key, "left_anti")
    else:
        salts = 256
        salted = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = big.withColumn("_salt", (F.monotonically_increasing_id() % salts).cast("int"))
        hot_part = dealt.join(salted, [key, "_salt"]).drop("_salt")
        cold_rows = dealt.join(salted.select(key, "_salt"), [key, "_salt"], "left_anti").drop("_salt")
    return hot_part.unionByName(cold_rows.join(cold, key))
