"""Column profiles, standardisation and correlations.

Each profile is a single aggregation pass: every statistic of every column
is one aggregate in one ``agg`` call, combined map-side by Catalyst.  The
reference ran one job per column (correlations) or per statistic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.joins import with_scalars


def _stack(names: Sequence[str], per_name: Sequence[Sequence[str]], out_cols: Sequence[str]) -> str:
    """``stack`` expression turning per-column aggregate columns into rows."""
    parts = []
    for name, cols in zip(names, per_name):
        parts.append(f"'{name}'")
        parts.extend(f"`{c}`" for c in cols)
    return f"stack({len(names)}, {', '.join(parts)}) AS ({', '.join(out_cols)})"


def profile(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Mean and sample standard deviation of each column, one row per column."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    long = wide.selectExpr(_stack(columns, [[f"{c}__mean", f"{c}__std"] for c in columns],
                                  ["column", "mean", "stddev"]))
    if digits is not None:
        long = long.select("column", F.round("mean", digits).alias("mean"), F.round("stddev", digits).alias("stddev"))
    return long


def standardize(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), reverse_sign: bool = False,
                prefix: str = "z_") -> DataFrame:
    """``(x - mean) / sd`` per column (M3); ``reverse_sign`` gives the reference's
    ``(mean - x) / sd`` (D5).  A zero deviation yields null, not an error.

    The means and deviations are one row, attached by broadcast: the data is
    read twice and never shuffled.
    """
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"_m_{c}"), F.stddev_samp(c).alias(f"_s_{c}")]
    stats = df.agg(*aggs)
    joined = with_scalars(df.select(*keep, *columns), stats)
    outs = []
    for c in columns:
        centred = (F.col(f"_m_{c}") - F.col(c)) if reverse_sign else (F.col(c) - F.col(f"_m_{c}"))
        outs.append(F.try_divide(centred, F.col(f"_s_{c}")).alias(f"{prefix}{c}"))
    return joined.select(*keep, *outs)


def corr_with_target(df: DataFrame, target: str, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pearson correlation of each column with ``target``, one row per column."""
    wide = df.agg(*[F.corr(target, c).alias(f"{c}__corr") for c in columns])
    long = wide.selectExpr(_stack(columns, [[f"{c}__corr"] for c in columns], ["column", "corr"]))
    if digits is not None:
        long = long.select("column", F.round("corr", digits).alias("corr"))
    return long
