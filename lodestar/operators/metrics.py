"""Evaluation metrics as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.scalar import ratio_percent


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): ``groupBy(label, prediction).count()``."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows where prediction equals label, also as a rounded percent."""
    acc = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(acc.alias("accuracy"), F.count(F.lit(1)).alias("n")).select(
        "accuracy", ratio_percent("accuracy").alias("accuracy_pct"), "n"
    )


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE and R² in one pass: R² = 1 - SSE / SST with SST around the label mean.

    Same definitions as ``RegressionEvaluator`` (metricName rmse / r2).
    """
    y, p = F.col(label), F.col(prediction)
    agg = df.agg(
        F.sum((y - p) * (y - p)).alias("_sse"),
        F.var_pop(y).alias("_var"),  # merged around running means: no cancellation for large labels
        F.count(F.lit(1)).alias("n"),
    )
    sst = F.col("_var") * F.col("n")
    return agg.select(
        F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
        (F.lit(1.0) - F.col("_sse") / sst).alias("r2"),
        "n",
    )
