"""Feature preparation with Spark ML transformers.

``label_index`` is an index of any number of labels, as a table;
``index_labels`` is Spark ML's, whose fitted model holds the labels of a
categorical column (codes, segments, classes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.ordering import dense_row_ids
from lodestar.operators.partitioning import split_hot_join
from lodestar.session import materialize


def label_index(df: DataFrame, column: str) -> DataFrame:
    """The frequency-ordered index of a column as a table (M1): (label, n, index).

    Index 0.0 is the most frequent label; equal counts go by the label.  Any
    number of labels: they are counted map-side, numbered by a distributed
    sort, and never reach the driver.  Null is no label."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ranked = dense_row_ids(counts.withColumn("_fall", -F.col("n")), "_fall", "label", id_col="_at", start=0)
    return materialize(ranked.select("label", "n", F.col("_at").cast("double").alias("index")), "label-index")


def apply_label_index(df: DataFrame, index: DataFrame, column: str, output: str, unseen: str = "skip") -> DataFrame:
    """``df`` with the index of ``column``.  ``unseen``: rows whose label is null or
    not in the index go (``skip``), or get the number of labels (``keep``).

    Frequent labels are joined by broadcast, the others by shuffle
    (``split_hot_join``): a label with a third of the rows skews nothing."""
    if unseen not in ("skip", "keep"):
        raise ValueError(unseen)
    named = index.select(F.col("label").alias(column), F.col("n").alias("_label_n"), F.col("index").alias(output))
    known = split_hot_join(df, named, column, "_label_n").select(*df.columns, output)
    if unseen == "skip":
        return known
    total = index.agg(F.count(F.lit(1)).cast("double")).scalar()
    nulls = df.filter(F.col(column).isNull()).select("*", total.alias(output))
    hot = F.broadcast(index.orderBy(F.desc("n")).limit(10_000).select(F.col("label").alias(column)))
    rest = df.filter(F.col(column).isNotNull()).join(hot, column, "left_anti")
    rest = rest.join(index.select(F.col("label").alias(column)), column, "left_anti").select(*df.columns, total.alias(output))
    return known.unionByName(nulls).unionByName(rest)


def apply_labels(df: DataFrame, index: DataFrame, column: str, output: str) -> DataFrame:
    """Indices back to labels (M2) by the same table; an index that it does not have gives null."""
    named = index.select(F.col("index").alias(column), F.col("n").alias("_label_n"), F.col("label").alias(output))
    known = split_hot_join(df, named, column, "_label_n").select(*df.columns, output)
    number = F.col(column)
    size = index.agg(F.count(F.lit(1))).scalar()
    out = number.isNull() | (number < 0) | (number >= size) | (number != F.floor(number))
    label_type = index.schema["label"].dataType
    return known.unionByName(df.filter(out).select("*", F.lit(None).cast(label_type).alias(output)))


def index_labels(df: DataFrame, input_col: str, output_col: str, order: str = "frequencyDesc",
                 handle_invalid: str = "error"):
    """Fit and apply Spark ML's index (M1); ties are broken alphabetically.

    The labels are part of the fitted model, on the driver: for categories
    (codes, segments, classes).  ``label_index`` takes any number of labels.
    Returns ``(indexed_df, model)``; ``model.labels`` maps an index back to its
    category.  ``handle_invalid='keep'`` gives unseen categories the index
    ``len(labels)``."""
    model = StringIndexer(inputCol=input_col, outputCol=output_col, stringOrderType=order,
                          handleInvalid=handle_invalid).fit(df)
    return model.transform(df), model


def index_to_string(df: DataFrame, input_col: str, output_col: str, labels: Sequence[str]) -> DataFrame:
    """Map indices back to categories with the fitted labels (M2)."""
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=list(labels)).transform(df)


def assemble(df: DataFrame, columns: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns into one dense vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def array_features(col: str | Column) -> Column:
    """``array<float>`` embedding column as an ML vector."""
    return array_to_vector(F.col(col) if isinstance(col, str) else col)


def scale(df: DataFrame, input_col: str, output_col: str, with_mean: bool = True, with_std: bool = True):
    """Centre and scale a vector column (M3, vector form); returns ``(df, model)``."""
    model = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean,
                           withStd=with_std).fit(df)
    return model.transform(df), model


def pca(df: DataFrame, k: int, input_col: str = "features", output_col: str = "pca_features"):
    """Project onto the top ``k`` principal components (M4); returns ``(df, model)``.

    The covariance matrix is aggregated across the cluster (its size is the
    number of features squared, not the number of rows).
    """
    model = PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df)
    return model.transform(df), model


def principal_axes(df: DataFrame, k: int, input_col: str = "features") -> list[list[float]]:
    """The top ``k`` principal axes, each of length one and with one sign (M4).

    Axes are unique up to their signs when the variances along them differ;
    the sign is the one that makes the loading of largest size positive (the
    first of equals).  Axes of equal variances may be any basis of their space."""
    model = PCA(k=k, inputCol=input_col, outputCol="_axes").fit(df)
    axes = model.pc.toArray().T
    flip = [1.0 if a[abs(a).argmax()] >= 0 else -1.0 for a in axes]
    return [[float(x * f) for x in a] for a, f in zip(axes, flip)]


def project(values: Column, axes: Sequence[Sequence[float]]) -> list[Column]:
    """Coordinates of an array of doubles along each axis, as column expressions (not centred, as Spark ML's)."""
    dot = lambda a: F.aggregate(F.zip_with(values, F.array(*[F.lit(x) for x in a]), lambda v, x: v * x), F.lit(0.0), lambda s, v: s + v)
    return [dot(a) for a in axes]
