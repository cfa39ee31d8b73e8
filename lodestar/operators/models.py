"""Model training and scoring with Spark ML.

All estimators train by distributed aggregation (normal-equation sums,
split histograms, centre updates, ALS blocks); the fitted model is small
(coefficients, trees, centres) except ALS, whose factors stay in DataFrames.
For repeatable results fix ``seed`` and give the training input a stable
partitioning (read, then order by a key) - forests and k-means sample per
partition.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.fixed import ALS_MAX_ITER, ALS_REG_PARAM, KMEANS_K, KMEANS_SEED
from lodestar.operators.ordering import dense_row_ids
from lodestar.session import materialize


def _fit_persisted(estimator, df: DataFrame, columns: list[str]):
    """Fit on the needed columns, persisted (memory, spilling to disk) for the
    estimator's several passes and released afterwards; a lost block is
    recomputed from lineage.  An input the caller already persisted is used
    as it is."""
    from pyspark import StorageLevel

    if df.storageLevel != StorageLevel.NONE:
        return estimator.fit(df)
    data = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(data)
    finally:
        data.unpersist()


def linear_regression(train: DataFrame, features: str = "features", label: str = "label", **params):
    """Least squares (M10); defaults as in the reference (no regularisation).

    With up to 4096 features the solver is the normal equations: one
    distributed aggregation of X'X and X'y, exact up to rounding.
    """
    return _fit_persisted(LinearRegression(featuresCol=features, labelCol=label, **params), train,
                          [features, label])


def decision_tree(train: DataFrame, features: str = "features", label: str = "label", **params):
    """Classification tree (M11): depth 5, 32 bins, gini by default."""
    return _fit_persisted(DecisionTreeClassifier(featuresCol=features, labelCol=label, **params), train,
                          [features, label])


def random_forest(train: DataFrame, features: str = "features", label: str = "label", seed: int = 1, **params):
    """Random forest classifier (M13): 20 trees by default."""
    return _fit_persisted(RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, **params), train,
                          [features, label])


def kmeans(df: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED, features: str = "features", **params):
    """K-means clustering (M12), k=4 and seed=1 as in the reference.

    The feature column is persisted (memory, spilling to disk) for the
    iterations and released afterwards; a lost block is recomputed from
    lineage.
    """
    return _fit_persisted(KMeans(k=k, seed=seed, featuresCol=features, **params), df, [features])


INT_MAX = 2**31 - 1


def int_ids(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` as the 32-bit id that ALS needs (null rows go).

    Ids that fit are cast; larger or negative ones are replaced by their dense
    rank, and the old values stay in ``<column>_key``.  More than 2^31 - 1
    distinct ids cannot be numbered: an error."""
    df = df.filter(F.col(column).isNotNull())
    low, high = df.agg(F.min(column), F.max(column)).first()
    keyed = df.withColumn(f"{column}_key", F.col(column))
    if low is None or (low >= 0 and high <= INT_MAX):
        return keyed.withColumn(column, F.col(column).cast("int"))
    ranked = materialize(dense_row_ids(df.select(column).distinct(), column, id_col="_id", start=0), "als-ids")
    if ranked.count() > INT_MAX:
        raise ValueError(f"ALS numbers at most {INT_MAX} ids; {column!r} has more distinct values")
    return keyed.join(ranked, column).drop(column).withColumnRenamed("_id", column).withColumn(column, F.col(column).cast("int"))


def als(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating",
        max_iter: int = ALS_MAX_ITER, reg_param: float = ALS_REG_PARAM, seed: int = 1, cold_start: str = "nan",
        **params):
    """Alternating least squares recommender.

    Ids must fit in a 32-bit int (an ALS requirement; see ``int_ids``).  ``cold_start='nan'``
    (the default, D13) leaves a NaN prediction for users or items not seen in
    training; ``'drop'`` removes such rows from the scored output.
    """
    return ALS(userCol=user, itemCol=item, ratingCol=rating, maxIter=max_iter, regParam=reg_param,
               seed=seed, coldStartStrategy=cold_start, **params).fit(ratings)


def text_classifier(text: str = "text", label: str = "label", num_features: int = 1 << 18,
                    smoothing: float = 1.0) -> Pipeline:
    """Tokenizer -> hashed term frequencies -> IDF -> multinomial Naive Bayes (M5-M9)."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="raw_features", numFeatures=num_features),
        IDF(inputCol="raw_features", outputCol="features"),
        NaiveBayes(featuresCol="features", labelCol=label, smoothing=smoothing),
    ])


def naive_bayes(train: DataFrame, features: str = "features", label: str = "label", smoothing: float = 1.0):
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing).fit(train)
