"""Parquet test tables: the driver's star schema plus text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import table_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming columns here lets the scan read only those."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose tables to ``spark.sql`` under their own names."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)
