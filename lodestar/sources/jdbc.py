"""JDBC table source.

The caller supplies connection options (no credentials live here) and
``partition_column`` with its bounds, so that Spark opens ``num_partitions``
parallel range reads.  A read through one connection, and so one task, must
be asked for with ``single_task=True``.  Filters and column
selections applied to the result are pushed into the remote query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    single_task: bool = False,
) -> DataFrame:
    if partition_column is None and not single_task:
        raise ValueError("name a partition_column with its bounds, or ask for single_task=True")
    if partition_column is not None and None in (lower_bound, upper_bound, num_partitions):
        raise ValueError("partitioned JDBC reads need bounds and num_partitions")
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", column_types: str | None = None) -> None:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
