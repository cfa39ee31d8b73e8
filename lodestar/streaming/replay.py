"""Replay a table as a stream of files.

The reference fed a socket; here a table is published in slices to a landing
folder, and after each slice the streaming query runs until it has read it.
The order of slices is that of an explicit slice number, not of file times.
One scan writes the files of all slices beside the landing folder, by as many
tasks as it has splits, and a slice is published by renaming its files: rows
are neither shuffled nor sorted, so neither the table's size nor a hot key
matters.
The files live under the shared checkpoint folder so a restarted query can
read them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import scratch_path


def key_slice(key: str, slices: int) -> Column:
    """Slice number by key arithmetic (null keys: slice 0)."""
    return F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(slices))


def range_slice(df: DataFrame, column: str, slices: int) -> Column:
    """Slice number by equal ranges of a timestamp column (nulls: slice 0)."""
    micros = F.unix_micros(F.col(column).cast("timestamp"))  # only differences matter: any session zone will do
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        return F.lit(0)
    width = (high - low) // slices + 1
    return F.coalesce(((micros - F.lit(low)) / F.lit(width)).cast("int"), F.lit(0))


def replay(df: DataFrame, number: Column, slices: int, step: Callable[[DataFrame], object], path: str | None = None) -> str:
    """Publish ``df`` in slices 0, 1, ...; ``step(stream)`` is called after each
    and must run its query with one checkpoint until the input is read.

    A slice without rows is an empty file: it makes a micro-batch too.  Columns
    may have any name."""
    spark = df.sparkSession
    path, staged = path or scratch_path(spark, "landing"), scratch_path(spark, "staged")
    column = "_slice"
    while column in df.columns:
        column = "_" + column
    df.withColumn(column, number.cast("int")).write.partitionBy(column).parquet(staged)
    for i in range(slices):
        if not _publish(spark, f"{staged}/{column}={i}", path):
            df.limit(0).write.mode("append").parquet(path)
        step(file_stream(spark, path, df.schema))
    return path


def _publish(spark: SparkSession, folder: str, landing: str) -> bool:
    """Rename the files of ``folder`` into ``landing``; False if there are none."""
    jvm = spark.sparkContext._jvm
    to, path = jvm.org.apache.hadoop.fs.Path(landing), jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return False
    system.mkdirs(to)
    for status in system.listStatus(path):
        file = status.getPath()
        if not system.rename(file, jvm.org.apache.hadoop.fs.Path(to, f"{path.getName().rpartition('=')[2]}-{file.getName()}")):
            raise OSError(f"{file.toString()} could not be moved to {landing}")
    return True


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Files of a folder as a stream; ``max_files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
