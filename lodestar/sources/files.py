"""Text, CSV and JSON sources and sinks.

Readers always take an explicit schema when the caller has one: schema
inference is an extra full pass over the input and guesses types that the
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_text_lines(spark: SparkSession, path: str, drop_header: str | None = None) -> DataFrame:
    """One row per line, column ``value`` (S1); optionally drop a header line."""
    df = spark.read.text(path)
    if drop_header is not None:
        df = df.filter(F.col("value") != F.lit(drop_header))
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """CSV with or without header (S2, S3), custom separator (S4), a folder of parts.

    Without a schema every column is a string, named from the header or
    ``_c0, _c1, ...`` by position.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite") -> None:
    """Write a folder of CSV parts; every part carries the header when asked."""
    df.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines (S5). With no schema, Spark infers one in an extra pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_csv_parts(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """A folder of CSV parts where only some parts start with the header
    line (S11: e.g. the first part of an export).

    The ``header`` option would drop the first line of *every* part, losing
    a data row from each part written without one.  Here lines are read as
    text, only lines equal to the header (the schema's column names joined
    by ``sep``) are dropped, and the rest are parsed with the built-in
    ``from_csv``.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    header = sep.join(schema.fieldNames())
    lines = read_text_lines(spark, path)
    lines = lines.filter(F.col("value") != F.lit(header))
    parsed = F.from_csv(F.col("value"), schema.toDDL(), {"sep": sep})
    return lines.select(parsed.alias("_r")).select("_r.*")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str,
                   mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a table bucketed and sorted on ``key`` at ``path``
    (shared storage) and return it read back through the catalog.

    Two tables bucketed on their join keys with the same bucket count join
    bucket-by-bucket: Spark plans the join without shuffling either side, so
    a pair of tables that is joined again and again pays the shuffle once,
    at write time.
    """
    (df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def write_observed(df: DataFrame, path: str, keep: Column | None = None, **metrics: Column) -> dict:
    """Write the rows of ``df`` that ``keep`` holds for as Parquet and return metrics of all rows, gathered on the way (A1, A5: the reference's accumulators).

    Each metric is an aggregate column.  They are computed by the job that
    writes (one pass), and unlike accumulators that tasks add to, a task that
    runs again does not count twice.  Empty input gives what the aggregates
    give for no row."""
    watch = Observation()
    seen = df.observe(watch, *[c.alias(name) for name, c in metrics.items()])
    (seen if keep is None else seen.filter(keep)).write.mode("overwrite").parquet(path)
    return watch.get
