"""Small local collections as tables (S7-S9) and the schema report.

These are for dimension tables and fixtures that are small by nature
(a handful of departments, a code table).  Data that grows must come from a
distributed source instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType


def from_rows(spark: SparkSession, rows: Iterable[Sequence | dict | Row], schema: StructType | str) -> DataFrame:
    """Rows plus an explicit schema (S8); dict rows play the bean role."""
    rows = list(rows)
    if rows and isinstance(rows[0], dict):
        names = schema.fieldNames() if isinstance(schema, StructType) else None
        if names:
            rows = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(rows, schema)


def schema_report(df: DataFrame) -> DataFrame:
    """``printSchema`` as data: one row per top-level column."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")
