"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lodestar
from lodestar.session import materialize  # noqa: F401  (re-exported: written stage + reread)

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus`` (null key: that of the empty text)."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % modulus


def hash60(*parts: Column) -> Column:
    """60-bit uniform hash (leading 15 hex digits of an MD5) that other engines can repeat."""
    text = F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0002")) for p in parts])
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("long")


def source_name(df: DataFrame, used: str, wanted: str = "_ls") -> str:
    """A column name that ``df`` does not have yet (its columns may clash with ours)."""
    name = f"{wanted}_{used}"
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship(spark: SparkSession) -> None:
    """Make this package importable in Spark's Python workers (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_lodestar_shipped", False):
        return
    root = Path(lodestar.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="lodestar-")) / "lodestar_package.zip"  # the driver serves it to executors
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path("lodestar") / file.relative_to(root))
    sc.addPyFile(str(archive))
    sc._lodestar_shipped = True


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# For chains of stages that each end in a written table.  Shuffle files go when the query that wrote them has ended,
# not when the driver collects garbage: nothing reads an older shuffle again, and files lost while a query runs are
# still made anew.  Long texts reach Python in batches of fewer rows.
STAGED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
