"""Session construction and shared-folder helpers.

Everything that must survive an executor loss (checkpoints, replay files,
round-trip scratch tables) goes under the folder named by
``spark.checkpoint.dir``, which must be shared storage on a cluster.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Settings we want for every job: runtime re-planning, skew splitting,
# evidence-based broadcasts, UTC wall clock (the test tables' timestamps
# are zone-less).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on evidence: no static broadcast from file-size
    # estimates; AQE may still broadcast a side whose *measured* shuffle
    # output is under 32 MB, and explicit bounded_broadcast hints apply.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "lodestar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    The library never picks a folder of its own: on a cluster a machine-local
    one would lose intermediate results with an executor.  Programs that run
    on one machine call ``use_checkpoint_dir`` first."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def use_checkpoint_dir(spark: SparkSession, folder: Callable[[], str]) -> None:
    """Name a checkpoint folder where the session has none (tests, tools on one machine)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir() and not sc.getConf().get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(folder())


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table that this library wrote under the
    checkpoint folder.  For the end of a run: results that are still read
    (unwritten DataFrames of the library) lose their input."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/lodestar-scratch")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lodestar-scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str = "stage"):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back: lineage is cut (a lost executor recomputes from the table,
    not from the sources) and later branches reuse the stored result."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
