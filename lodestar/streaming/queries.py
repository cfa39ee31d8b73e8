"""Streaming word counts and sliding-window counts.

Sinks are tables under the shared checkpoint folder, written from
``foreachBatch``:

* ``per_batch`` (stateless, T1): each micro-batch's own result goes to
  ``<sink>/batch_id=<n>``, overwritten if the batch is re-run after a
  failure, so the sink is exactly-once.
* ``update``: only the keys changed by a batch are appended, tagged with the
  batch id; ``read_latest`` gives the last value per key.  State is the running
  aggregate, evicted by the watermark when there is one.
* ``complete``: each batch writes the whole result table under its batch id and
  the newest is read, so a failed write never takes away the last result; use
  it when the number of result keys is small (windows x types).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from lodestar.functions.scalar import split_words
from lodestar.session import scratch_path


def words(stream: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """Stream of single words: the reference's flatMap on spaces."""
    return stream.select(F.explode(split_words(text, sep)).alias("word"))


def count_words(df: DataFrame) -> DataFrame:
    return df.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _event_time(stream: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """``stream`` with its event time; a zone-less ``ts`` is read as UTC, whatever the session's time zone is."""
    zoneless = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    event_time = F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp") if zoneless else F.col(ts).cast("timestamp")
    df = stream.withColumn("_event_time", event_time)
    return df.withWatermark("_event_time", watermark) if watermark else df


def pane_counts(stream: DataFrame, ts: str, key: str, slide: str, watermark: str | None = None) -> DataFrame:
    """Counts per (pane, key), a pane being one slide long (T2 by stream slicing).

    Every event is counted once, in its pane, and state is one row per (pane,
    key): for a window of five slides a fifth of what counting per window
    takes.  ``windows_of_panes`` adds panes up to windows."""
    return _event_time(stream, ts, watermark).groupBy(F.window("_event_time", slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))


def windows_of_panes(panes: DataFrame, panes_per_window: int, *keys: str) -> DataFrame:
    """Sliding windows (struct ``w``) of the given number of panes (struct ``w``), with their summed ``n``.

    A window that holds any event is there, as if every event had been
    assigned to all its windows."""
    start, end = F.unix_micros("w.start"), F.unix_micros("w.end")
    back = F.explode(F.sequence(F.lit(0), F.lit(panes_per_window - 1)))
    moved = panes.select(*keys, "n", start.alias("_s"), (end - start).alias("_slide"), back.alias("_back"))
    first = F.col("_s") - F.col("_back") * F.col("_slide")
    window = F.struct(F.timestamp_micros(first).alias("start"), F.timestamp_micros(first + F.col("_slide") * panes_per_window).alias("end"))
    return moved.groupBy(window.alias("w"), *keys).agg(F.sum("n").alias("n"))


def sliding_counts(stream: DataFrame, ts: str, key: str, window: str, slide: str,
                   watermark: str | None = None) -> DataFrame:
    """Counts per (window, key) over event time.

    A zone-less ``ts`` is read as UTC, whatever the session's time zone is.
    """
    df = _event_time(stream, ts, watermark)
    return df.groupBy(F.window("_event_time", window, slide).alias("w"), key).agg(
        F.count(F.lit(1)).alias("n")
    )


def flatten_windows(df: DataFrame) -> DataFrame:
    """Window struct to plain zone-less start/end columns, in UTC."""
    def utc(c: str):
        seconds = (F.unix_micros(c) / F.lit(1_000_000)).cast("decimal(18,6)")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)

    others = [c for c in df.columns if c != "w"]
    return df.select(utc("w.start").alias("window_start"), utc("w.end").alias("window_end"), *others)


def _run(writer_fn, stream_df: DataFrame, mode: str, checkpoint: str, timeout_s: float | None,
         trigger_seconds: float | None):
    """Start the query and return once all available input is processed.

    With ``trigger_seconds`` the query runs on a processing-time trigger (the
    reference's 3 s batches) until the input present now is consumed, then
    stops; without it, ``availableNow`` processes everything and ends.  There
    is no time limit unless the caller asks for one.
    """
    writer = stream_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint) \
        .foreachBatch(writer_fn)
    if trigger_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    query = writer.start()
    try:
        if trigger_seconds is None:
            finished = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
            if timeout_s is not None and not finished:
                raise TimeoutError(f"streaming query did not finish within {timeout_s}s")
        else:
            query.processAllAvailable()
        if query.exception() is not None:
            raise query.exception()
    finally:
        if query.isActive:
            query.stop()
    return query


def run_per_batch(stream_df: DataFrame, per_batch, sink: str, checkpoint: str | None = None,
                  timeout_s: float | None = None, trigger_seconds: float | None = None) -> str:
    """Apply ``per_batch(df) -> df`` to each micro-batch on its own (T1, stateless)."""
    checkpoint = checkpoint or scratch_path(stream_df.sparkSession, "ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run(write, stream_df, "append", checkpoint, timeout_s, trigger_seconds)
    return sink


def run_sliding_batches(stream_df: DataFrame, per_batch, keys: Sequence[str], length: int, sink: str,
                        checkpoint: str | None = None, timeout_s: float | None = None, trigger_seconds: float | None = None) -> str:
    """Totals over the last ``length`` micro-batches, by arrival (T2 as the reference has it).

    ``per_batch(df)`` gives the keys' counts ``n`` of one micro-batch.  The
    state is a keyed table: a batch's totals are the totals before, plus the
    arriving counts, minus the counts of the batch that leaves the window; a
    key whose total is back at zero leaves the state.  So a batch costs its own
    size and the state's, not ``length`` batches, and both sums are combined
    map-side.  Every batch writes ``<sink>/counts/batch_id=<n>`` and
    ``<sink>/totals/batch_id=<n>``, overwritten when it is run again after a
    failure: totals are made from the tables of earlier, committed batches only.
    """
    spark = stream_df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        table = lambda kind, i: f"{sink}/{kind}/batch_id={i}"
        read = lambda kind, i, sign: session.read.parquet(table(kind, i)).select(*keys, (F.col("n") * sign).alias("n"))
        per_batch(batch).select(*keys, "n").write.mode("overwrite").parquet(table("counts", batch_id))
        state = read("counts", batch_id, 1)
        if batch_id:
            state = state.unionByName(read("totals", batch_id - 1, 1))
        if batch_id >= length:
            state = state.unionByName(read("counts", batch_id - length, -1))
        state.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0").write.mode("overwrite").parquet(table("totals", batch_id))

    _run(write, stream_df, "append", checkpoint, timeout_s, trigger_seconds)
    return sink


def run_aggregate(agg_df: DataFrame, sink: str, mode: str = "update", checkpoint: str | None = None,
                  timeout_s: float | None = None, trigger_seconds: float | None = None) -> str:
    """Run a streaming aggregation to a table sink in ``update`` or ``complete`` mode."""
    if mode not in ("update", "complete"):
        raise ValueError(mode)
    checkpoint = checkpoint or scratch_path(agg_df.sparkSession, "ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(f"{sink}/complete/batch_id={batch_id}")
        else:
            batch.write.mode("overwrite").parquet(f"{sink}/updates/batch_id={batch_id}")

    _run(write, agg_df, mode, checkpoint, timeout_s, trigger_seconds)
    return sink


def read_complete(spark: SparkSession, sink: str) -> DataFrame:
    results = spark.read.parquet(f"{sink}/complete")
    newest = results.agg(F.max("batch_id")).scalar()  # partition values only
    return results.filter(F.col("batch_id") == newest).drop("batch_id")


def read_latest(spark: SparkSession, sink: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Last emitted value per key from an ``update``-mode sink: one grouped
    ``max_by`` over the appended updates (combined map-side per key)."""
    updates = spark.read.parquet(f"{sink}/updates")
    return updates.groupBy(*keys).agg(*[F.max_by(v, "batch_id").alias(v) for v in values])


class ProgressLog(StreamingQueryListener):
    """What every micro-batch of the queries started inside the ``with`` block read (T4).

    ``table()`` has one row per query run and micro-batch that was committed."""

    SCHEMA = "query_id string, run_id string, batch_id long, rows_read long"

    def __init__(self, spark: SparkSession):
        self.spark, self.rows = spark, []

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._wait()
        self.spark.streams.removeListener(self)

    def _wait(self) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((str(p.id), str(p.runId), p.batchId, p.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, self.SCHEMA)


def batch_preview(n: int = 10):
    """``DStream.print()``: the first ``n`` rows of each batch."""
    def per_batch(df: DataFrame) -> DataFrame:
        return df.limit(n)
    return per_batch
