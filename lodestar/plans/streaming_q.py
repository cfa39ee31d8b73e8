"""Structured Streaming queries over replayed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.fixed import WINDOW_LENGTH, WINDOW_SLIDE
from lodestar.plans.registry import query
from lodestar.session import scratch_path
from lodestar.sources.tables import load
from lodestar.streaming import queries as sq
from lodestar.streaming.lines import line_stream
from lodestar.streaming.replay import key_slice, range_slice, replay

SLICES = 4  # micro-batches of a replay; each is written and read by many tasks

_WORDS_SQL = """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations)
WHERE word <> '' GROUP BY word
"""


def _replay_conversations(spark, sf_dir, step):
    conv = load(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    replay(conv, key_slice("conv_id", SLICES), SLICES, step)


@query("stream_word_count", sql=f"""
SELECT slice, word, count(*) AS n
FROM (SELECT (conv_id % {SLICES} + {SLICES}) % {SLICES} AS slice, unnest(string_split(text, ' ')) AS word FROM conversations)
WHERE word <> '' GROUP BY slice, word
""",
       note="T1: stateless counts of every micro-batch on its own; batch n is slice n of the replay")
def stream_word_count(spark, sf_dir):
    sink, checkpoint = scratch_path(spark, "sink-words"), scratch_path(spark, "ckpt")
    _replay_conversations(spark, sf_dir, lambda stream: sq.run_per_batch(
        stream, lambda b: sq.count_words(sq.words(b, "text")), sink, checkpoint))
    return spark.read.parquet(sink).select(F.col("batch_id").cast("long").alias("slice"), "word", "n")


@query("stream_running_word_count", sql=_WORDS_SQL,
       note="stateful running count in update mode; the last update per word is its total")
def stream_running_word_count(spark, sf_dir):
    sink, checkpoint = scratch_path(spark, "sink-running"), scratch_path(spark, "ckpt")
    _replay_conversations(spark, sf_dir, lambda stream: sq.run_aggregate(
        sq.count_words(sq.words(stream, "text")), sink, "update", checkpoint))
    return sq.read_latest(spark, sink, ["word"], ["n"])


# The reference's window and slide (15 / 3 time units, seconds there) applied in
# minutes, the resolution of the event table's timestamps.
SLIDE = f"{WINDOW_SLIDE} minutes"
WINDOW_US = WINDOW_LENGTH * 60 * 1_000_000
SLIDE_US = WINDOW_SLIDE * 60 * 1_000_000

_SLIDING_SQL = f"""
WITH e AS (SELECT event_type, epoch_us(ts) AS us FROM events),
     w AS (SELECT event_type, (us // {SLIDE_US} - unnest(range({WINDOW_US // SLIDE_US}))) * {SLIDE_US} AS start_us FROM e)
SELECT make_timestamp(start_us) AS window_start, make_timestamp(start_us + {WINDOW_US}) AS window_end,
       event_type, count(*) AS n
FROM w GROUP BY ALL
"""


def _replay_events(spark, sf_dir, step):
    events = load(spark, sf_dir, "events", "event_id", "ts", "event_type")
    replay(events, range_slice(events, "ts", SLICES), SLICES, step)


@query("stream_sliding_count", sql=_SLIDING_SQL,
       note="T2: event-time sliding windows as sums of panes, complete mode (all panes kept)")
def stream_sliding_count(spark, sf_dir):
    # Complete mode keeps every pane: state is one row per (pane, event type).
    sink, checkpoint = scratch_path(spark, "sink-windows"), scratch_path(spark, "ckpt")
    _replay_events(spark, sf_dir, lambda stream: sq.run_aggregate(
        sq.pane_counts(stream, "ts", "event_type", SLIDE), sink, "complete", checkpoint))
    return sq.flatten_windows(sq.windows_of_panes(sq.read_complete(spark, sink), WINDOW_LENGTH // WINDOW_SLIDE, "event_type"))


@query("stream_sliding_count_update", sql=_SLIDING_SQL,
       note="T2 with watermark-evicted state: update mode, last update per pane, panes summed to windows")
def stream_sliding_count_update(spark, sf_dir):
    # The watermark drops rows older than (newest seen - 1 hour); slices come in event-time order.
    sink, checkpoint = scratch_path(spark, "sink-windows-upd"), scratch_path(spark, "ckpt")
    _replay_events(spark, sf_dir, lambda stream: sq.run_aggregate(
        sq.pane_counts(stream, "ts", "event_type", SLIDE, watermark="1 hour"), sink, "update", checkpoint))
    panes = sq.read_latest(spark, sink, ["w", "event_type"], ["n"])
    return sq.flatten_windows(sq.windows_of_panes(panes, WINDOW_LENGTH // WINDOW_SLIDE, "event_type"))


# The reference's window over arrival: the last 15 / 3 = 5 batches, moved on by one batch each time.
WINDOW_BATCHES = WINDOW_LENGTH // WINDOW_SLIDE
ARRIVALS = 8


@query("stream_sliding_batches", sql=f"""
WITH w AS (
  SELECT (conv_id % {ARRIVALS} + {ARRIVALS}) % {ARRIVALS} AS arrived, unnest(string_split(text, ' ')) AS word FROM conversations),
c AS (SELECT arrived, word, count(*) AS n FROM w WHERE word <> '' GROUP BY ALL)
SELECT b.batch, word, CAST(sum(n) AS BIGINT) AS n
FROM range({ARRIVALS}) b(batch) JOIN c ON arrived BETWEEN b.batch - {WINDOW_BATCHES - 1} AND b.batch
GROUP BY ALL
""", note="T2 by arrival: word counts of the last five micro-batches, after every micro-batch")
def stream_sliding_batches(spark, sf_dir):
    sink, checkpoint = scratch_path(spark, "sink-arrivals"), scratch_path(spark, "ckpt")
    conv = load(spark, sf_dir, "conversations", "conv_id", "text")
    replay(conv, key_slice("conv_id", ARRIVALS), ARRIVALS, lambda stream: sq.run_sliding_batches(
        stream, lambda b: sq.count_words(sq.words(b, "text")), ["word"], WINDOW_BATCHES, sink, checkpoint))
    return spark.read.parquet(f"{sink}/totals").select(F.col("batch_id").cast("long").alias("batch"), "word", "n")


@query("stream_progress", sql=f"""
SELECT (conv_id % {SLICES} + {SLICES}) % {SLICES} AS batch, count(*) AS rows_read FROM conversations GROUP BY 1
""", note="T4: rows read by every micro-batch, as a query listener sees them")
def stream_progress(spark, sf_dir):
    sink, checkpoint = scratch_path(spark, "sink-progress"), scratch_path(spark, "ckpt")
    with sq.ProgressLog(spark) as log:
        _replay_conversations(spark, sf_dir, lambda stream: sq.run_per_batch(
            stream, lambda b: sq.count_words(sq.words(b, "text")), sink, checkpoint))
    return log.table().filter("rows_read > 0").select(F.col("batch_id").alias("batch"), "rows_read")


@query("stream_source_lines", sql="""
SELECT line, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations WHERE text IS NOT NULL)
GROUP BY line
""", note="S10: lines of growing files, each read once over two runs of one query")
def stream_source_lines(spark, sf_dir):
    landing, sink, checkpoint = (scratch_path(spark, n) for n in ("lines", "sink-lines", "ckpt"))
    conv = load(spark, sf_dir, "conversations", "conv_id", "text").filter("text IS NOT NULL")
    for half in range(2):  # the query stops, more lines arrive, and it goes on from its checkpoint
        conv.filter(key_slice("conv_id", 2) == half).select("text").write.mode("append").text(landing)
        lines = line_stream(spark, landing).select("value")
        sq.run_aggregate(lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n")), sink, "update", checkpoint)
    return sq.read_latest(spark, sink, ["line"], ["n"])
