"""Streaming: stream results equal batch results; late rows; empty batches; previews."""

import datetime as dt

from pyspark.sql import functions as F

from lodestar.session import scratch_path
from lodestar.streaming import queries as sq
from lodestar.streaming.replay import file_stream, key_slice, range_slice, replay


def test_per_batch_preview_and_counts(spark):
    lines = spark.createDataFrame([(i, f"w{i % 3} x") for i in range(30)], "id int, text string")
    sink, checkpoint = scratch_path(spark, "t-preview"), scratch_path(spark, "t-ckpt")
    replay(lines, key_slice("id", 3), 3, lambda s: sq.run_per_batch(s, sq.batch_preview(10), sink, checkpoint))
    out = spark.read.parquet(sink)
    assert out.select("batch_id").distinct().count() == 3
    assert out.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 10


def test_window_counts_late_row_and_empty_batch(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=i), "a") for i in range(0, 120, 2)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string")
    path, sink, checkpoint = (scratch_path(spark, n) for n in ("t-late", "t-late-sink", "t-late-ckpt"))

    def step(stream):
        agg = sq.sliding_counts(stream, "ts", "event_type", "15 minutes", "3 minutes", watermark="10 minutes")
        sq.run_aggregate(agg, sink, "update", checkpoint)

    replay(events, range_slice(events, "ts", 2), 2, step, path)
    # a late row (two hours behind the newest event) arrives last
    spark.createDataFrame([(999, base, "a")], events.schema).write.mode("append").parquet(path)
    step(file_stream(spark, path, events.schema))
    got = sq.flatten_windows(sq.read_latest(spark, sink, ["w", "event_type"], ["n"]))
    # the late row's windows were already final: it must not change them
    first = got.filter(F.col("window_start") == F.lit(base)).first()["n"]
    assert first == 8  # minutes 0,2,...,14 only
    # complete mode keeps everything, and an empty input folder gives an empty result
    empty = scratch_path(spark, "t-empty")
    events.limit(0).write.parquet(empty)
    agg2 = sq.sliding_counts(file_stream(spark, empty, events.schema), "ts", "event_type", "15 minutes", "3 minutes")
    sink2 = scratch_path(spark, "t-empty-sink")
    sq.run_aggregate(agg2, sink2, mode="complete")


def test_processing_time_trigger_start_stop(spark):
    lines = spark.createDataFrame([(i, "a b a") for i in range(12)], "id int, text string")
    path = scratch_path(spark, "t-landing")
    lines.repartition(2).write.parquet(path)
    stream = file_stream(spark, path, lines.schema, max_files_per_trigger=1)
    sink = scratch_path(spark, "t-trigger")
    sq.run_aggregate(sq.count_words(sq.words(stream, "text")), sink, mode="update", trigger_seconds=1)
    got = dict((r["word"], r["n"]) for r in sq.read_latest(spark, sink, ["word"], ["n"]).collect())
    assert got == {"a": 24, "b": 12}
    assert not any(q.isActive for q in spark.streams.active)


def test_stream_equals_batch_on_same_rows(spark):
    lines = spark.createDataFrame([(i, f"w{i % 5} w{i % 7}  x") for i in range(200)], "id int, text string")
    sink, checkpoint = scratch_path(spark, "t-eq"), scratch_path(spark, "t-eq-ckpt")
    replay(lines, key_slice("id", 4), 4, lambda s: sq.run_per_batch(
        s, lambda b: sq.count_words(sq.words(b, "text")), sink, checkpoint))
    streamed = spark.read.parquet(sink).groupBy("word").agg(F.sum("n").alias("n"))
    batch = sq.count_words(sq.words(lines, "text"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_each_micro_batch_counts_only_its_own_rows(spark):
    # one file per slice, one file per trigger: every batch is exactly one slice
    rows = [(i, i // 10, f"w{i % 4} w{i % 3} z") for i in range(40)]
    lines = spark.createDataFrame(rows, "id int, slice int, text string")
    path = scratch_path(spark, "t-slices")
    lines.repartition(4, "slice").write.partitionBy("slice").parquet(path)
    stream = file_stream(spark, path, lines.schema, max_files_per_trigger=1)
    sink = scratch_path(spark, "t-slices-sink")

    def per_batch(batch):
        return batch.select("slice", F.explode(F.split("text", " ")).alias("word")) \
            .groupBy("slice", "word").count()

    sq.run_per_batch(stream, per_batch, sink)
    out = spark.read.parquet(sink)
    # each batch holds a single slice ...
    assert out.groupBy("batch_id").agg(F.countDistinct("slice").alias("k")).filter("k != 1").count() == 0
    # ... and its counts equal a batch count over that slice alone
    streamed = sorted((r["slice"], r["word"], r["count"]) for r in out.collect())
    batch = lines.select("slice", F.explode(F.split("text", " ")).alias("word")).groupBy("slice", "word").count()
    assert streamed == sorted((r["slice"], r["word"], r["count"]) for r in batch.collect())


def test_no_time_limit_unless_asked(spark):
    import inspect

    assert all(inspect.signature(f).parameters["timeout_s"].default is None for f in (sq.run_per_batch, sq.run_aggregate))


def test_replay_slices_cover_every_row_once(spark):
    rows = [(i, None if i == 5 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(-20, 20)] + [(None, dt.datetime(2024, 1, 1))] * 3
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    for number in (key_slice("id", 4), range_slice(df, "ts", 4)):
        counts = {r[0]: r[1] for r in df.groupBy(number).count().collect()}
        assert set(counts) == {0, 1, 2, 3} and sum(counts.values()) == len(rows)


def test_complete_mode_keeps_the_last_result_until_the_next_is_whole(spark):
    path, sink, checkpoint = (scratch_path(spark, n) for n in ("t-c", "t-c-sink", "t-c-ckpt"))
    words = spark.createDataFrame([(i, "a b") for i in range(6)], "id int, text string")
    replay(words, key_slice("id", 3), 3, lambda s: sq.run_aggregate(sq.count_words(sq.words(s, "text")), sink, "complete", checkpoint), path)
    assert spark.read.parquet(f"{sink}/complete").select("batch_id").distinct().count() == 3
    assert {tuple(r) for r in sq.read_complete(spark, sink).collect()} == {("a", 6), ("b", 6)}


def test_windows_do_not_depend_on_the_session_zone(spark):
    events = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30), "a")], "ts timestamp_ntz, event_type string")
    before = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for zone in ("UTC", "Europe/Berlin", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got.append(sorted(map(tuple, sq.flatten_windows(sq.sliding_counts(events, "ts", "event_type", "15 minutes", "3 minutes")).collect())))
            assert spark.conf.get("spark.sql.session.timeZone") == zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == got[1] == got[2] and len(got[0]) == 5


def test_sliding_batches_forget_what_leaves(spark):
    # a word of batch 0 only; batches 3 and 4 are empty, so after batch 4 the state of length 2 has no row
    rows = [(0, "once a"), (1, "a b"), (2, "b")]
    lines = spark.createDataFrame(rows, "slice int, text string")
    sink, checkpoint = scratch_path(spark, "t-arrivals"), scratch_path(spark, "t-ckpt")
    replay(lines, F.col("slice"), 5, lambda s: sq.run_sliding_batches(
        s, lambda b: sq.count_words(sq.words(b, "text")), ["word"], 2, sink, checkpoint))
    read = lambda i: {r["word"]: r["n"] for r in spark.read.parquet(f"{sink}/totals/batch_id={i}").collect()}
    assert [read(i) for i in range(5)] == [{"once": 1, "a": 1}, {"once": 1, "a": 2, "b": 1}, {"a": 1, "b": 2}, {"b": 1}, {}]


def test_panes_add_up_to_windows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=97 * i), "ab"[i % 2]) for i in range(150)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string")
    whole = sq.flatten_windows(sq.sliding_counts(events, "ts", "event_type", "15 minutes", "3 minutes"))
    panes = sq.pane_counts(events, "ts", "event_type", "3 minutes")
    assert panes.agg(F.sum("n")).first()[0] == len(rows)  # every event once
    assert sorted(map(tuple, sq.flatten_windows(sq.windows_of_panes(panes, 5, "event_type")).collect())) == sorted(map(tuple, whole.collect()))


def test_late_rows_with_panes(spark):
    base = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(base + dt.timedelta(minutes=i), "a") for i in range(0, 120, 2)], "ts timestamp_ntz, event_type string")
    path, sink, checkpoint = (scratch_path(spark, n) for n in ("t-late", "t-late-sink", "t-late-ckpt"))
    step = lambda s: sq.run_aggregate(sq.pane_counts(s, "ts", "event_type", "3 minutes", watermark="10 minutes"), sink, "update", checkpoint)
    replay(events, range_slice(events, "ts", 2), 2, step, path)
    spark.createDataFrame([(base, "a")], events.schema).write.mode("append").parquet(path)
    step(file_stream(spark, path, events.schema))
    panes = sq.read_latest(spark, sink, ["w", "event_type"], ["n"])
    first = sq.flatten_windows(sq.windows_of_panes(panes, 5, "event_type")).filter(F.col("window_start") == F.lit(base)).first()["n"]
    assert first == 8  # the late row's pane was final


def test_query_goes_on_after_a_failure_between_write_and_commit(spark):
    lines = spark.createDataFrame([(i, f"w{i % 3}") for i in range(30)], "id int, text string")
    path, sink, checkpoint = (scratch_path(spark, n) for n in ("t-fail", "t-fail-sink", "t-fail-ckpt"))
    attempts = []

    def step(stream):
        def per_batch(batch):
            return sq.count_words(sq.words(batch, "text"))

        def write(batch, batch_id):
            per_batch(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
            attempts.append(batch_id)
            if attempts == [0, 1]:  # the sink has batch 1, the checkpoint does not
                raise RuntimeError("lost")

        sq._run(write, stream, "append", checkpoint, None, None)

    import pytest

    with sq.ProgressLog(spark) as log, pytest.raises(Exception, match="lost"):
        replay(lines, key_slice("id", 3), 3, step, path)
    rest = lines.filter(key_slice("id", 3) == 2)
    rest.write.mode("append").parquet(path)
    with sq.ProgressLog(spark) as more:
        step(file_stream(spark, path, lines.schema))  # the restart runs batch 1 again, then the new files
    assert attempts == [0, 1, 1, 2]
    got = {r["word"]: r["n"] for r in spark.read.parquet(sink).groupBy("word").agg(F.sum("n").alias("n")).collect()}
    assert got == {"w0": 10, "w1": 10, "w2": 10}  # no row twice, none missing
    committed = [tuple(r) for r in log.table().unionByName(more.table()).filter("rows_read > 0").select("batch_id", "rows_read").collect()]
    assert sorted(committed) == [(0, 10), (1, 10), (2, 10)]


def test_line_source_reads_whole_lines_once(spark, tmp_path):
    from lodestar.streaming.lines import line_source, line_stream

    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.txt").write_bytes("one\ntwo é\n\nthr".encode())
    (folder / "_hidden").write_bytes(b"no\n")
    sink, checkpoint = scratch_path(spark, "t-lines"), scratch_path(spark, "t-lines-ckpt")
    run = lambda: sq.run_per_batch(line_stream(spark, str(folder), split_bytes=3), lambda b: b, sink, checkpoint)
    read = lambda: sorted((r["file"], r["at"], r["value"]) for r in spark.read.parquet(sink).collect())
    run()
    first = [("a.txt", 0, "one"), ("a.txt", 4, "two é"), ("a.txt", 11, "")]
    assert read() == first  # the unfinished line waits
    with (folder / "a.txt").open("ab") as f:
        f.write(b"ee\nfour\n")
    (folder / "b.txt").write_bytes(b"x" * 1000 + b"\n")
    run()
    assert read() == [*first, ("a.txt", 12, "three"), ("a.txt", 18, "four"), ("b.txt", 0, "x" * 1000)]
    run()  # nothing new
    assert len(read()) == 6
    reader = line_source()(options={"path": str(tmp_path / "missing")}).streamReader(None)
    assert reader.latestOffset() == {}
