"""Live jobs: restarts, exactly-once output, late data, and equality with the batch forms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rillstream.operators import alerts, slices, windows
from rillstream.sources import files
from rillstream.streaming import sinks, stateful
from rillstream.streaming import windows as live

SCHEMA = "offset long, sensor int, at timestamp, value double, event int"


def batch_files(spark, path, parts):
    """One file per part, in order."""
    for number, rows in enumerate(parts):
        (spark.createDataFrame(rows, "offset long, sensor int, seconds long, value double, event int")
         .select("offset", "sensor", F.timestamp_seconds("seconds").alias("at"), "value", "event")
         .coalesce(1).write.mode("append").parquet(f"{path}/p{number}"))


def numbered(count, start=0):
    return [(i, i % 3, i, float((i * 37) % 11 - 5), (i * 7) % 7 + 1)
            for i in range(start, start + count)]


def stream_of(spark, path):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            .parquet(f"{path}/p*"))


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    batch_files(spark, path, [numbered(100), numbered(100, 100), numbered(100, 200)])
    return path


def run(stream, tmp_path, name):
    sinks.append_files(stream, str(tmp_path / name), str(tmp_path / f"{name}-c"),
                       once=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_stateful_alerts_across_batches(spark, source, tmp_path):
    def shaped(df):
        return df.select(F.col("sensor").alias("source_address"), "event",
                         F.col("at").alias("event_time"), F.lit("n").alias("network_id"),
                         F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), "offset")

    got = run(stateful.anomaly_alerts(shaped(stream_of(spark, source))), tmp_path, "alerts")
    want = alerts.anomaly_alerts(shaped(spark.read.parquet(f"{source}/p*")))
    columns = ["source_address", "offset", "state"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, want.select(columns).collect()))


def test_bookmarks_across_batches(spark, source, tmp_path):
    hit = F.col("value") < 0
    got = run(stateful.bookmark_slices(stream_of(spark, source), "sensor", "offset", hit),
              tmp_path, "slices")
    want = slices.bookmark_slices(spark.read.parquet(f"{source}/p*"), "sensor", "offset", hit)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_closed_windows_equal_batch(spark, source, tmp_path):
    got = run(live.hopping_count(stream_of(spark, source), "at", "5 seconds", "30 seconds",
                                 "10 seconds", ["sensor"], "sensor"), tmp_path, "hops")
    want = windows.hopping_count(spark.read.parquet(f"{source}/p*"), "at", "30 seconds",
                                 "10 seconds", ["sensor"], "sensor").where(
        F.col("window_end") <= F.timestamp_seconds(F.lit(299 - 5)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_dropped_live_and_listed_by_the_audit(spark, tmp_path):
    path = str(tmp_path / "late")
    parts = [[(0, 0, 100, 1.0, 1)], [(1, 0, 500, 1.0, 1)], [(2, 0, 501, 1.0, 1)],
             [(3, 0, 90, 1.0, 1), (4, 0, 495, 1.0, 1)], [(5, 0, 5000, 1.0, 1)]]
    batch_files(spark, path, parts)
    got = run(live.windowed(stream_of(spark, path), "at", "10 seconds", "60 seconds", ["sensor"],
                            [F.count(F.lit(1)).alias("n")]), tmp_path, "out")
    counts = {r["window_start"].timestamp(): r["n"] for r in got.collect()}
    assert counts == {60.0: 1, 480.0: 3}
    audit = windows.late_rows(spark.read.parquet(f"{path}/p*"), "at", "offset", "10 seconds",
                              "60 seconds")
    assert [r["offset"] for r in audit.collect()] == [3]


def test_slowest_source_holds_the_watermark(spark, tmp_path):
    fast, slow = str(tmp_path / "fast"), str(tmp_path / "slow")
    batch_files(spark, fast, [[(i, 0, i, 1.0, 1) for i in range(0, 1000, 10)]])
    batch_files(spark, slow, [[(i, 0, i, 1.0, 1) for i in range(0, 100, 10)]])
    both = live.watermarked(stream_of(spark, fast), "at", "0 seconds").unionByName(
        live.watermarked(stream_of(spark, slow), "at", "0 seconds"))
    counts = both.groupBy(F.window("at", "30 seconds").alias("w")).agg(F.count("*").alias("n"))
    got = run(counts.select(F.col("w.start").alias("start"), "n"), tmp_path, "union")
    assert {(r["start"].timestamp(), r["n"]) for r in got.collect()} == {
        (0.0, 6), (30.0, 6), (60.0, 6)}


def test_batch_scan_refuses_a_stream(spark, source):
    with pytest.raises(ValueError, match="batch operator"):
        slices.bookmark_slices(stream_of(spark, source), "sensor", "offset", F.col("value") < 0)


def test_restart_goes_on_where_it_stopped(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "copy"), str(tmp_path / "copy-c")
    sinks.append_files(stream_of(spark, source), out, checkpoint, once=True).awaitTermination()
    batch_files(spark, source + "/more", [numbered(50, 300)])
    spark.read.parquet(f"{source}/more/p0").write.parquet(f"{source}/p9")
    sinks.append_files(stream_of(spark, source), out, checkpoint, once=True).awaitTermination()
    rows = [r["offset"] for r in spark.read.parquet(out).select("offset").collect()]
    assert sorted(rows) == list(range(350))


def failing_once(write):
    """Hand a batch to ``write`` and fail after the first write of batch 1."""
    failed = []

    def handle(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("injected failure")
    return handle


@pytest.mark.parametrize("exact", [True, False])
def test_failure_after_write(spark, source, tmp_path, exact):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def write(batch, batch_id):
        if exact:
            sinks.write_batch(batch, batch_id, out)
        else:
            batch.write.mode("append").parquet(f"{out}/batch=0")

    handle = failing_once(write)
    with pytest.raises(Exception, match="injected failure"):
        sinks.for_each_batch(stream_of(spark, source), handle, checkpoint,
                             once=True).awaitTermination()
    sinks.for_each_batch(stream_of(spark, source), handle, checkpoint,
                         once=True).awaitTermination()
    rows = [r["offset"] for r in sinks.read_batches(spark, out).select("offset").collect()]
    assert set(rows) == set(range(300))
    assert len(rows) == (300 if exact else 400)


def test_newest_document_wins(spark, source, tmp_path):
    stream = live.windowed(stream_of(spark, source), "at", "0 seconds", "10 seconds", ["sensor"],
                           [F.count(F.lit(1)).alias("n")])
    path = str(tmp_path / "docs")
    sinks.upsert_documents(stream, path, str(tmp_path / "c"), "sensor", "window_end",
                           once=True).awaitTermination()
    docs = sinks.current_documents(spark, path, "sensor", "window_end").collect()
    assert len(docs) == 3 and {r["window_end"].timestamp() for r in docs} == {290.0}


def test_words_in_processing_time(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("aa bb cc aa\n")
    counts = live.word_count(files.text_stream(spark, str(lines)))
    query = (counts.writeStream.outputMode("update").format("memory").queryName("live_words")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.table("live_words").groupBy("word").agg(F.max("cnt")).collect()
    assert {tuple(r) for r in got} == {("aa", 2), ("bb", 1), ("cc", 1)}


def test_generated_events(spark, tmp_path):
    stream = files.rate_stream(spark, rows_per_batch=10)
    out = str(tmp_path / "rate")
    query = sinks.append_files(stream, out, str(tmp_path / "c"), trigger="0 seconds")
    try:
        query.awaitTermination(5)
    finally:
        query.stop()
    rows = [int(r["event"]) for r in spark.read.parquet(out).select("event").collect()]
    assert sorted(rows) == list(range(len(rows))) and len(rows) >= 10


def test_console_and_discard(spark, source, tmp_path):
    stream = stream_of(spark, source).select("offset")
    query = sinks.print_rows(stream, str(tmp_path / "c1"), once=True)
    query.awaitTermination()
    assert sum(p["rows"] for p in sinks.progress(query)) == 300
    sinks.discard(sinks.rebalanced(stream, 4), str(tmp_path / "c2"), once=True).awaitTermination()
    out = str(tmp_path / "plain")
    sinks.at_least_once(stream, out, str(tmp_path / "c3"), once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 300


def test_live_table_takes_the_later_log_file(spark, tmp_path):
    """File numbers that outgrow their leading zeros, within a batch and between batches."""
    schema = "id string, op string, after struct<value:double>, file string, pos long, row int"
    rows = [("x", "u", (1.0,), "binlog.999999", 9, 0), ("x", "u", (2.0,), "binlog.1000000", 1, 0)]
    for i, part in enumerate((rows, [("y", *rows[1][1:])], [("y", *rows[0][1:])])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sinks.keep_latest(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert {tuple(r) for r in sinks.current_table(spark, str(tmp_path / "out")).collect()} == {("x", 2.0), ("y", 2.0)}


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.glob("level=*/slot=*"))


def least(df):
    return df.groupBy("sensor").agg(F.min("at").alias("at"))


def newest(df):
    return df.groupBy("sensor").agg(F.max("at").alias("at"))


def test_stored_batches_are_reduced_in_levels(spark, tmp_path):
    """Twenty-one batches in slots of two; a retry of the last one and one of another job change nothing."""
    path = tmp_path / "levels"
    seen = {}
    for number in range(21):
        batch = spark.createDataFrame([(number % 5, number), (9, number)], "sensor int, at long").coalesce(1)
        seen[number % 5] = seen[9] = number
        sinks.write_levels(batch, number, str(path), newest, fan=2)
        if number % 7 == 0:
            got = newest(sinks.read_levels(spark, str(path)))
            assert {r["sensor"]: r["at"] for r in got.collect()} == seen
    assert len(folders(path)) <= 2 * 5 and sinks.stored_until(spark, str(path)) == 20
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    sinks.write_levels(batch, 20, str(path), newest, fan=2)
    with pytest.raises(ValueError, match="one checkpoint per folder"):
        sinks.write_levels(batch, 3, str(path), newest, fan=2)
    assert before == {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("call", [1, 2, 3])
def test_failure_between_the_parts_of_a_batch(spark, tmp_path, call):
    """Batch 3 fails at its own write, the first or the second reduction; the retry stores it in full."""
    path = str(tmp_path / "levels")

    def batch(number):
        return spark.createDataFrame([(number, 10 - number), (9, 10 - number)], "sensor int, at long").coalesce(1)

    for number in range(3):
        sinks.write_levels(batch(number), number, path, least, fan=2)
    calls = []

    def failing(df):
        calls.append(1)
        if len(calls) == call:
            raise RuntimeError("injected failure")
        return least(df)

    with pytest.raises(RuntimeError, match="injected failure"):
        sinks.write_levels(batch(3), 3, path, failing, fan=2)
    assert sinks.stored_until(spark, path) == 2
    sinks.write_levels(batch(3), 3, path, least, fan=2)
    got = least(sinks.read_levels(spark, path)).collect()
    assert {r["sensor"]: r["at"] for r in got} == {0: 10, 1: 9, 2: 8, 3: 7, 9: 7}
