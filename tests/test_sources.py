"""File sources, the event log on disk, catalog tables and batch sinks."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from rillstream.operators import slices
from rillstream.sinks import tables
from rillstream.sources import eventlog, files

TRIP_HEADER = ",".join(files.TRIP_COLUMNS)
TRIPS = ["1,2019-01-01 00:46:40,2019-01-01 00:53:20,1,1.50,1,N,151,239,1,7,0.5,0.5,1.65,0,0.3,9.95",
         '2,2019-01-01 00:59:47,2019-01-01 01:18:59,,2.60,1,N,239,246,1,14,0.5,0.5,1,0,0.3,16.3']
EVENTS = ['{"id":1,"key":"a","message":"one"}', '{"id":2,"key":"b","message":"two"}',
          '{"id":3,"key":"a","message":"three"}', '{"id":4,"key":"c","message":"four"}',
          '{"id":5,"key":"c","message":"five"}']


def test_trip_csv(spark, tmp_path):
    path = tmp_path / "trips.csv.gz"
    path.write_bytes(gzip.compress("\n".join([TRIP_HEADER, *TRIPS]).encode()))
    trips = files.with_ride_ids(files.trip_csv(spark, str(path)))
    rows = trips.orderBy("ride_id").collect()
    assert [r["ride_id"] for r in rows] == [1, 2]
    assert trips.columns == [*files.TRIP_USED, "ride_id"]
    assert (rows[0]["pickup_time"].minute, rows[0]["dest_location_id"]) == (46, 239)
    assert rows[1]["passenger_count"] is None


def test_short_trip_record_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("\n".join([TRIP_HEADER, TRIPS[0].rsplit(",", 1)[0]]))
    with pytest.raises(Exception, match="(?i)malformed"):
        files.trip_csv(spark, str(path)).collect()


def test_zone_csv_honours_quotes(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Airport, north",EWR\n')
    assert files.zone_csv(spark, str(path)).first()["zone"] == "Airport, north"


def written_log(spark, tmp_path):
    source = tmp_path / "events.json"
    source.write_text("\n".join(EVENTS))
    rows = files.json_lines(spark, str(source))
    assert rows.columns == ["id", "key", "message"]
    log = str(tmp_path / "log")
    tables.append_log(
        rows.select(F.to_json(F.struct("*")).alias("event"), F.col("key").alias("routing_key"),
                    F.timestamp_seconds("id").alias("event_time"), "id"),
        log, "examples", "demo", "id")
    return log


def test_log_round_trip(spark, tmp_path):
    log = written_log(spark, tmp_path)
    rows = eventlog.read_log(spark, log, "examples", "demo").collect()
    assert sorted(r["event"] for r in rows) == EVENTS
    segments = {}
    for r in rows:
        segments.setdefault(r["routing_key"], set()).add(r["segment_id"])
    assert all(len(s) == 1 for s in segments.values())
    by_key = sorted((r["offset"], r["event"]) for r in rows if r["routing_key"] == "a")
    assert [e for _, e in by_key] == [EVENTS[0], EVENTS[2]]
    assert eventlog.read_log(spark, log, "examples", "other").count() == 0


def test_second_append_goes_on_after_the_first(spark, tmp_path):
    log = written_log(spark, tmp_path)
    first = {(r["stream"], r["segment_id"]): r["offset"]
             for r in slices.checkpoint_cut(eventlog.read_log(spark, log)).collect()}
    more = spark.range(5, 300).select(F.col("id").cast("string").alias("event"),
                                      F.lit("a").alias("routing_key"),
                                      F.timestamp_seconds("id").alias("event_time"), "id")
    tables.append_log(more, log, "examples", "demo", "id", width=64)
    both = eventlog.read_log(spark, log)
    assert both.count() == 300
    assert both.select("segment_id", "offset").distinct().count() == 300
    start = {segment: at for (_, segment), at in first.items()}
    assert slices.read_slice(both, start=start).count() >= 295
    plan = slices.read_slice(both, {0: 1, 1: 3}, {0: 9, 1: 5}, others=False)._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [((segment_id" in scan
    assert "GreaterThanOrEqual(offset,1)" in scan and "LessThan(offset,9)" in scan


def test_catalog_insert_and_describe(spark, tmp_path):
    eventlog.create_stream_table(spark, "shop", "behavior",
                                 "user_id int, item_id int, behavior string, ts timestamp_ntz")
    eventlog.create_stream_table(spark, "shop", "midnight",
                                 "user_id string, item_id string, ts timestamp_ntz")
    spark.sql("INSERT INTO shop.behavior VALUES (1, 2, 'buy', TIMESTAMP_NTZ'2024-01-01 02:59:59'), "
              "(1, 3, 'buy', TIMESTAMP_NTZ'2024-01-01 03:00:00'), "
              "(1, 4, 'pv', TIMESTAMP_NTZ'2024-01-01 01:00:00')")
    picked = spark.table("shop.behavior").where("behavior = 'buy' AND hour(ts) <= 2").select(
        F.col("item_id").cast("string").alias("item_id"), "ts",
        F.col("user_id").cast("string").alias("user_id"))
    tables.insert_select(picked, "shop.midnight")
    assert [r["item_id"] for r in spark.table("shop.midnight").collect()] == ["2"]
    eventlog.create_like(spark, "shop.copy", "shop.behavior")
    assert spark.table("shop.copy").columns == spark.table("shop.behavior").columns
    names = [r["col_name"] for r in eventlog.describe_stream(spark, "shop", "behavior").collect()]
    assert names[:3] == ["user_id", "item_id", "behavior"]
    for name in ("behavior", "midnight", "copy"):
        spark.sql(f"DROP TABLE shop.{name}")


def test_read_committed(spark):
    log = spark.createDataFrame([(1, "t1"), (2, "t2"), (3, None), (4, "t1"), (5, "t9")],
                                "offset long, txn_id string")
    status = spark.createDataFrame([("t1", "COMMITTED"), ("t2", "ABORTED")],
                                   "txn_id string, status string")
    got = tables.read_committed(log, status)
    assert sorted(r["offset"] for r in got.collect()) == [1, 3, 4]


def test_cuts(spark):
    log = spark.createDataFrame([("s", i % 2, i, str(i)) for i in range(10)],
                                "stream string, segment_id int, offset long, event string")
    cuts = slices.cuts_by_index(log, 3, 7)
    assert sorted(r["offset"] for r in slices.read_slices(log, cuts).collect()) == [3, 4, 5, 6]
    open_end = slices.cuts_by_index(log, 3, 99)
    assert {r["end_offset"] for r in open_end.collect()} == {None}
    assert slices.read_slices(log, open_end).count() == 7
    at_end = slices.cuts_by_index(log, 10, 10)
    assert slices.read_slices(log, at_end).count() == 0
    head = slices.read_slice(log, end={0: 4, 1: 5})
    tail = slices.read_slice(log, start={0: 4, 1: 5})
    assert sorted(r["offset"] for r in slices.union_streams([head, tail]).collect()) == list(
        range(10))


@pytest.mark.parametrize("width", [4, 7, 1000])
def test_positions_by_blocks(spark, width):
    """Offsets with gaps, a second stream that is short, bounds inside, at the edge of and beyond blocks."""
    offsets = {"s": [i for i in range(60) if i % 7 != 3], "t": [5, 6]}
    rows = [(s, o % 3, o, "day" + str(o // 10)) for s in offsets for o in offsets[s]]
    log = spark.createDataFrame(rows, "stream string, segment_id int, offset long, day string").repartition(3)
    for first, last in ((0, 1), (3, 20), (8, 8), (50, 52), (51, 90)):
        got = {(r["stream"], r["segment_id"]): (r["start_offset"], r["end_offset"])
               for r in slices.cuts_by_index(log, first, last, width=width).collect()}
        want = {}
        for s, known in offsets.items():
            for segment in {o % 3 for o in known}:
                mine = [(i, o) for i, o in enumerate(known) if o % 3 == segment]
                start, end = (min((o for i, o in mine if i >= b), default=mine[-1][1] + 1) for b in (first, last))
                want[s, segment] = (start, end if len(known) >= last else None)
        assert got == want
    ranges = slices.index_ranges(log, F.col("day"), width=width).collect()
    want = {}
    for s, known in offsets.items():
        for i, o in enumerate(known):
            low, _ = want.get((s, f"day{o // 10}"), (i, i))
            want[s, f"day{o // 10}"] = (low, i + 1)
    assert {(r["stream"], r["grp"]): (r["first_index"], r["end_index"]) for r in ranges} == want


def test_csv_sink_and_retention(spark, tmp_path):
    df = spark.range(0, 7200, 60).select("id", F.timestamp_seconds("id").alias("at"))
    out = str(tmp_path / "kept")
    tables.compact_retention(df, out, "at", "1 hour")
    assert spark.read.parquet(out).agg(F.min("id")).first()[0] == 3600
    csv = str(tmp_path / "csv")
    tables.write_csv(df.select("id"), csv)
    tables.write_csv(df.select("id").limit(3), csv)
    assert spark.read.csv(csv).count() == 3
    tables.discard(df)


def test_checkpoint_folder_is_taken_from_the_session(spark):
    from rillstream.session import shared_dir
    assert shared_dir(spark) == shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
