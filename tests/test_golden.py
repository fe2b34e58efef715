"""Small inputs with known results."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rillstream.functions import scalars
from rillstream.operators import (
    alerts, changes, chat, duplicates, joins, keyed_maps, metrics, slices, windows, words)


def ts(text):
    return dt.datetime.fromisoformat(text)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_word_count(spark):
    lines = spark.createDataFrame([("aa bb cc aa",)], "line string")
    assert dict(words.word_count(lines, "line").collect()) == {"aa": 2, "bb": 1, "cc": 1}


def test_tokens_keep_inner_blanks_only(spark):
    lines = spark.createDataFrame([(" a  b  ",), ("",), ("  ",)], "line string")
    got = [r["t"] for r in lines.select(words.tokens(F.col("line")).alias("t")).collect()]
    assert got == [["", "a", "", "b"], [""], []]


def test_sensor_summary(spark):
    """Readings swing 20 around ten times the length of the place name; days start at 08:00 UTC."""
    base = 10 * len("Arizona")
    lines = [(8 * 3600_000 + i * 60_000, 2, "Arizona", base + 20 * math.sin(i * math.pi / 30))
             for i in range(1440)]
    df = (spark.createDataFrame(lines, "ms long, id int, location string, temp double")
          .select(scalars.sensor_line(F.col("ms"), F.col("id"), F.col("location"),
                                      F.col("temp").cast("float")).alias("line")))
    assert df.where(F.length("line") != 100).count() == 0
    readings = df.select(scalars.sensor_reading(F.col("line")).alias("r")).select("r.*")
    out = windows.tumbling(
        readings.withColumn("at", F.timestamp_millis("timestamp")), "at", "1 day", ["sensor_id"],
        [F.min_by("timestamp", "timestamp").alias("start"),
         F.max_by("location", "timestamp").alias("location"),
         F.min("temp").alias("low"), F.max("temp").alias("high")],
        ["start", "location", "low", "high"], "8 hours").collect()
    assert [tuple(r)[0:1] + tuple(r)[3:] for r in out] == [(2, 28800000, "Arizona", 50.0, 90.0)]


def test_chained_averages_are_stamped_with_window_end(spark):
    start = 1500000001000
    df = (spark.range(2000).select(
        F.lit(0).alias("id"), F.timestamp_millis(F.lit(start) + F.col("id") * 1000).alias("ts"),
        F.sin(F.col("id") * 0.01 * math.pi).alias("value")))
    first = windows.averages(df, "ts", "10 seconds", "id", "value")
    row = first.orderBy("ts").first()
    assert row["ts"] == ts("2017-07-14T02:40:10")
    want = sum(math.sin(0.01 * math.pi * i) for i in range(9)) / 9
    assert row["value"] == pytest.approx(want, abs=1e-7)
    second = windows.chained_averages(df, "ts", ["10 seconds", "500 seconds"], "id", "value")
    assert [r["ts"] for r in second.orderBy("ts").collect()][:2] == [
        ts("2017-07-14T02:48:20"), ts("2017-07-14T02:56:40")]


def test_sine_slices_hold_half_a_period(spark):
    df = spark.range(10000).select(
        F.lit(0).alias("sensor"), F.col("id").alias("offset"),
        F.sin(F.col("id") * 0.01).alias("value"))
    found = slices.bookmark_slices(df, "sensor", "offset", F.col("value") < 0, width=256)
    counts = slices.slice_counts(df, found, "sensor", "offset", F.col("value") < 0)
    sizes = [r["n"] for r in counts.collect()]
    assert len(sizes) == 15 and set(sizes) <= {314, 315}


def test_clean_sequence_raises_no_alert(spark):
    rows = [(1, c, i) for i, c in enumerate([1, 2, 5, 7, 3, 4, 7, 3, 2, 5, 7])]
    rows += [(2, 1, 100), (2, 7, 101), (2, 2, 102), (2, 6, 103)]
    df = spark.createDataFrame(rows, "source_address int, event int, offset long")
    got = {(r["offset"], r["state"]) for r in alerts.anomaly_alerts(df).collect()}
    assert got == {(101, "W"), (102, "INITIAL"), (103, "INITIAL")}


def test_alert_pages_join_to_whole_list(spark):
    rows = [("n", ts("2024-01-01T00:00:00"), i % 3, i, 1.0, 2.0) for i in range(50)]
    df = spark.createDataFrame(
        rows, "network_id string, event_time timestamp, source_address int, offset long, "
              "lat double, lon double")
    pages = alerts.alert_documents(df, page_rows=16).orderBy("page").collect()
    assert len(pages) == 4
    assert [ip for p in pages for ip in p["ip_addresses"]] == [f"0.0.0.{i % 3}" for i in range(50)]
    summary = alerts.alert_summary(df).first()
    assert (summary["cnt"], summary["location"]) == (50, "1.0,2.0")


RECORDS = [
    ('{"before":{"id":"AAPL","value":140.69},"after":{"id":"AAPL","value":140.5},"source":{"ts_ms":'
     '1634716546000,"db":"stock","table":"stock","file":"binlog.000002","pos":24961,"row":0},'
     '"op":"u","ts_ms":1634716546543,"transaction":null}'),
    ('{"before":null,"after":{"id":"IBM","value":140.94},"source":{"file":"binlog.000002","pos":'
     '25000,"row":0},"op":"c","ts_ms":1634716546544}'),
    ('{"before":{"id":"IBM","value":140.94},"after":{"id":"IBM","value":140.73},"source":{"file":'
     '"binlog.000002","pos":25272,"row":0},"op":"u","ts_ms":1634716546545}'),
    ('{"before":{"id":"MU","value":67.14},"after":null,"source":{"file":"binlog.000002","pos":'
     '25581,"row":0},"op":"d","ts_ms":1634716546546}'),
    ('{"before":null,"after":{"id":"MU","value":67.14},"source":{"file":"binlog.000001","pos":'
     '99999,"row":0},"op":"r","ts_ms":1634716546000}'),
    ('{"before":null,"after":{"id":"AAPL","value":140.69},"source":{"file":"binlog.000001","pos":'
     '1,"row":0},"op":"r","ts_ms":1634716546000}'),
]


def test_changelog(spark):
    typed = changes.decode(spark.createDataFrame([(r,) for r in RECORDS], "event string"))
    assert dict(changes.latest(typed).collect()) == {"AAPL": 140.5, "IBM": 140.73}
    assert dict(changes.as_of(typed, 1634716546000).collect()) == {"MU": 67.14, "AAPL": 140.69}
    sector = spark.createDataFrame(
        [("AAPL", "Technology"), ("IBM", "Technology"), ("MU", "Technology")],
        "id string, sector string")
    want = {"Technology": pytest.approx((140.5 + 140.73) / 2)}
    assert dict(changes.group_average(changes.latest(typed), sector).collect()) == want
    assert dict(changes.folded_average(changes.retractions(typed), sector).collect()) == want


def test_cumulative_visitors(spark):
    rows = [("a", ts("2024-01-01T00:03:00")), ("a", ts("2024-01-01T00:25:00")),
            ("b", ts("2024-01-01T00:20:00")), ("c", ts("2024-01-01T23:59:00"))]
    df = spark.createDataFrame(rows, "who string, at timestamp_ntz")
    uv = [r["uv"] for r in windows.cumulative_distinct(df, "at", "who").orderBy(
        "window_end").collect()]
    assert len(uv) == 144 and uv[:3] == [1, 1, 2] and uv[-2:] == [2, 3]


def test_hopping_windows(spark):
    df = spark.createDataFrame([("z", ts("2024-01-01T00:07:00")), ("z", ts("2024-01-01T00:08:00")),
                                ("z", ts("2024-01-01T00:14:59"))], "k string, at timestamp_ntz")
    got = windows.hopping_count(df, "at", "15 minutes", "5 minutes", ["k"], "k").orderBy(
        "window_start").collect()
    assert [(r["window_start"].hour * 60 + r["window_start"].minute, r["cnt"]) for r in got] == [
        (23 * 60 + 55, 2), (0, 3), (5, 3), (10, 1)]


def test_duplicates_after_replay(spark):
    values = [-1, *range(50), *range(40, 50), -9999]
    df = spark.createDataFrame(list(enumerate(values)), "offset long, value long")
    found = duplicates.duplicates_report(df, "value", "offset").collect()
    assert sorted(r["value"] for r in found) == list(range(40, 50))
    clean = df.where("offset < 51 or offset = 61")
    assert duplicates.duplicates_report(clean, "value", "offset").count() == 0


def test_percentiles(spark):
    values = [abs(math.sin(i)) * 1000 + (i % 7 == 0) * 5 for i in range(1000)] + [3.5] * 500
    values += [-1.0, -250.25, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    ps = (0.0, 0.001, 0.25, 0.5, 0.95, 0.99, 0.999)
    got = dict(metrics.exact_percentiles(df, "v", ps).collect())
    assert got == {p: ordered[int(p * len(ordered))] for p in ps}


def test_sample_and_count_windows(spark):
    df = spark.range(1000).select(F.col("id").alias("at"), F.col("id").cast("double").alias("v"))
    assert metrics.systematic_sample(df, "at", 300).count() == 334
    out = metrics.count_windows(df, "at", "v", F.lit(16).cast("long"), 300).orderBy("window_no")
    assert [(r["window_no"], r["bytes"], r["max_value"]) for r in out.collect()] == [
        (0, 4800, 299.0), (1, 4800, 599.0), (2, 4800, 899.0)]


def test_scalars(spark):
    assert one(spark, scalars.dotted_address(F.lit(-1062731775))) == "192.168.0.1"
    assert one(spark, scalars.event_letter(F.lit(7))) == "g"
    assert one(spark, scalars.iso_millis(F.lit(1500000001000))) == "2017-07-14T02:40:01.000Z"
    assert one(spark, scalars.wall_clock(F.lit(0))) == ts("1970-01-01T08:00:00")
    assert one(spark, scalars.parse_seconds(F.lit("2019-01-02 03:04:05"))) == ts(
        "2019-01-02T03:04:05")
    assert one(spark, scalars.direct_channel(F.lit("zoe"), F.lit("adam"))) == "adam-zoe"
    assert one(spark, scalars.channel_name(F.lit("a"))) == "#a"
    assert one(spark, scalars.channel_stream(F.lit("#a"))) == "a"
    assert one(spark, scalars.chat_line(F.lit("u"), F.lit("hi"))) == "[u] hi"
    assert one(spark, scalars.padded_key(F.lit("ab"), 5)) == "   ab"
    assert one(spark, scalars.payload_field(F.lit("s:day3:17"), 2)) == "17"
    assert scalars.lower_camel("pu_location_id") == "puLocationId"
    with pytest.raises(Exception, match="key too long"):
        one(spark, scalars.padded_key(F.lit("abcdef"), 5))


def test_map_reads(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "2")], "key string, value string")
    asked = spark.createDataFrame([("a",), ("x",)], "key string")
    assert [r["value"] for r in keyed_maps.get(table, "a").collect()] == ["1"]
    assert dict(keyed_maps.lookup(asked, table, F.lit("-")).collect()) == {"a": "1", "x": "-"}
    assert [r["key"] for r in keyed_maps.contains_keys(asked, table).collect()] == ["a"]
    assert keyed_maps.contains_value(table, "2").first()["found"] is True
    assert keyed_maps.contains_value(table, "9").first()["found"] is False
    assert keyed_maps.size(table).first()["size"] == 3
    new = spark.createDataFrame([("c", "9"), ("d", "4")], "key string, value string")
    put = keyed_maps.put_rows(table, new, ["key"])
    assert dict(put.collect()) == {"a": "1", "b": "2", "c": "9", "d": "4"}
    assert dict(keyed_maps.remove_rows(put, new, ["key"]).collect()) == {"a": "1", "b": "2"}
    ops = spark.createDataFrame([("remove",)] * 5, "op string")
    assert ops.select(keyed_maps.due_for_compaction(ops).alias("due")).first()["due"] is True


def test_put_all_and_clear(spark):
    rows = [(1, "put", "a", "1", None), (2, "putAll", None, None, {"b": "2", "c": "3"}),
            (3, "remove", "b", None, None), (4, "put", "b", "9", None)]
    schema = "rev long, op string, key string, value string, entries map<string,string>"
    df = spark.createDataFrame(rows, schema)
    assert dict(keyed_maps.replay(keyed_maps.put_all(df)).collect()) == {
        "a": "1", "b": "9", "c": "3"}
    cleared = df.unionByName(spark.createDataFrame(
        [(5, "clear", None, None, None), (6, "put", "z", "0", None)], schema))
    assert dict(keyed_maps.replay(keyed_maps.put_all(cleared)).collect()) == {"z": "0"}


@pytest.mark.parametrize("block", [2, 1 << 16])
def test_unread_counts(spark, block):
    msgs = spark.createDataFrame([("#a", i, "u", "t") for i in range(0, 20, 2)]
                                 + [("#b", 0, "u", "t")],
                                 "channel string, offset long, from_user string, text string")
    subs = spark.createDataFrame([("x", "#a", 0), ("x", "#b", 1), ("y", "#a", 7), ("z", "#a", 50),
                                  ("z", "#none", 0)],
                                 "user string, channel string, position long")
    got = {(r["user"], r["channel"]): r["unread"]
           for r in chat.unread_counts(msgs, subs, block=block).collect()}
    assert got == {("x", "#a"): 10, ("x", "#b"): 0, ("y", "#a"): 6, ("z", "#a"): 0,
                   ("z", "#none"): 0}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, how):
    left = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)],
                                 "k string, i long")
    right = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k0", "c"), ("none", "d")],
                                  "k string, r string")
    got = joins.salted_join(left, right, ["k"], ["i"], how, heavy_rows=50, salts=7)
    want = left.join(right, ["k"], how)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(
        map(tuple, want.collect()), key=str)


def test_range_join_with_overlapping_slices(spark):
    events = spark.range(200).select(F.lit("s").alias("key"), F.col("id").alias("at"))
    cuts = spark.createDataFrame([("s", 10, 20, 1), ("s", 15, 150, 2), ("s", 30, 30, 3),
                                  ("t", 0, 9, 4)],
                                 "key string, start_offset long, end_offset long, slice int")
    got = joins.events_in_slices(events, cuts, "key", "at", block=16)
    assert dict(got.groupBy("slice").count().collect()) == {1: 10, 2: 135}


def test_first_arrival_wins(spark):
    df = spark.createDataFrame([(1, 5, "late"), (1, 2, "early"), (2, 9, "only")],
                               "ride_id long, arrival long, note string")
    got = duplicates.distinct_by_identity(df, "ride_id", "arrival").collect()
    assert {(r["ride_id"], r["note"]) for r in got} == {(1, "early"), (2, "only")}


def test_rates_of_count_windows(spark):
    df = spark.range(400).selectExpr("id AS at", "id * 1.0 AS v", "timestamp_seconds(id div 200 * 100 + id % 200 * 0.5) AS t")
    size = F.lit(1 << 20).cast("long")
    first = metrics.count_windows(df, "at", "v", size, 200, time="t").orderBy("window_no").first()
    assert first["rec_per_s"] == pytest.approx(200 / 99.5) and first["mb_per_s"] == pytest.approx(200 / 99.5)
    whole = metrics.latency_report(df, "v", "t", size).first()
    assert whole["rec_per_s"] == pytest.approx(400 / 199.5) and whole["records"] == 400
    assert metrics.latency_report(df.limit(1), "v", "t", size).first()["rec_per_s"] is None
