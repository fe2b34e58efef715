"""Heavy keys without a broadcast, identities per segment, file order and special readings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rillstream.operators import chat, duplicates, joins, metrics
from rillstream.operators.ordered import Fold, keyed_scan
from rillstream.sources import files
from tests.test_sources import TRIP_HEADER, TRIPS


@pytest.fixture
def no_broadcast(spark):
    """No broadcasts, and small partitions stay apart as large ones would."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def _sum_fold():
    zero = F.lit(0).cast("long")
    return Fold(initial=lambda: zero, identity=lambda: zero, effect=lambda row: row["w"],
                compose=lambda a, b: a + b, apply=lambda fn, state: fn + state)


def test_scan_exchanges_by_chunk(spark, no_broadcast):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.col("id").alias("at"), F.lit(1).cast("long").alias("w"))
    out = keyed_scan(rows, ["k"], "at", _sum_fold(), width=256)
    plan = out._jdf.queryExecution().executedPlan().toString()
    by_key = [line for line in plan.splitlines() if "Exchange hashpartitioning(__key" in line]
    assert any("REPARTITION_BY_COL" in line and "chunk" in line for line in by_key)
    assert all("chunk" in line or "__part" in line or "span" in line for line in by_key
               if "row" in line)
    hot = out.where("k = 'hot'")
    assert hot.where("before <> at div 3 or after <> before + 1").count() == 0
    assert hot.count() == 10_000
    assert hot.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 8_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_heavy_on_either_side(spark, no_broadcast, how):
    left = spark.createDataFrame([("a" if i % 2 else None if i % 5 == 0 else f"k{i}", i) for i in range(200)],
                                 "k string, i long")
    right = spark.createDataFrame([("k2" if j < 90 else "a" if j < 93 else f"k{j}", j) for j in range(120)],
                                  "k string, j long")
    got = joins.salted_join(left, right, ["k"], ["i"], how, heavy_rows=50, salts=7)
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", how).collect()))


def test_endless_slice(spark):
    events = spark.createDataFrame([("s", n * 10 ** 11) for n in range(10)], "key string, at long")
    cuts = spark.createDataFrame([("s", 0, 10 ** 12, "all"), ("s", 10 ** 11, 3 * 10 ** 11, "two"), ("s", 5, 6, "none")],
                                 "key string, start_offset long, end_offset long, name string")
    got = joins.events_in_slices(events, cuts, "key", "at", block=3).groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in got} == {"all": 10, "two": 2}


def test_unread_without_pairs(spark):
    n = 100_000
    messages = spark.range(n).select(F.lit("c").alias("channel"), F.col("id").alias("offset"))
    subs = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user"), F.lit("c").alias("channel"),
                                 F.col("id").alias("position"))
    extra = spark.createDataFrame([("v", "none", 4), ("w", "c", n + 7)], "user string, channel string, position long")
    out = chat.unread_counts(messages, subs.unionByName(extra))
    assert out.where("user like 'u%' and unread <> 100000 - cast(substr(user, 2) as long)").count() == 0
    assert {r["user"]: r["unread"] for r in out.where("user in ('v', 'w')").collect()} == {"v": 0, "w": 0}


def test_duplicates_of_segments(spark):
    data = [(seg, at, at % 4) for seg in range(3) for at in range(13)]
    df = spark.createDataFrame(data, "segment_id int, offset long, value long")
    got = duplicates.duplicates_report(df, "value", "offset", segment="segment_id").collect()
    assert len(got) == 35
    assert {(r["segment_id"], r["offset"]) for r in got} == {(s, o) for s, o, _ in data} - {(0, v) for v in range(4)}


def test_ride_ids_follow_paths(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([TRIP_HEADER, TRIPS[0]]))
    (tmp_path / "b.csv").write_text("\n".join([TRIP_HEADER, TRIPS[1], TRIPS[1], TRIPS[1]]))
    rows = files.with_ride_ids(files.trip_csv(spark, str(tmp_path))).orderBy("ride_id").collect()
    assert [(r["ride_id"], r["vendor_id"]) for r in rows] == [(1, 1), (2, 2), (3, 2), (4, 2)]


def test_special_readings(spark):
    nan, inf = float("nan"), float("inf")

    def of(values, kind, *ps):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        return [r["value"] for r in metrics.exact_percentiles(df, "v", ps).orderBy("percentile").collect()]

    assert of([nan, nan, nan, 0.5, 1.0, 2.0, 3.0, 4.0], "double", 0.25) == [2.0]
    assert of([inf, -inf, 1.0, None, 2.0], "double", 0.0, 0.25, 0.99) == [-inf, 1.0, inf]
    big = 2 ** 53
    assert of([big + 2, big + 1, big, 7], "long", 0.25, 0.5, 0.75) == [big, big + 1, big + 2]
