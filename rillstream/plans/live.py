"""Structured Streaming runs over the given tables.

Each query replays the events as a stream (``availableNow``), writes below the shared folder and
returns what was written. Windows still open at the end of the data are not emitted.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, windows
from ..operators.alerts import latest_documents
from ..session import fresh_path
from ..streaming import sinks, stateful
from ..streaming import windows as live
from . import inputs
from .inputs import EVENTS, LOG, RIDES, SECTORS
from .network import _ALERTS
from .registry import query
from .rides import _hops
from .sensors import _SLICES, THRESHOLD

_EVENT_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                 "props string")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.readStream.schema(_EVENT_SCHEMA).parquet(f"{sf_dir}/events*.parquet")
    return raw.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _in_files(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """The events dealt into files by number, as a stream of one file per batch."""
    events = inputs.table(spark, sf_dir, "events")
    path = fresh_path(spark, "event-files")
    events.repartitionByRange(files, "event_id").write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _stored(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all data that is there into files; read them back."""
    spark = stream.sparkSession
    path = fresh_path(spark, name)
    sinks.append_files(stream, f"{path}/data", f"{path}/checkpoint", once=True).awaitTermination()
    out = spark.read.schema(stream.schema).parquet(f"{path}/data")
    return out.select(*[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
                        for n, t in out.dtypes])


@query(f"""SELECT "offset", stream, segment_id, event FROM {LOG}""")
def stream_bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = event_stream(spark, sf_dir)
    day = F.datediff(F.col("ts"), F.lit("2024-01-01"))
    return _stored(stream.select(
        F.col("event_id").alias("offset"), F.col("event_type").alias("stream"),
        F.expr("cast(user_id % 5 as int)").alias("segment_id"),
        F.concat(F.substring("event_type", 1, 1), F.lit(":day"), day.cast("string"), F.lit(":"),
                 F.expr("k % 20").cast("string")).alias("event")), "scan")


@query(f"""SELECT * FROM ({_hops("dest_location_id", "dest_location_id", "HAVING cnt > 1")})
  WHERE window_end <= (SELECT max(pickup_time) FROM {RIDES}) - INTERVAL '30 seconds'""")
def stream_popular_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = event_stream(spark, sf_dir).select(
        F.col("ts").alias("pickup_time"), F.expr("k % 25").alias("dest_location_id"))
    counts = live.hopping_count(rides, "pickup_time", "30 seconds", "15 minutes", "5 minutes",
                                ["dest_location_id"], "dest_location_id")
    return _stored(counts.where("cnt > 1"), "destinations")


_DAY = "time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01 08:00:00')"


@query(f"""SELECT * FROM (SELECT user_id AS sensor_id, {_DAY} AS window_start,
    {_DAY} + INTERVAL '1 day' AS window_end, min(value) AS temp_min, max(value) AS temp_max,
    arg_max(event_type, event_id) AS location FROM events GROUP BY ALL)
  WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 seconds'""")
def stream_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_stream(spark, sf_dir).withColumnRenamed("user_id", "sensor_id")
    return _stored(live.windowed(
        readings, "ts", "10 seconds", "1 day", ["sensor_id"],
        [F.min("value").alias("temp_min"), F.max("value").alias("temp_max"),
         F.max_by("event_type", "event_id").alias("location")], origin="8 hours"), "summary")


def _network_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream(spark, sf_dir).select(
        F.expr("cast((user_id * 2654435761) % 4294967296 - 2147483648 as int)")
        .alias("source_address"),
        F.expr("k % 7 + 1").alias("event"), F.col("ts").alias("event_time"),
        F.concat(F.lit("net-"), F.expr("k % 10").cast("string")).alias("network_id"),
        F.expr("cast(user_id % 180 as double) - 89.5").alias("lat"),
        F.expr("cast(user_id * 7 % 360 as double) - 179.75").alias("lon"),
        F.col("event_id").alias("offset"))


@query(f"SELECT * FROM {_ALERTS}")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(stateful.anomaly_alerts(_network_stream(spark, sf_dir)), "alerts")


_HOUR = "time_bucket(INTERVAL '1 hour', event_time)"


@query(f"""SELECT * FROM (SELECT network_id, {_HOUR} AS window_start,
    {_HOUR} + INTERVAL '1 hour' AS window_end, count(*) AS cnt, min(event_time) AS min_time,
    max(event_time) AS max_time FROM {_ALERTS} GROUP BY ALL)
  WHERE window_end <= (SELECT max(event_time) FROM {_ALERTS})
  QUALIFY row_number() OVER (PARTITION BY network_id ORDER BY window_end DESC) = 1""")
def stream_alert_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts go to a log; a second job windows that log and upserts one document per network."""
    path = fresh_path(spark, "alert-chain")
    found = stateful.anomaly_alerts(_network_stream(spark, sf_dir))
    sinks.append_files(found, f"{path}/alerts", f"{path}/c1", once=True).awaitTermination()
    alerts = spark.readStream.schema(stateful.ALERT_SCHEMA).parquet(f"{path}/alerts")
    summary = live.windowed(alerts, "event_time", "0 seconds", "1 hour", ["network_id"],
                            [F.count(F.lit(1)).alias("cnt"), F.min("event_time").alias("min_time"),
                             F.max("event_time").alias("max_time")])
    sinks.upsert_documents(summary, f"{path}/documents", f"{path}/c2", "network_id", "window_end",
                           once=True).awaitTermination()
    out = latest_documents(sinks.read_levels(spark, f"{path}/documents"))
    return out.select(*[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
                        for n, t in out.dtypes])


@query(_SLICES)
def stream_bookmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_stream(spark, sf_dir).withColumnRenamed("user_id", "sensor_id")
    return _stored(stateful.bookmark_slices(readings, "sensor_id", "event_id",
                                            F.col("value") < THRESHOLD), "bookmarks")


_TEN = "time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01')"
_LONG = "time_bucket(INTERVAL '500 seconds', ts, TIMESTAMP '1970-01-01')"
_SHORT = f"""(SELECT * FROM (SELECT user_id AS sensor_id, {_TEN} + INTERVAL '10 seconds' AS ts,
    avg(value) AS value
    FROM events GROUP BY ALL) WHERE ts <= (SELECT max(ts) FROM events))"""


@query(f"""SELECT * FROM (SELECT sensor_id, {_LONG} + INTERVAL '500 seconds' AS ts,
    round(avg(value), 6) AS value FROM {_SHORT}
  GROUP BY ALL) WHERE ts <= (SELECT max(ts) FROM {_SHORT})""")
def stream_chained_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-second averages written as a stream of their own, averaged again per 500 seconds."""
    path = fresh_path(spark, "averages")
    readings = event_stream(spark, sf_dir).select(F.col("user_id").alias("sensor_id"), "ts",
                                                  "value")
    short = live.averages(readings, "ts", "0 seconds", "10 seconds", "sensor_id", "value")
    sinks.append_files(short, f"{path}/short", f"{path}/c1", once=True).awaitTermination()
    again = spark.readStream.schema(short.schema).parquet(f"{path}/short")
    return _stored(live.averages(again, "ts", "0 seconds", "500 seconds", "sensor_id", "value"),
                   "averages").withColumn("value", F.round("value", 6))


@query("""SELECT d.day AS window_start, d.day + to_minutes(10 * (s.i + 1)) AS window_end,
    count(DISTINCT e.user_id) AS uv
  FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS day, min(ts) AS first_ts FROM events GROUP BY 1) d
  JOIN (SELECT unnest(range(144)) AS i) s
    ON d.day + to_minutes(CAST(10 * (s.i + 1) AS BIGINT)) > d.first_ts
  JOIN events e ON e.ts >= d.day AND e.ts < d.day + to_minutes(CAST(10 * (s.i + 1) AS BIGINT))
  GROUP BY ALL""")
def stream_cumulate_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First visits per user and day are kept in levels of stored batches; the curve is read off those."""
    path = fresh_path(spark, "visits")

    def first_visits(batch: DataFrame) -> DataFrame:
        day = F.date_trunc("day", "ts").cast("timestamp_ntz")
        return batch.groupBy(day.alias("day"), "user_id").agg(F.min("ts").alias("ts")).drop("day")

    sinks.reduced_levels(event_stream(spark, sf_dir).select("user_id", "ts"), f"{path}/first",
                         f"{path}/checkpoint", first_visits, once=True).awaitTermination()
    return windows.cumulative_distinct(sinks.read_levels(spark, f"{path}/first"), "ts", "user_id")


@query(f"""SELECT sector, round(avg(value), 6) AS "index"
  FROM (SELECT CAST(user_id AS VARCHAR) AS id, value FROM {EVENTS} WHERE true
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
      AND event_type <> 'error') JOIN {SECTORS} USING (id) GROUP BY sector""")
def stream_sector_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live changelog kept as the latest change per key; averages are taken over the table."""
    path = fresh_path(spark, "changes")
    image = "struct<id:string,value:double>"
    row = F.struct(F.col("user_id").cast("string").alias("id"), "value").cast(image)
    deleted = F.col("event_type") == "error"
    feed = event_stream(spark, sf_dir).select(F.to_json(F.struct(
        F.when(deleted, row).alias("before"), F.when(~deleted, row).alias("after"),
        F.struct(F.lit("binlog.000002").alias("file"), F.col("event_id").alias("pos"),
                 F.lit(0).alias("row")).alias("source"),
        F.when(deleted, "d").otherwise("u").alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))).alias("event"))
    sinks.keep_latest(changes.decode(feed), f"{path}/latest", f"{path}/checkpoint",
                      once=True).awaitTermination()
    return changes.group_average(sinks.current_table(spark, f"{path}/latest"),
                                 inputs.sectors(spark, sf_dir)).withColumn("index", F.round("index", 6))


@query("SELECT event_id, event_type, value FROM events")
def stream_failure_and_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that fails on purpose after it wrote its second batch, and goes on from its checkpoint: no row twice."""
    path = fresh_path(spark, "failing")
    stream = _in_files(spark, sf_dir).select("event_id", "event_type", "value")
    failed: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_batch(batch, batch_id, f"{path}/out")
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("failure on purpose")

    def run() -> None:
        sinks.for_each_batch(stream, write, f"{path}/checkpoint", once=True).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        if not failed:
            raise
        run()
    return sinks.read_batches(spark, f"{path}/out")


# The slower of two sources ends here.
_CUT = "2024-01-16"
_EVEN, _ODD = "user_id % 2 = 0", f"user_id % 2 <> 0 AND ts < TIMESTAMP '{_CUT}'"


@query(f"""SELECT * FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
    time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, event_type, count(*) AS cnt
  FROM events WHERE {_EVEN} OR ({_ODD}) GROUP BY ALL)
  WHERE window_end <= least((SELECT max(ts) FROM events WHERE {_EVEN}), (SELECT max(ts) FROM events WHERE {_ODD}))""")
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources in one window: it closes when the slower source is past it, whatever the faster one has seen."""
    fast, slow = (live.watermarked(event_stream(spark, sf_dir).where(rows), "ts", "0 seconds") for rows in (
        _EVEN, _ODD.replace("TIMESTAMP", "TIMESTAMP_NTZ")))
    both = fast.unionByName(slow)
    counts = both.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return _stored(counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                                 "event_type", "cnt"), "two-sources")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_timed_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default trigger of a batch every three seconds, stopped once idle, then started again on the same checkpoint."""
    path = fresh_path(spark, "timed")
    stream = _in_files(spark, sf_dir, 2).select("event_id", "user_id", "event_type")
    for _ in range(2):
        sinks.run_until_idle(sinks.append_files(stream, f"{path}/data", f"{path}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{path}/data")
