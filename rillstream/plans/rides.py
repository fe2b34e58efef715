"""Ride analytics: zone look-ups, windows per destination and vendor, unique visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import camel_json, wall_clock
from ..operators import duplicates, joins, ordered, windows
from . import inputs
from .inputs import EVENTS, RIDES, ZONES
from .registry import query

_ENRICHED = f"""SELECT r.*, s.borough AS start_location_borough, s.zone AS start_location_zone,
  s.service_zone AS start_location_service_zone, d.borough AS dest_location_borough,
  d.zone AS dest_location_zone, d.service_zone AS dest_location_service_zone
  FROM {RIDES} r JOIN {ZONES} s ON r.start_location_id = s.location_id
  JOIN {ZONES} d ON r.dest_location_id = d.location_id"""


@query(_ENRICHED)
def zone_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.enrich_trips(inputs.rides(spark, sf_dir), inputs.zones(spark, sf_dir))


_SOME_ZONES = f"(SELECT * FROM {ZONES} WHERE borough <> 'ASIA')"


@query(f"""SELECT r.ride_id, s.zone AS start_location_zone, d.zone AS dest_location_zone
  FROM {RIDES} r LEFT JOIN {_SOME_ZONES} s ON r.start_location_id = s.location_id
  LEFT JOIN {_SOME_ZONES} d ON r.dest_location_id = d.location_id""")
def zone_enrichment_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = inputs.zones(spark, sf_dir).where("borough <> 'ASIA'")
    out = joins.enrich_trips(inputs.rides(spark, sf_dir), zones, "left")
    return out.select("ride_id", "start_location_zone", "dest_location_zone")


@query(f"""SELECT location_id, count(*) AS trip_ends FROM (
    SELECT start_location_id AS location_id FROM {RIDES}
    UNION ALL SELECT dest_location_id FROM {RIDES})
  WHERE location_id NOT IN (SELECT location_id FROM {_SOME_ZONES}) GROUP BY location_id""")
def zone_lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = inputs.zones(spark, sf_dir).where("borough <> 'ASIA'")
    return joins.lookup_misses(inputs.rides(spark, sf_dir), zones)


@query(f"""SELECT dest_location_zone, time_bucket(INTERVAL '1 hour', dropoff_time) AS window_start,
  time_bucket(INTERVAL '1 hour', dropoff_time) + INTERVAL '1 hour' AS window_end,
  count(passenger_count) AS cnt FROM ({_ENRICHED}) GROUP BY ALL""")
def max_travellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = inputs.rides(spark, sf_dir).select("dropoff_time", "passenger_count",
                                               "start_location_id", "dest_location_id")
    enriched = joins.enrich_trips(rides, inputs.zones(spark, sf_dir))
    return windows.tumbling(enriched, "dropoff_time", "1 hour", ["dest_location_zone"],
                            [F.count("passenger_count").alias("cnt")], ["cnt"])


def _hops(key: str, counted: str, having: str = "") -> str:
    return f"""SELECT {key}, window_start, window_start + INTERVAL '15 minutes' AS window_end,
  count({counted}) AS cnt FROM (
    SELECT *, time_bucket(INTERVAL '5 minutes', pickup_time) - to_minutes(5 * i) AS window_start
    FROM {RIDES}, (SELECT unnest([0, 1, 2]) AS i)) GROUP BY {key}, window_start {having}"""


@query(_hops("vendor_id", "vendor_id"))
def popular_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.hopping_count(inputs.rides(spark, sf_dir), "pickup_time", "15 minutes",
                                 "5 minutes", ["vendor_id"], "vendor_id")


# Rides per window that make a destination popular. The usual limit is 20; the given tables
# hold a few rides per window only.
POPULAR_LIMIT = 1


@query(_hops("dest_location_id", "dest_location_id", f"HAVING cnt > {POPULAR_LIMIT}"))
def popular_destination(spark: SparkSession, sf_dir: str, limit: int = POPULAR_LIMIT) -> DataFrame:
    counts = windows.hopping_count(inputs.rides(spark, sf_dir), "pickup_time", "15 minutes",
                                   "5 minutes", ["dest_location_id"], "dest_location_id")
    return counts.where(F.col("cnt") > limit)


@query(f"""{_hops("dest_location_id", "dest_location_id")}
  ORDER BY cnt DESC, window_start, dest_location_id LIMIT 20""")
def top_destinations(spark: SparkSession, sf_dir: str, most: int = 20) -> DataFrame:
    counts = popular_destination(spark, sf_dir, 0)
    return counts.orderBy(F.desc("cnt"), "window_start", "dest_location_id").limit(most)


@query(f"SELECT ride_id, pickup_time, dropoff_time FROM {RIDES} "
       "ORDER BY pickup_time, dropoff_time, ride_id LIMIT 100")
def first_rides(spark: SparkSession, sf_dir: str, most: int = 100) -> DataFrame:
    rides = inputs.rides(spark, sf_dir).select("ride_id", "pickup_time", "dropoff_time")
    return rides.orderBy("pickup_time", "dropoff_time", "ride_id").limit(most)


@query("""SELECT event_id, event_type,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS ride_id FROM events""")
def ride_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type")
    return ordered.dense_index(events, "event_id", "ride_id", first=1,
                               partition_by=["event_type"])


@query(f"SELECT ride_id, pickup_time, trip_distance, ride_id AS arrival FROM {RIDES}")
def distinct_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of all rides under changed fields adds no ride."""
    rides = inputs.rides(spark, sf_dir).select("ride_id", "pickup_time", "trip_distance",
                                               F.col("ride_id").alias("arrival"))
    replayed = rides.withColumn("trip_distance", F.lit(0.0)).withColumn(
        "arrival", F.col("arrival") + (1 << 40))
    return duplicates.distinct_by_identity(rides.unionByName(replayed), "ride_id", "arrival")


@query("""SELECT d.day AS window_start, d.day + to_minutes(10 * (s.i + 1)) AS window_end,
    count(DISTINCT e.user_id) AS uv
  FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS day, min(ts) AS first_ts FROM events GROUP BY 1) d
  JOIN (SELECT unnest(range(144)) AS i) s
    ON d.day + to_minutes(CAST(10 * (s.i + 1) AS BIGINT)) > d.first_ts
  JOIN events e ON e.ts >= d.day AND e.ts < d.day + to_minutes(CAST(10 * (s.i + 1) AS BIGINT))
  GROUP BY ALL""")
def cumulate_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.cumulative_distinct(inputs.table(spark, sf_dir, "events"), "ts", "user_id")


@query("""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS item_id,
  event_type AS category_id, ts FROM events WHERE event_type = 'purchase' AND hour(ts) <= 2""")
def midnight_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return events.where((F.col("event_type") == "purchase") & (F.hour("ts") <= 2)).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("item_id"),
        F.col("event_type").alias("category_id"), "ts")


@query("""SELECT event_id, to_timestamp(CAST(floor(epoch(ts)) AS BIGINT)) AT TIME ZONE 'UTC'
  + INTERVAL '8 hours' AS wall_time FROM events""")
def local_wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return events.select("event_id", wall_clock(seconds).alias("wall_time"))


_LATE = f"""SELECT event_id, time, watermark FROM (
  SELECT event_id, time, time_bucket(INTERVAL '1 hour', time) + INTERVAL '1 hour' AS wend, watermark
  FROM (SELECT event_id, ts - to_hours(k) AS time, event_id // 500 AS batch FROM {EVENTS})
  JOIN (SELECT batch, max(peak) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING) - INTERVAL '2 days' AS watermark
        FROM (SELECT event_id // 500 AS batch, max(ts - to_hours(k)) AS peak
              FROM {EVENTS} GROUP BY 1)) USING (batch)) WHERE wend <= watermark"""


@query(_LATE)
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = inputs.events(spark, sf_dir).select(
        "event_id", (F.col("ts") - F.make_dt_interval(hours=F.col("k"))).alias("time"),
        F.expr("event_id div 500").alias("batch"))
    return windows.late_rows(shifted, "time", "batch", "2 days", "1 hour").select(
        "event_id", "time", "watermark")


@query(f"""SELECT ride_id, json_object('rideId', ride_id, 'vendorId', vendor_id,
    'startLocationId', start_location_id, 'destLocationId', dest_location_id)::VARCHAR AS event,
  CAST(vendor_id AS VARCHAR) AS routing_key FROM {RIDES}""")
def rides_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides as JSON events with their routing key, ready for a log."""
    return inputs.rides(spark, sf_dir).select(
        "ride_id", camel_json(["ride_id", "vendor_id", "start_location_id",
                               "dest_location_id"]).alias("event"),
        F.col("vendor_id").cast("string").alias("routing_key"))
