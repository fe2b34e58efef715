"""Given tables written in an outer form and read again through the sources, in batches and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sinks import tables
from ..sources import eventlog, files
from ..streaming import sinks
from ..streaming import windows as live
from . import inputs
from .inputs import LOG, RIDES
from .live import _stored, event_stream
from .registry import query
from .rides import _hops


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines; names and types are inferred on reading."""
    path = fresh_path(spark, "json-lines")
    inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value").write.json(path)
    return files.json_lines(spark, path).select("event_id", "user_id", "event_type", "value")


@query(f"""SELECT vendor_id, date_trunc('second', pickup_time) AS pickup_time,
  date_trunc('second', dropoff_time) AS dropoff_time, passenger_count,
  CAST(trip_distance AS FLOAT) AS trip_distance, start_location_id, dest_location_id FROM {RIDES}""")
def trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides as gzip CSV with all 17 columns of a trip file, of which the reader keeps seven."""
    path = fresh_path(spark, "trips")
    rides = inputs.rides(spark, sf_dir)
    full = rides.select(*[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if files.TRIP_USED.get(c) == "time"
        else F.col(c).cast("string").alias(c) if c in files.TRIP_USED else F.lit("0").alias(c)
        for c in files.TRIP_COLUMNS])
    full.write.csv(path, header=True, compression="gzip")
    return files.trip_csv(spark, path)


@query(f"""SELECT "offset", stream, routing_key, event FROM {LOG}""")
def stream_log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored log read from its head as a stream, some files per micro-batch."""
    path = fresh_path(spark, "tailed")
    log = inputs.log(spark, sf_dir).select(
        F.concat_ws("|", F.col("offset").cast("string"), "stream", "event").alias("event"), "routing_key",
        F.col("event_time").cast("timestamp").alias("event_time"), F.col("offset").alias("at"))
    tables.append_log(log, path, "examples", "events", "at")
    seen = _stored(eventlog.tail_log(spark, path, "examples", "events", files_per_batch=2), "tail")
    parts = F.split("event", r"\|")
    return seen.select(parts[0].cast("long").alias("offset"), parts[1].alias("stream"), "routing_key",
                       parts[2].alias("event"))


@query("""SELECT word, count(*) AS cnt FROM (
    SELECT unnest(string_split(event_type || ' ' || user_id, ' ')) AS word FROM events) GROUP BY word""")
def stream_text_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of arriving text files per processing-time window; each batch updates the windows it touches."""
    path = fresh_path(spark, "lines")
    (inputs.table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")))
     .repartition(3).write.text(f"{path}/in"))
    counted = live.word_count(files.text_stream(spark, f"{path}/in", files_per_batch=1))
    sinks.exactly_once(counted, f"{path}/out", f"{path}/checkpoint", once=True, mode="update").awaitTermination()
    newest = sinks.read_batches(spark, f"{path}/out").groupBy("word", "window_start").agg(
        F.max("cnt").alias("cnt"))  # counts of a window only grow
    return newest.groupBy("word").agg(F.sum("cnt").alias("cnt"))


@query(f"""SELECT * FROM ({_hops("vendor_id", "vendor_id")})
  WHERE window_end <= (SELECT max(pickup_time) FROM {RIDES}) - INTERVAL '30 seconds'""")
def stream_popular_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = event_stream(spark, sf_dir).select(
        F.col("ts").alias("pickup_time"), F.expr("cast(user_id % 5 as int)").alias("vendor_id"))
    return _stored(live.hopping_count(rides, "pickup_time", "30 seconds", "15 minutes", "5 minutes",
                                      ["vendor_id"], "vendor_id"), "vendors")
