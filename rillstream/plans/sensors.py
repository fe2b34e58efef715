"""Sensor summaries, chained averages, bookmarked slices and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import sensor_line, sensor_reading
from ..operators import slices, windows, words
from ..session import fresh_path
from ..sinks import tables
from . import inputs
from .registry import query

_DAY = "time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01 08:00:00')"


_SUMMARY = f"""SELECT user_id AS sensor_id, {_DAY} AS window_start,
  {_DAY} + INTERVAL '1 day' AS window_end, arg_min(ts, event_id) AS start_time,
  arg_max(event_type, event_id) AS location, min(value) AS temp_min, max(value) AS temp_max
  FROM events GROUP BY ALL"""


@query(_SUMMARY)
def sensor_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.table(spark, sf_dir, "events").withColumnRenamed("user_id", "sensor_id")
    return windows.tumbling(
        readings, "ts", "1 day", ["sensor_id"],
        [F.min_by("ts", "event_id").alias("start_time"),
         F.max_by("event_type", "event_id").alias("location"),
         F.min("value").alias("temp_min"), F.max("value").alias("temp_max")],
        ["start_time", "location", "temp_min", "temp_max"], "8 hours")


@query(_SUMMARY)
def sensor_summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary through the CSV sink and back."""
    summary = sensor_daily_summary(spark, sf_dir)
    path = fresh_path(spark, "summary-csv")
    tables.write_csv(summary, path)
    return tables.read_csv(spark, path, summary.schema)


def _average(source: str, size: str) -> str:
    return (f"SELECT sensor_id, time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') "
            f"+ INTERVAL '{size}' AS ts, "
            f"avg(value) AS value "
            f"FROM ({source}) GROUP BY ALL")


def _rounded(averages: DataFrame) -> DataFrame:
    """Sums of doubles differ in their last digits with the order; results are compared without these."""
    return averages.withColumn("value", F.round("value", 6))


_READINGS = "SELECT user_id AS sensor_id, ts, value FROM events"
_ROUNDED = "SELECT sensor_id, ts, round(value, 6) AS value FROM ({})"


@query(_ROUNDED.format(_average(_READINGS, "10 seconds")))
def event_time_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"), "ts", "value")
    return _rounded(windows.averages(readings, "ts", "10 seconds", "sensor_id", "value"))


@query(_ROUNDED.format(_average(_average(_average(
    _READINGS, "10 seconds"), "500 seconds"), "10000 seconds")))
def event_time_average_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"), "ts", "value")
    return _rounded(windows.chained_averages(
        readings, "ts", ["10 seconds", "500 seconds", "10000 seconds"], "sensor_id", "value"))


@query("""SELECT (epoch_us(ts) // 1000) AS "timestamp", CAST(user_id AS INTEGER) AS sensor_id,
  event_type AS location, CAST(value AS FLOAT) AS temp FROM events""")
def parsed_sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "events").select(sensor_line(
        F.unix_millis(F.col("ts").cast("timestamp")), F.col("user_id"), F.col("event_type"),
        F.col("value")).alias("line"))
    return lines.select(sensor_reading(F.col("line")).alias("r")).select("r.*")


# Readings below this value are of interest.
THRESHOLD = 20

_SLICES = f"""SELECT sensor_id, start_offset, end_offset FROM (
  SELECT user_id AS sensor_id, min(event_id) FILTER (value < {THRESHOLD}) AS start_offset,
    lead(min(event_id)) OVER (PARTITION BY user_id ORDER BY min(event_id)) AS end_offset,
    bool_or(value < {THRESHOLD}) AS hit
  FROM (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY event_id) AS run
        FROM (SELECT *, CAST((value < {THRESHOLD}) IS DISTINCT FROM lag(value < {THRESHOLD})
                OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS turn FROM events))
  GROUP BY user_id, run) WHERE hit AND end_offset IS NOT NULL"""


def _bookmarks(events: DataFrame) -> DataFrame:
    return slices.bookmark_slices(events, "sensor_id", "event_id", F.col("value") < THRESHOLD)


def _sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sensor_id"), "event_id", "value")


@query(_SLICES)
def bookmark_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bookmarks(_sensor_events(spark, sf_dir))


@query(f"""SELECT s.sensor_id, s.start_offset, s.end_offset, count(e.event_id) AS n
  FROM ({_SLICES}) s LEFT JOIN events e ON e.user_id = s.sensor_id
    AND e.event_id >= s.start_offset AND e.event_id < s.end_offset AND e.value < {THRESHOLD}
  GROUP BY ALL""")
def slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _sensor_events(spark, sf_dir)
    low = F.col("value") < THRESHOLD
    return slices.bookmark_counts(events, "sensor_id", "event_id", low, low)


@query(f"""SELECT s.sensor_id, s.start_offset, s.end_offset, count(e.event_id) AS n
  FROM ({_SLICES}) s LEFT JOIN events e ON e.user_id = s.sensor_id
    AND e.event_id >= s.start_offset AND e.event_id < s.end_offset AND e.event_type = 'click'
  GROUP BY ALL""")
def slice_counts_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that are kept as a table, counted later over the log."""
    found = fresh_path(spark, "slices")
    _bookmarks(_sensor_events(spark, sf_dir)).write.parquet(found)
    events = inputs.table(spark, sf_dir, "events").withColumnRenamed("user_id", "sensor_id")
    return slices.slice_counts(events, spark.read.parquet(found), "sensor_id", "event_id",
                               F.col("event_type") == "click")


_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"
_WORDS = f"""(SELECT doc_id, unnest(CASE WHEN rtrim(line, ' ') = '' AND length(line) > 0
  THEN [] ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM {_LINES})"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines; a document arrives each second."""
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select(
        F.timestamp_seconds("doc_id").cast("timestamp_ntz").alias("arrival"),
        F.explode(F.split("text", "\n")).alias("line"))


@query(f"SELECT word, count(*) AS cnt FROM {_WORDS} GROUP BY word")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(_lines(spark, sf_dir), "line")


@query(f"""SELECT window_start, window_start + INTERVAL '10 seconds' AS window_end, word,
  count(*) AS cnt FROM (SELECT word, TIMESTAMP '1970-01-01' + to_seconds(doc_id // 10 * 10)
    AS window_start FROM {_WORDS}) GROUP BY ALL""")
def word_count_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(_lines(spark, sf_dir), "line", "arrival", "10 seconds")
