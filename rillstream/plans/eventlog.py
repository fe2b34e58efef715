"""Event-log scans, cuts, slices, offsets and transactions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import iso_millis, routed_json
from ..operators import ordered, slices
from ..session import fresh_path
from ..sinks import tables
from ..sources import eventlog
from . import inputs
from .inputs import LOG
from .registry import query


@query(f'SELECT event, scope, stream, segment_id, "offset" FROM {LOG}')
def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    binary = inputs.log(spark, sf_dir).withColumn("event", F.col("event").cast("binary"))
    return eventlog.as_text(binary)


@query("""SELECT json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type)
  ::VARCHAR AS event, CAST(user_id AS VARCHAR) AS routing_key FROM events""")
def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        routed_json(["event_id", "user_id", "event_type"]).alias("event"),
        F.col("user_id").cast("string").alias("routing_key"))


@query(f"""SELECT stream, segment_id, count(*) AS events FROM {LOG} GROUP BY stream, segment_id
  UNION ALL SELECT stream, NULL, count(*) FROM {LOG} GROUP BY stream""")
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.segment_counts(inputs.log(spark, sf_dir))


@query("SELECT count(*) AS events FROM events")
def event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("events"))


@query("""SELECT event_id, CAST(user_id % 5 AS INTEGER) AS segment_id,
  row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) - 1 AS "offset" FROM events""")
def append_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.expr("cast(user_id % 5 as int)").alias("segment_id"))
    return tables.assign_offsets(rows, "event_id")


# A cut over the five segments; segment 4 is left open on both sides.
START = {0: 1000, 1: 1500, 2: 2000, 3: 0}
END = {0: 5000, 1: 4000, 2: 2001, 3: 9000}
_IN_SLICE = """((segment_id = 0 AND "offset" >= 1000 AND "offset" < 5000)
  OR (segment_id = 1 AND "offset" >= 1500 AND "offset" < 4000)
  OR (segment_id = 2 AND "offset" >= 2000 AND "offset" < 2001)
  OR (segment_id = 3 AND "offset" >= 0 AND "offset" < 9000) OR segment_id = 4)"""


@query(f'SELECT stream, segment_id, "offset", event FROM {LOG} WHERE {_IN_SLICE}')
def slice_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.read_slice(inputs.log(spark, sf_dir), START, END).select(
        "stream", "segment_id", "offset", "event")


@query(f"""SELECT 'head' AS part, stream, segment_id, "offset" FROM {LOG}
    WHERE (segment_id, "offset") IN (SELECT segment_id, "offset" FROM {LOG} WHERE
      (segment_id = 0 AND "offset" < 1000) OR (segment_id = 1 AND "offset" < 1500)
      OR (segment_id = 2 AND "offset" < 2000) OR (segment_id = 3 AND "offset" < 0)
      OR segment_id = 4)
  UNION ALL SELECT 'tail', stream, segment_id, "offset" FROM {LOG} WHERE
    (segment_id = 0 AND "offset" >= 1000) OR (segment_id = 1 AND "offset" >= 1500)
    OR (segment_id = 2 AND "offset" >= 2000) OR (segment_id = 3 AND "offset" >= 0)
    OR segment_id = 4""")
def head_and_tail_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to a cut and from it on; a segment the cut does not name is read whole both times."""
    log = inputs.log(spark, sf_dir).select("stream", "segment_id", "offset")
    return slices.union_streams([
        slices.read_slice(log, end=START).withColumn("part", F.lit("head")),
        slices.read_slice(log, start=START).withColumn("part", F.lit("tail"))])


# Event numbers that bound the indexed slices.
FIRST, LAST = 100, 1990

_INDEXED = f"""(SELECT *, row_number() OVER (PARTITION BY stream ORDER BY "offset") - 1 AS i
  FROM {LOG})"""


@query(f"""SELECT stream, segment_id,
  coalesce(min("offset") FILTER (i >= {FIRST}), max("offset") + 1) AS start_offset,
  CASE WHEN max(n) >= {LAST} THEN coalesce(min("offset") FILTER (i >= {LAST}), max("offset") + 1)
  END AS end_offset
  FROM (SELECT *, count(*) OVER (PARTITION BY stream) AS n FROM {_INDEXED})
  GROUP BY stream, segment_id""")
def cuts_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.cuts_by_index(inputs.log(spark, sf_dir), FIRST, LAST)


@query(f"""SELECT stream, segment_id, "offset", event FROM {_INDEXED}
  WHERE i >= {FIRST} AND i < {LAST}""")
def multi_stream_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.log(spark, sf_dir)
    cuts = slices.cuts_by_index(log, FIRST, LAST)
    return slices.read_slices(log, cuts).select("stream", "segment_id", "offset", "event")


@query(f"""SELECT stream, segment_id, max("offset") + 1 AS "offset" FROM {LOG} GROUP BY ALL""")
def checkpoint_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.checkpoint_cut(inputs.log(spark, sf_dir))


@query(f"""SELECT stream, split_part(event, ':', 2) AS grp, min(i) AS first_index,
  max(i) + 1 AS end_index FROM {_INDEXED} GROUP BY ALL""")
def day_index_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.element_at(F.split("event", ":"), 2)
    return slices.index_ranges(inputs.log(spark, sf_dir), day)


@query(f"""SELECT stream, sum(CAST(split_part(event, ':', 3) AS INTEGER))::BIGINT AS total
  FROM {LOG} WHERE split_part(event, ':', 2) = 'day10' GROUP BY stream""")
def day_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of one day's values, read through cuts around that day's offsets."""
    log = inputs.log(spark, sf_dir)
    cuts = (log.where(F.element_at(F.split("event", ":"), 2) == "day10")
            .groupBy("stream", "segment_id")
            .agg(F.min("offset").alias("start_offset"),
                 (F.max("offset") + 1).alias("end_offset")))
    return slices.slice_sums(log, cuts)


@query("""SELECT event_id, ts FROM events
  WHERE ts > (SELECT max(ts) FROM events) - INTERVAL '1 hour'""")
def retention_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", "ts")
    return slices.last_interval(events, "ts", "1 hour")


@query("""SELECT l_orderkey AS txn_id, l_linenumber, l_partkey, l_quantity FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    OR l_linenumber = 1""")
def read_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactional events, first lines as events without a transaction."""
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.col("l_orderkey")).alias("txn_id"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    status = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txn_id"),
        F.when(F.col("o_orderstatus") == "F", "COMMITTED")
        .when(F.col("o_orderstatus") == "O", "OPEN").otherwise("ABORTED").alias("status"))
    seen = tables.read_committed(lines, status)
    return seen.select(F.col("l_orderkey").alias("txn_id"), "l_linenumber", "l_partkey",
                       "l_quantity")


STREAMS = ("click", "error", "purchase", "signup", "view")


@query(f"""SELECT "offset", event, 'from-' || stream AS source FROM {LOG}
  WHERE stream IN {STREAMS}""")
def union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.log(spark, sf_dir)
    return slices.union_streams([
        log.where(F.col("stream") == name).select("offset", "event", F.lit(f"from-{name}").alias("source"))
        for name in STREAMS])


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.'
  || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso_time FROM events""")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", iso_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("iso_time"))


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS routing_key,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events""")
def log_append_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a stored log, read back: the events of a key keep the order of writing."""
    path = fresh_path(spark, "log")
    rows = inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event"),
        F.col("user_id").cast("string").alias("routing_key"),
        F.col("ts").cast("timestamp").alias("event_time"), "event_id")
    turn = F.lit("2024-01-16").cast("timestamp")
    for part in (rows.where(F.col("event_time") < turn), rows.where(F.col("event_time") >= turn)):
        tables.append_log(part, path, "examples", "events", "event_id")
    stored = eventlog.read_log(spark, path, "examples", "events").select(
        F.col("event").cast("long").alias("event_id"), "routing_key", "offset")
    return ordered.dense_index(stored, "offset", "seq", first=1,
                               partition_by=["routing_key"]).drop("offset")


@query(f"""SELECT stream, segment_id, "offset", event FROM {LOG}
  UNION ALL SELECT stream, segment_id, "offset", event FROM {LOG} WHERE segment_id = 3""")
def catalog_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends into a partitioned table, and from it into one made like it, columns met by name."""
    log = inputs.log(spark, sf_dir).select("event", "segment_id", "offset", "stream")
    scope = f"rill_{uuid.uuid4().hex}"
    eventlog.create_stream_table(spark, scope, "events", "stream string, segment_id int, event string, offset bigint",
                                 ["segment_id"])
    eventlog.create_like(spark, f"{scope}.copies", f"{scope}.events")
    for part in (log.where("segment_id < 2"), log.where("segment_id >= 2")):
        tables.insert_select(part, f"{scope}.events")
    events = spark.table(f"{scope}.events")
    tables.insert_select(events, f"{scope}.copies")
    tables.insert_select(events.where("segment_id = 3"), f"{scope}.copies")
    return spark.table(f"{scope}.copies").select("stream", "segment_id", "offset", "event")
