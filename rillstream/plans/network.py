"""Anomaly alerts of the keyed state machine and what is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import dotted_address, event_letter
from ..operators import alerts
from . import inputs
from .inputs import NETWORK
from .registry import query

_ALERTS = f"""(WITH RECURSIVE e AS (SELECT *, row_number() OVER (
      PARTITION BY source_address ORDER BY "offset") AS rn FROM {NETWORK}),
  moves(s, c, t) AS (VALUES ('INITIAL',1,'W'), ('INITIAL',3,'X'), ('W',2,'Y'), ('X',2,'Y'),
    ('X',4,'Z'), ('Y',5,'Z'), ('Z',7,'INITIAL')),
  walk AS (
    SELECT e.source_address, e.rn, 'INITIAL' AS state, m.t AS onward
    FROM e LEFT JOIN moves m ON m.s = 'INITIAL' AND m.c = e.event WHERE e.rn = 1
    UNION ALL
    SELECT e.source_address, e.rn, coalesce(w.onward, 'INITIAL'), m.t
    FROM walk w JOIN e ON e.source_address = w.source_address AND e.rn = w.rn + 1
    LEFT JOIN moves m ON m.s = coalesce(w.onward, 'INITIAL') AND m.c = e.event)
  SELECT e.source_address, e.event, e.event_time, e.network_id, e.lat, e.lon, e."offset", w.state
  FROM walk w JOIN e USING (source_address, rn) WHERE w.onward IS NULL)"""

_BUCKET = "time_bucket(INTERVAL '1 hour', event_time)"
_IP = """CAST((b >> 24) & 255 AS VARCHAR) || '.' || CAST((b >> 16) & 255 AS VARCHAR) || '.'
  || CAST((b >> 8) & 255 AS VARCHAR) || '.' || CAST(b & 255 AS VARCHAR)"""
_UNSIGNED = "(CAST(source_address AS BIGINT) + 4294967296) % 4294967296"

_SUMMARY = f"""(SELECT network_id, {_BUCKET} AS window_start,
  {_BUCKET} + INTERVAL '1 hour' AS window_end, count(*) AS cnt, min(event_time) AS min_time,
  max(event_time) AS max_time,
  CAST(arg_min(lat, "offset") AS VARCHAR) || ',' || CAST(arg_min(lon, "offset") AS VARCHAR)
    AS location FROM {_ALERTS} GROUP BY ALL)"""

# Window of the summaries below; live jobs use 30 seconds on much denser events.
WINDOW = "1 hour"


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.anomaly_alerts(inputs.network_events(spark, sf_dir))


@query(f"SELECT * FROM {_ALERTS}")
def anomaly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir)


@query(f"SELECT * FROM {_SUMMARY}")
def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_summary(_found(spark, sf_dir), WINDOW)


@query(f"""SELECT network_id, window_start, {_IP} AS ip_address, n FROM (
  SELECT network_id, {_BUCKET} AS window_start, {_UNSIGNED} AS b, count(*) AS n
  FROM {_ALERTS} GROUP BY ALL)""")
def alert_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_addresses(_found(spark, sf_dir), WINDOW)


@query(f"""SELECT network_id, window_start, CAST(page AS BIGINT) AS page,
  string_agg({_IP}, ' ' ORDER BY "offset") AS ip_addresses FROM (
    SELECT network_id, {_BUCKET} AS window_start, "offset" // 65536 AS page, {_UNSIGNED} AS b,
      "offset" FROM {_ALERTS}) GROUP BY network_id, window_start, page""")
def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = alerts.alert_documents(_found(spark, sf_dir), WINDOW)
    return pages.withColumn("ip_addresses", F.array_join("ip_addresses", " "))


@query(f"""SELECT * FROM {_SUMMARY} QUALIFY
  row_number() OVER (PARTITION BY network_id ORDER BY window_end DESC) = 1""")
def alert_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.latest_documents(alerts.alert_summary(_found(spark, sf_dir), WINDOW))


@query(f"SELECT location, sum(cnt)::BIGINT AS alerts FROM {_SUMMARY} GROUP BY location")
def alert_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alerts_by_location(alerts.alert_summary(_found(spark, sf_dir), WINDOW))


@query(f"""SELECT "offset", {_IP} AS ip_address, chr(96 + event) AS letter FROM (
  SELECT "offset", event, {_UNSIGNED} AS b FROM {NETWORK})""")
def formatted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.network_events(spark, sf_dir).select(
        "offset", dotted_address(F.col("source_address")).alias("ip_address"),
        event_letter(F.col("event")).alias("letter"))
