"""Latency, throughput, composition and duplicate reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import duplicates, metrics
from . import inputs
from .inputs import EVENTS
from .registry import query

_P = "(VALUES (0.5), (0.95), (0.99), (0.999)) p(percentile)"


@query(f"""SELECT CAST(percentile AS DOUBLE) AS percentile, value FROM (
    SELECT value, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events)
  JOIN {_P} ON i = CAST(floor(CAST(percentile AS DOUBLE) * n) AS BIGINT)""")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.exact_percentiles(inputs.table(spark, sf_dir, "events"), "value")


_RATES = """min(ts) AS first_time, max(ts) AS last_time,
  round(count(*) * 1e6::DOUBLE / nullif(epoch_us(max(ts)) - epoch_us(min(ts)), 0), 6) AS rec_per_s,
  round(sum(strlen(props))::BIGINT * 1e6::DOUBLE / nullif(epoch_us(max(ts)) - epoch_us(min(ts)), 0)
    / (1024 * 1024)::DOUBLE, 9) AS mb_per_s"""


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({"avg_value": F.round("avg_value", 6), "rec_per_s": F.round("rec_per_s", 6),
                               "mb_per_s": F.round("mb_per_s", 9)})


@query(f"""SELECT count(value) AS records,
  round(avg(value), 6) AS avg_value,
  max(value) AS max_value, {_RATES} FROM events""")
def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.latency_report(inputs.table(spark, sf_dir, "events"), "value", "ts",
                                           F.octet_length("props").cast("long")))


# Rows the sample aims at; the usual 500,000 is more than the test tables hold.
SAMPLE = 700


@query(f"""SELECT event_id, value, i AS sample_index FROM (
    SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS i,
      count(*) OVER () AS n FROM events) WHERE i % (n // least(n, {SAMPLE})) = 0""")
def latency_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.table(spark, sf_dir, "events").select("event_id", "value")
    return metrics.systematic_sample(readings, "event_id", SAMPLE)


@query(f"""SELECT CAST(i // 200 AS BIGINT) AS window_no, count(*) AS records,
  sum(strlen(props))::BIGINT AS bytes,
  round(avg(value), 6) AS avg_value,
  max(value) AS max_value, {_RATES}
  FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events)
  GROUP BY 1 HAVING count(*) = 200""")
def count_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.count_windows(inputs.table(spark, sf_dir, "events"), "event_id", "value",
                                          F.octet_length("props").cast("long"), time="ts"))


@query("""SELECT window_start, events, bytes,
  sum(events) OVER (ORDER BY window_start)::BIGINT AS total_events,
  sum(bytes) OVER (ORDER BY window_start)::BIGINT AS total_bytes
  FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS events,
          sum(strlen(props))::BIGINT AS bytes FROM events GROUP BY 1)""")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.throughput(inputs.table(spark, sf_dir, "events"), "ts",
                              F.octet_length("props").cast("long"))


@query("""SELECT doc_id,
  length(line) - length(replace(line, 'A', '')) AS n_a,
  length(line) - length(replace(line, 'C', '')) AS n_c,
  length(line) - length(replace(line, 'G', '')) AS n_g,
  length(line) - length(replace(line, 'T', '')) AS n_t
  FROM (SELECT doc_id, coalesce(string_split(text, chr(10))[2], text) AS line FROM documents)""")
def base_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.base_composition(inputs.table(spark, sf_dir, "documents"), "doc_id", "text")


_MARKED = f"""(SELECT CASE WHEN event_type = 'error' AND k = 99 THEN -1
    WHEN event_type = 'error' AND k = 98 THEN -9999 ELSE user_id END AS value,
  event_id AS "offset" FROM {EVENTS})"""


@query(f"""SELECT CAST(run AS BIGINT) AS run, value, "offset" FROM (
    SELECT *, row_number() OVER (PARTITION BY run, value ORDER BY "offset") AS n FROM (
      SELECT *, sum(CAST(value IN (-1, -9999) AS INTEGER)) OVER (ORDER BY "offset") AS run
      FROM {_MARKED})) WHERE n > 1""")
def duplicates_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User ids as the integer stream, with rare errors as start and end markers."""
    marked = inputs.events(spark, sf_dir).select(
        F.expr("case when event_type = 'error' and k = 99 then cast(-1 as bigint) "
               "when event_type = 'error' and k = 98 then cast(-9999 as bigint) "
               "else user_id end").alias("value"),
        F.col("event_id").alias("offset"))
    return duplicates.duplicates_report(marked, "value", "offset")
