"""Event logs as partitioned tables: scope, stream, segment_id, offset, event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("event string, routing_key string, event_time timestamp, offset bigint, "
              "scope string, stream string, segment_id int")


def read_log(spark: SparkSession, path: str, scope: str | None = None,
             stream: str | None = None) -> DataFrame:
    """Batch scan with metadata; scope and stream prune folders."""
    return _only(spark.read.schema(LOG_SCHEMA).parquet(path), scope, stream)


def tail_log(spark: SparkSession, path: str, scope: str | None = None, stream: str | None = None,
             *, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded scan from the head of the log.

    Run it with ``trigger(availableNow=True)`` for a bounded scan that stops at the
    tail it found.
    """
    reader = spark.readStream.schema(LOG_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _only(reader.parquet(path), scope, stream)


def _only(log: DataFrame, scope: str | None, stream: str | None) -> DataFrame:
    if scope is not None:
        log = log.where(F.col("scope") == scope)
    if stream is not None:
        log = log.where(F.col("stream") == stream)
    return log


def as_text(log: DataFrame) -> DataFrame:
    """Payload as text, with where it came from."""
    return log.select(F.col("event").cast("string").alias("event"), "scope", "stream",
                      "segment_id", "offset")


def create_stream_table(spark: SparkSession, scope: str, stream: str, columns: str,
                        partition_by: Sequence[str] = ()) -> None:
    """Scope and stream as database and table of the session catalog; partition columns are the table's last."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{scope}`")
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{scope}`.`{stream}` ({columns}) USING parquet{parts}")


def create_like(spark: SparkSession, table: str, source: str) -> None:
    """Table with the columns of another; a watermark is set when it is read."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} LIKE {source} USING parquet")


def describe_stream(spark: SparkSession, scope: str, stream: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE `{scope}`.`{stream}`")
