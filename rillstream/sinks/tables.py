"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ordered import INDEX_WIDTH, dense_index
from ..sources.eventlog import LOG_SCHEMA

SEGMENTS = 5    # default number of segments of a stream


def segment_of(routing_key: Column | str, segments: int = SEGMENTS) -> Column:
    """Segment of a routing key: equal keys share one."""
    key = F.col(routing_key) if isinstance(routing_key, str) else routing_key
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(segments)).cast("int")


def assign_offsets(rows: DataFrame, position: str, *, base: DataFrame | None = None,
                   width: int = INDEX_WIDTH) -> DataFrame:
    """Number the rows of each segment in ``position`` order, after what is stored.

    ``base``: segment_id, next_offset of the existing log.
    """
    numbered = dense_index(rows, position, "offset", partition_by=["segment_id"], width=width)
    if base is None:
        return numbered
    # one row per segment, and a stream has a fixed, small number of segments
    return (numbered.join(F.broadcast(base), "segment_id", "left")
            .withColumn("offset", F.col("offset") + F.coalesce("next_offset", F.lit(0)))
            .drop("next_offset"))


def append_log(rows: DataFrame, path: str, scope: str, stream: str, position: str, *,
               segments: int = SEGMENTS, width: int = INDEX_WIDTH) -> None:
    """Append events (event, routing_key, event_time, ``position``) to a log.

    Numbering leaves the rows partitioned by blocks of positions within a segment, and they
    are written that way: a busy segment is shared by many tasks, and files sorted by
    offset let scans skip row groups.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("segment_id", segment_of("routing_key", segments))
    base = None
    if _exists(spark, path):
        stored = spark.read.schema(LOG_SCHEMA).parquet(path).where(
            (F.col("scope") == scope) & (F.col("stream") == stream))
        base = stored.groupBy("segment_id").agg((F.max("offset") + 1).alias("next_offset"))
    out = assign_offsets(placed, position, base=base, width=width).select(
        "event", "routing_key", "event_time", "offset", F.lit(scope).alias("scope"),
        F.lit(stream).alias("stream"), "segment_id")
    (out.sortWithinPartitions("scope", "stream", "segment_id", "offset")
     .write.mode("append").partitionBy("scope", "stream", "segment_id").parquet(path))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_committed(log: DataFrame, status: DataFrame) -> DataFrame:
    """Events outside transactions and those of committed transactions.

    The two kinds are filtered apart, so events without a transaction never
    enter the join.
    """
    committed = status.where("status = 'COMMITTED'").select("txn_id")
    inside = log.where("txn_id is not null").join(committed, "txn_id", "left_semi")
    return log.where("txn_id is null").unionByName(inside)


# Times in full: the format Spark writes by default stops at milliseconds.
CSV_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
             "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_TIMES).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What `write_csv` stored."""
    return spark.read.schema(schema).options(**CSV_TIMES).csv(path, mode="FAILFAST")


def insert_select(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT …``, matched by column name."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    df.select(*columns).write.insertInto(table)


def discard(df: DataFrame) -> None:
    """Run the job and drop its rows."""
    df.write.format("noop").mode("overwrite").save()


def compact_retention(df: DataFrame, path: str, time: str, keep: str) -> None:
    """Rewrite a log with the rows of its last interval only, to a new path."""
    from ..operators.slices import last_interval
    last_interval(df, time, keep).write.mode("overwrite").parquet(path)
