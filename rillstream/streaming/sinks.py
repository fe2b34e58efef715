"""Streaming sinks, and jobs that keep a small table current batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..operators import changes

TRIGGER = "3 seconds"   # default micro-batch interval
FAN = 8     # slots per level of stored batches


def _start(writer: DataStreamWriter, once: bool, trigger: str) -> StreamingQuery:
    """``once``: process what is there, then stop."""
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def run_until_idle(query: StreamingQuery) -> None:
    """Let a live query work off what its sources hold now, then stop it; it can go on from its checkpoint."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def append_files(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False,
                 trigger: str = TRIGGER, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Exactly-once append: the sink's manifest lists each batch's files once."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, once, trigger)


def print_rows(stream: DataFrame, checkpoint: str, *, once: bool = False, mode: str = "append",
               trigger: str = TRIGGER) -> StreamingQuery:
    return _start(stream.writeStream.format("console").outputMode(mode).option("truncate", "false")
                  .option("checkpointLocation", checkpoint), once, trigger)


def discard(stream: DataFrame, checkpoint: str, *, once: bool = False, mode: str = "append",
            trigger: str = TRIGGER) -> StreamingQuery:
    return _start(stream.writeStream.format("noop").outputMode(mode)
                  .option("checkpointLocation", checkpoint), once, trigger)


def for_each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *,
                   once: bool = False, mode: str = "append",
                   trigger: str = TRIGGER) -> StreamingQuery:
    """Call ``handle`` per micro-batch: at least once, a failed batch is handed over again."""
    return _start(stream.writeStream.foreachBatch(handle).outputMode(mode)
                  .option("checkpointLocation", checkpoint), once, trigger)


def at_least_once(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False,
                  trigger: str = TRIGGER) -> StreamingQuery:
    """Plain append per batch; a batch that is retried after its write shows twice."""
    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("append").parquet(path)
    return for_each_batch(stream, write, checkpoint, once=once, trigger=trigger)


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Store a batch under its number; writing it again replaces it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def exactly_once(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False,
                 reduce: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append",
                 trigger: str = TRIGGER) -> StreamingQuery:
    """Idempotent batches: retries overwrite their own folder.

    ``reduce`` may shrink a batch first (to one row per key, say).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(reduce(batch) if reduce else batch, batch_id, path)
    return for_each_batch(stream, write, checkpoint, once=once, mode=mode, trigger=trigger)


def read_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Everything `exactly_once` stored so far."""
    reader = spark.read if schema is None else spark.read.schema(f"{schema}, batch long")
    return reader.option("basePath", path).parquet(f"{path}/batch=*").drop("batch")


def write_levels(batch: DataFrame, batch_id: int, path: str, reduce: Callable[[DataFrame], DataFrame],
                 fan: int = FAN) -> None:
    """Store a reduced batch in a number of folders that grows with the logarithm of the batches.

    ``reduce`` must take its own results and change nothing when rows come again (the newest row per key, the
    smallest time per user). Each level has ``fan`` slots that are used in turns. When a level's last slot is
    filled, its slots are reduced together into the next slot one level up, and only then are they used again: what a
    slot loses when it is overwritten is in the level above already. The two marks are the manifest: they are written in
    turns, after the batch and its reductions, and say which batch is stored in full. A batch that fails in between is
    stored again from the start; one that is marked is left alone. Other numbers belong to
    another checkpoint and are refused, since they would overwrite slots out of turn.
    """
    spark = batch.sparkSession
    done = stored_until(spark, path)
    if batch_id == done:
        return
    if done >= 0 and batch_id != done + 1:
        raise ValueError(f"batch {batch_id} cannot follow batch {done} in {path}: one checkpoint per folder")
    reduced = reduce(batch)
    reduced.write.mode("overwrite").parquet(f"{path}/level=0/slot={batch_id % fan}")
    level, full = 0, batch_id + 1
    while full % fan == 0:
        full //= fan
        slots = spark.read.schema(reduced.schema).parquet(f"{path}/level={level}/slot=*")
        level += 1
        reduce(slots).write.mode("overwrite").parquet(f"{path}/level={level}/slot={(full - 1) % fan}")
    spark.range(1).select(F.lit(batch_id).cast("long").alias("batch")).write.mode("overwrite").parquet(
        f"{path}/marks/turn={batch_id % 2}")


def stored_until(spark: SparkSession, path: str) -> int:
    """Number of the last batch that `write_levels` stored in full; -1 if none."""
    try:
        marks = spark.read.schema("batch long").parquet(f"{path}/marks/turn=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    last = marks.agg(F.max("batch")).first()[0]
    return -1 if last is None else last


def read_levels(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Everything `write_levels` holds; a row may come several times, until it is reduced again."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/level=*/slot=*")


def reduced_levels(stream: DataFrame, path: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame], *,
                   once: bool = False, fan: int = FAN, mode: str = "append",
                   trigger: str = TRIGGER) -> StreamingQuery:
    """Keep a small table current: see `write_levels`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_levels(batch, batch_id, path, reduce, fan)
    return for_each_batch(stream, write, checkpoint, once=once, mode=mode, trigger=trigger)


def keep_latest(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False,
                fan: int = FAN, trigger: str = TRIGGER) -> StreamingQuery:
    """Changelog to a compact log: of each batch, and of each ``fan`` batches, the last change of each key is stored.

    `current_table` folds what is there; no state is kept between batches.
    """
    return reduced_levels(stream, path, checkpoint, _last_changes, once=once, fan=fan, trigger=trigger)


def _last_changes(batch: DataFrame) -> DataFrame:
    rest = [c for c in batch.columns if c != "id"]
    return (batch.groupBy("id").agg(F.max(F.struct(changes.log_order().alias("at"), *rest)).alias("c"))
            .select("id", *[F.col(f"c.{name}").alias(name) for name in rest]))


def current_table(spark: SparkSession, path: str) -> DataFrame:
    return changes.latest(read_levels(spark, path))


def upsert_documents(stream: DataFrame, path: str, checkpoint: str, key: str, version: str, *,
                     once: bool = False, fan: int = FAN, trigger: str = TRIGGER) -> StreamingQuery:
    """One document per key and slot of `write_levels`; `current_documents` lets the newest version win."""
    def newest(batch: DataFrame) -> DataFrame:
        return _newest(batch, key, version)
    return reduced_levels(stream, path, checkpoint, newest, once=once, fan=fan, trigger=trigger)


def _newest(df: DataFrame, key: str, version: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (key, version)]
    return (df.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("d"))
            .select(key, "d.*").select(*df.columns))


def current_documents(spark: SparkSession, path: str, key: str, version: str) -> DataFrame:
    return _newest(read_levels(spark, path), key, version)


def progress(query: StreamingQuery) -> list[dict[str, object]]:
    """Throughput of a live query: rows and rates of its recent micro-batches."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"],
             "rows_per_second": p["processedRowsPerSecond"]} for p in query.recentProgress]


def rebalanced(stream: DataFrame, partitions: int) -> DataFrame:
    """Round-robin over tasks, for work that is uneven across source partitions."""
    return stream.repartition(partitions)
