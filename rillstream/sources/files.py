"""File, database and generated sources with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_seconds, sensor_reading

# Fixed file layouts: the trip file has 17 columns, 7 of which are used; the zone file has 4.
TRIP_COLUMNS = [
    "vendor_id", "pickup_time", "dropoff_time", "passenger_count", "trip_distance", "rate_code",
    "store_flag", "start_location_id", "dest_location_id", "payment_type", "fare", "extra", "tax",
    "tip", "tolls", "surcharge", "total"]
TRIP_USED = {
    "vendor_id": "int", "pickup_time": "time", "dropoff_time": "time", "passenger_count": "int",
    "trip_distance": "float", "start_location_id": "int", "dest_location_id": "int"}
ZONE_SCHEMA = "location_id int, borough string, zone string, service_zone string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON events, one per line; the schema is inferred unless it is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def trip_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trip records (plain or gzip CSV with a header), the used columns only.

    A record that does not have its 17 fields fails the read.
    """
    schema = ", ".join(f"{c} string" for c in TRIP_COLUMNS)
    # without pruning all fields are parsed, which is what checks their number
    raw = spark.read.option("columnPruning", "false").csv(path, schema=schema, header=True,
                                                          mode="FAILFAST")
    return raw.select(*[
        (parse_seconds(F.col(c)) if kind == "time" else F.col(c).cast(kind)).alias(c)
        for c, kind in TRIP_USED.items()])


def zone_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("columnPruning", "false").csv(path, schema=ZONE_SCHEMA, header=True,
                                                           mode="FAILFAST")


def with_ride_ids(trips: DataFrame) -> DataFrame:
    """Ride ids 1, 2, … in file order: by path, and by place in the file.

    ``trips`` comes straight from files. Rows are numbered within the block that one task reads; only the
    counts of the blocks, one row each, are added up in one place.
    """
    block = ["__file", "__block"]
    placed = trips.select("*", F.col("_metadata.file_path").alias("__file"),
                          F.col("_metadata.file_block_start").alias("__block"),
                          F.monotonically_increasing_id().alias("__at"))
    counts = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*block, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    number = F.row_number().over(Window.partitionBy(*block).orderBy("__at"))
    return (placed.withColumn("__number", number).join(starts, block)
            .select(*trips.columns, (F.col("__start") + F.col("__number")).alias("ride_id")))


def sensor_lines(spark: SparkSession, path: str) -> DataFrame:
    """Sensor readings from text lines."""
    return spark.read.text(path).select(sensor_reading(F.col("value")).alias("r")).select("r.*")


def jdbc_table(spark: SparkSession, url: str, name: str, *, key: str | None = None,
               lower: int | None = None, upper: int | None = None, partitions: int | None = None,
               **options: str) -> DataFrame:
    """Dimension table of a database, read in key ranges if these are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    if key is not None:
        reader = (reader.option("partitionColumn", key).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", partitions))
    return reader.options(**options).load()


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def rate_stream(spark: SparkSession, rows_per_second: int = 1, *,
                rows_per_batch: int | None = None) -> DataFrame:
    """Generated events as text with a routing key; a fixed batch size gives fixed content."""
    if rows_per_batch:
        raw = (spark.readStream.format("rate-micro-batch")
               .option("rowsPerBatch", rows_per_batch).load())
    else:
        raw = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return raw.select(F.col("timestamp"), F.col("value").cast("string").alias("event"),
                      F.col("value").cast("string").alias("routing_key"))
