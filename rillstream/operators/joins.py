"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import dense_index, heavy_keys, marked_heavy, running_sum

HEAVY_ROWS = 1_000_000


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str],
                how: str = "inner", *, heavy_rows: int = HEAVY_ROWS, salts: int = 64) -> DataFrame:
    """Equi-join whose heavy keys are spread over ``salts`` tasks, on the left and for inner joins on the right too.

    ``spread`` names left columns that tell rows of one key apart. Right rows of
    keys heavy on the left are repeated once per salt; a left row meets exactly one
    copy, so inner, left, left_semi and left_anti joins keep their meaning. In an inner join left rows are
    repeated likewise for keys heavy on the right. Semi and anti joins need each right key once. In a
    left join keys heavy on the right are left to adaptive execution. Rows with a null key meet nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    if how in ("left_semi", "left_anti"):
        right = right.select(*on).distinct()
    heavy = heavy_keys(left, on, heavy_rows).withColumnRenamed("__heavy", "__left")
    if how == "inner":
        heavy = heavy.join(heavy_keys(right, on, heavy_rows).withColumnRenamed("__heavy", "__right"), on, "full")
    else:
        heavy = heavy.withColumn("__right", F.lit(None).cast("boolean"))
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    hashable = [f.name for f in right.schema.fields
                if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]

    def one(flag: Column) -> Column:
        return F.array(F.when(flag, F.col("__part")).otherwise(0))

    def all_of(flag: Column) -> Column:
        return F.when(flag, every).otherwise(F.array(F.lit(0)))

    def salted(rows: DataFrame, by: Sequence[str], first: Column, second: Column) -> DataFrame:
        marked = marked_heavy(rows, on, heavy, by, salts)
        return (marked.withColumn("__salt", F.explode(first)).withColumn("__salt2", F.explode(second))
                .drop("__part", "__left", "__right"))

    salted_left = salted(left, spread, one(F.col("__left") | no_key), all_of(F.col("__right")))
    salted_right = salted(right, hashable, all_of(F.col("__left")), one(F.col("__right")))
    return salted_left.join(salted_right, on + ["__salt", "__salt2"], how).drop("__salt", "__salt2")


def enrich_trips(trips: DataFrame, zones: DataFrame, how: str = "inner") -> DataFrame:
    """Look up the zone table for both ends of a trip.

    ``zones``: location_id, borough, zone, service_zone. With ``how="left"`` trips
    with unknown locations stay. No broadcast is forced: Spark picks one only for a
    zone table below its own size threshold.
    """
    out = trips
    for side in ("start", "dest"):
        looked_up = zones.select(
            F.col("location_id").alias(f"{side}_location_id"),
            F.col("borough").alias(f"{side}_location_borough"),
            F.col("zone").alias(f"{side}_location_zone"),
            F.col("service_zone").alias(f"{side}_location_service_zone"))
        out = out.join(looked_up, f"{side}_location_id", how)
    return out


def lookup_misses(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Location ids without a zone row, with the number of trip ends that use them."""
    ends = trips.select(F.explode(F.array("start_location_id", "dest_location_id"))
                        .alias("location_id"))
    used = ends.groupBy("location_id").agg(F.count(F.lit(1)).alias("trip_ends"))
    return used.join(zones.select("location_id"), "location_id", "left_anti")


def events_in_slices(events: DataFrame, slices: DataFrame, key: str, position: str, *,
                     block: int = 1 << 16) -> DataFrame:
    """Range join: events of the slice's key with start <= position < end.

    ``slices``: key, start_offset, end_offset and any other columns. Bounds are turned into event
    numbers of the key by one running count over events and bounds together; both sides then meet on (key, block
    of event numbers). A slice is repeated once per ``block`` events in it, whatever the range of
    positions it covers, and a long slice or a heavy key is shared by many tasks.
    """
    numbered = dense_index(events.where(F.col(key).isNotNull() & F.col(position).isNotNull()), position, "__i",
                           partition_by=[key])
    bounds = slices.select(key, F.explode(F.array("start_offset", "end_offset")).alias("__at")).distinct()
    # a bound comes in front of the event at its position
    marks = events.select(key, (F.col(position) * 2 + 1).alias("__at"), F.lit(1).alias("__w")).unionByName(
        bounds.select(key, (F.col("__at") * 2).alias("__at"), F.lit(0).alias("__w"))).where(
        F.col(key).isNotNull() & F.col("__at").isNotNull())
    before = running_sum(marks, "__w", "__at", "__n", partition_by=[key]).where("__w = 0").select(
        key, F.expr("__at div 2").alias("__at"), "__n")
    spans = (slices.where("end_offset > start_offset")
             .join(before.select(key, F.col("__at").alias("start_offset"), F.col("__n").alias("__from")),
                   [key, "start_offset"])
             .join(before.select(key, F.col("__at").alias("end_offset"), F.col("__n").alias("__to")),
                   [key, "end_offset"])
             .where("__to > __from")
             .withColumn("__block", F.explode(F.expr(f"sequence(__from div {block}, (__to - 1) div {block})")))
             .select(*slices.columns, "__from", "__to", "__block"))
    placed = numbered.withColumn("__block", F.expr(f"__i div {block}"))
    return (placed.join(spans, [key, "__block"])
            .where((F.col("__i") >= F.col("__from")) & (F.col("__i") < F.col("__to")))
            .drop("__block", "__i", "__from", "__to"))
