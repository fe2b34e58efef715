"""Change-data-capture: decoding, current state, replay and aggregation of changelogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed record layout of the changelog (before/after images and source position).
IMAGE = "struct<id:string,value:double>"
ENVELOPE = (f"before {IMAGE}, after {IMAGE}, "
            "source struct<ts_ms:bigint,db:string,`table`:string,file:string,pos:bigint,row:int>, "
            "op string, ts_ms bigint")


def decode(changelog: DataFrame, payload: str = "event") -> DataFrame:
    """JSON change records to typed columns; op is r, c, u or d."""
    parsed = changelog.select(F.from_json(payload, ENVELOPE).alias("e"))
    return parsed.select(
        F.coalesce("e.after.id", "e.before.id").alias("id"), "e.op", "e.before", "e.after",
        F.col("e.source.file").alias("file"), F.col("e.source.pos").alias("pos"),
        F.col("e.source.row").alias("row"), "e.ts_ms")


def log_order() -> Column:
    """Where a change stands in the log. Log files are numbered, and the number outgrows its leading zeros."""
    number = F.regexp_extract("file", "([0-9]+)$", 1).try_cast("decimal(38,0)")
    return F.struct(number.alias("number"), "file", "pos", "row")


def latest(changes: DataFrame) -> DataFrame:
    """Current table: the last change of each key wins, deleted keys are gone.

    An aggregate rather than a ranking, so each task reduces its rows to one per key
    before anything is shuffled.
    """
    last = changes.groupBy("id").agg(
        F.max(F.struct(log_order().alias("at"), "op", F.col("after.value").alias("value"))).alias("c"))
    return last.where("c.op <> 'd'").select("id", F.col("c.value").alias("value"))


def as_of(changes: DataFrame, millis: Column | int) -> DataFrame:
    """The table as it was at a moment."""
    bound = F.lit(millis) if isinstance(millis, int) else millis
    return latest(changes.where(F.col("ts_ms") <= bound))


def retractions(changes: DataFrame) -> DataFrame:
    """Signed rows: an update takes back its old image and adds the new one."""
    removed = F.struct(F.lit(-1).alias("sign"), F.col("before.value").alias("value"),
                       F.col("before").isNotNull().alias("present"))
    added = F.struct(F.lit(1).alias("sign"), F.col("after.value").alias("value"),
                     F.col("after").isNotNull().alias("present"))
    signed = changes.select("id", "pos", "op", F.explode(
        F.when(F.col("op").isin("c", "r"), F.array(added))
        .when(F.col("op") == "d", F.array(removed))
        .otherwise(F.array(removed, added))).alias("s"))
    return signed.where("s.present").select("id", "pos", "s.sign", "s.value")


def group_average(table: DataFrame, dimension: DataFrame, group: str = "sector",
                  name: str = "index") -> DataFrame:
    """Average value per group of the joined dimension."""
    return table.join(dimension, "id").groupBy(group).agg(F.avg("value").alias(name))


def folded_average(signed: DataFrame, dimension: DataFrame, group: str = "sector",
                   name: str = "index") -> DataFrame:
    """The same average from signed rows alone: counted per key and value first, then per group.

    Values are taken back before they are added up, so a large one that is gone leaves no rounding behind;
    null values do not count.
    """
    per_value = signed.where(F.col("value").isNotNull()).groupBy("id", "value").agg(
        F.sum("sign").alias("rows")).where("rows <> 0")
    return (per_value.join(dimension, "id").groupBy(group)
            .agg(F.sum(F.col("value") * F.col("rows")).alias("t"), F.sum("rows").alias("n"))
            .where("n > 0").select(group, (F.col("t") / F.col("n")).alias(name)))


def upsert_feed(readings: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Insert-or-update feed: last real number per key; NaN and null readings are skipped."""
    real = readings.where(F.col(value).isNotNull() & ~F.isnan(value))
    return real.groupBy(key).agg(F.max_by(value, order).alias(value))
