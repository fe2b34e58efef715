"""Changelogs and keyed update logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, keyed_maps
from . import inputs
from .inputs import CHANGES, MAP_UPDATES, SECTORS
from .registry import query


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.decode(inputs.changelog(spark, sf_dir))


def _latest(source: str) -> str:
    return f"""(SELECT id, after_value AS value FROM {source} WHERE true
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1 AND op <> 'd')"""


@query(f"SELECT id, op, before_value, after_value, pos, ts_ms FROM {CHANGES}")
def cdc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select(
        "id", "op", F.col("before.value").alias("before_value"),
        F.col("after.value").alias("after_value"), "pos", "ts_ms")


@query(f"SELECT * FROM {_latest(CHANGES)}")
def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest(_decoded(spark, sf_dir))


# Noon of the fifteenth day of the events.
MOMENT = 1_705_320_000_000


@query(f"SELECT * FROM {_latest(f'(SELECT * FROM {CHANGES} WHERE ts_ms <= {MOMENT})')}")
def cdc_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.as_of(_decoded(spark, sf_dir), MOMENT)


@query(f"""SELECT id, pos, -1 AS sign, before_value AS value FROM {CHANGES} WHERE op IN ('u', 'd')
  UNION ALL SELECT id, pos, 1, after_value FROM {CHANGES} WHERE op IN ('c', 'r', 'u')""")
def cdc_retractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.retractions(_decoded(spark, sf_dir))


_INDEX = f"""SELECT sector,
  round(avg(value), 6) AS "index"
  FROM {_latest(CHANGES)} JOIN {SECTORS} USING (id) GROUP BY sector"""


@query(_INDEX)
def cdc_sector_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.group_average(changes.latest(_decoded(spark, sf_dir)),
                                 inputs.sectors(spark, sf_dir)).withColumn("index", F.round("index", 6))


@query(_INDEX)
def cdc_sector_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.folded_average(changes.retractions(_decoded(spark, sf_dir)),
                                  inputs.sectors(spark, sf_dir)).withColumn("index", F.round("index", 6)).withColumn("index", F.round("index", 6))


@query("""SELECT user_id, arg_max(value, event_id) AS value FROM events
  WHERE event_type <> 'view' GROUP BY user_id""")
def upsert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views stand for readings that are not a number."""
    readings = inputs.table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_type") == "view", F.lit(float("nan")))
        .otherwise(F.col("value")))
    return changes.upsert_feed(readings, "user_id", "value", "event_id")


def _unconditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates without conditions; every other plain update puts two entries at once."""
    updates = inputs.map_updates(spark, sf_dir)
    pair = F.create_map("key", "value", F.concat(F.lit("all-"), F.col("value")), F.col("key"))
    op = F.when(F.col("op").isin("clear", "remove"), F.col("op")).when(
        F.col("op") == "putIfAbsent", "putAll").otherwise("put")
    return keyed_maps.put_all(updates.select("rev", op.alias("op"), "key", "value",
                                             pair.alias("entries")))


_PLAIN = f"""(SELECT rev, CASE WHEN op IN ('clear', 'remove') THEN op ELSE 'put' END AS op, key,
    value FROM {MAP_UPDATES}
  UNION ALL SELECT rev, 'put', 'all-' || value, key FROM {MAP_UPDATES} WHERE op = 'putIfAbsent')"""

_REPLAYED = f"""SELECT key, value FROM {_PLAIN}
  WHERE op <> 'clear' AND rev > (SELECT coalesce(max(rev), -1) FROM {_PLAIN} WHERE op = 'clear')
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY rev DESC) = 1 AND op = 'put'"""


@query(_REPLAYED)
def map_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_maps.replay(_unconditional(spark, sf_dir))


@query(_REPLAYED)
def map_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compacted log replays to the same map."""
    return keyed_maps.replay(keyed_maps.compacted(_unconditional(spark, sf_dir)))


_WALK = f"""(WITH RECURSIVE u AS (
    SELECT *, row_number() OVER (PARTITION BY epoch, key ORDER BY rev) AS rn FROM (
      SELECT *, sum(CAST(op = 'clear' AS INTEGER)) OVER (ORDER BY rev) AS epoch
      FROM {MAP_UPDATES}) WHERE op <> 'clear'),
  walk AS (
    SELECT epoch, key, rn, CAST(NULL AS VARCHAR) AS previous,
      CASE WHEN op IN ('put', 'putIfAbsent') THEN value END AS current FROM u WHERE rn = 1
    UNION ALL
    SELECT u.epoch, u.key, u.rn, w.current, CASE u.op
      WHEN 'put' THEN u.value
      WHEN 'putIfAbsent' THEN coalesce(w.current, u.value)
      WHEN 'remove' THEN NULL
      WHEN 'removeIf' THEN CASE WHEN w.current = u.expected THEN NULL ELSE w.current END
      WHEN 'replace' THEN CASE WHEN w.current IS NULL THEN NULL ELSE u.value END
      WHEN 'replaceIf' THEN CASE WHEN w.current = u.expected THEN u.value ELSE w.current END END
    FROM walk w JOIN u ON u.epoch = w.epoch AND u.key = w.key AND u.rn = w.rn + 1)
  SELECT u.rev, CAST(u.epoch AS BIGINT) AS epoch, u.key, u.op, w.previous, CASE u.op
      WHEN 'put' THEN true WHEN 'putIfAbsent' THEN w.previous IS NULL
      WHEN 'remove' THEN w.previous IS NOT NULL WHEN 'replace' THEN w.previous IS NOT NULL
      ELSE coalesce(w.previous = u.expected, false) END AS applied, w.current
  FROM walk w JOIN u USING (epoch, key, rn))"""


@query(f"SELECT * FROM {_WALK}")
def conditional_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_maps.conditional_replay(inputs.map_updates(spark, sf_dir))


_FINAL = f"""(SELECT key, current AS value FROM {_WALK}
  WHERE epoch = (SELECT count(*) FROM {MAP_UPDATES} WHERE op = 'clear')
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY rev DESC) = 1 AND current IS NOT NULL)"""


@query(f"SELECT * FROM {_FINAL}")
def conditional_final_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_maps.final_map(inputs.map_updates(spark, sf_dir))


@query(f"SELECT value, count(*) AS n FROM {_FINAL} GROUP BY value")
def map_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_maps.value_counts(keyed_maps.final_map(inputs.map_updates(spark, sf_dir)))


@query(f"""SELECT count(*) AS size FROM {_FINAL}""")
def map_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_maps.size(keyed_maps.final_map(inputs.map_updates(spark, sf_dir)))


@query(f"""SELECT k.key, coalesce(f.value, 'none') AS value
  FROM (SELECT DISTINCT key FROM {MAP_UPDATES}) k LEFT JOIN {_FINAL} f USING (key)""")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = inputs.map_updates(spark, sf_dir)
    return keyed_maps.lookup(updates.select("key").distinct(), keyed_maps.final_map(updates),
                             F.lit("none"))


@query("""SELECT c_custkey, c_name FROM customer
  WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def conditional_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers offered twice for insertion; taken keys and second offers are rejected."""
    taken = inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("c_custkey")).distinct()
    offered = inputs.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.lit(1).alias("attempt"))
    again = offered.withColumn("c_name", F.lit("second")).withColumn("attempt", F.lit(2))
    return keyed_maps.insert_if_absent(taken, offered.unionByName(again), ["c_custkey"],
                                       "attempt").drop("attempt")
