"""Channels, subscriptions and unread messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import channel_name, channel_stream, padded_key, unpadded_key
from ..operators import chat, keyed_maps
from . import inputs
from .inputs import MESSAGES, SUBSCRIPTIONS
from .registry import query


@query(f"""SELECT s."user", m.channel, m."offset", '[' || m.from_user || '] ' || m.text AS line
  FROM {MESSAGES} m JOIN {SUBSCRIPTIONS} s ON s.channel = m.channel AND m."offset" >= s.position""")
def message_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.fan_out(inputs.messages(spark, sf_dir), inputs.subscriptions(spark, sf_dir))


@query(f"""SELECT s."user", s.channel, count(m."offset") AS unread FROM {SUBSCRIPTIONS} s
  LEFT JOIN {MESSAGES} m ON s.channel = m.channel AND m."offset" >= s.position GROUP BY ALL""")
def unread_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.unread_counts(inputs.messages(spark, sf_dir), inputs.subscriptions(spark, sf_dir))


@query(f"""SELECT from_user AS "user", channel, max("offset") + 1 AS position FROM {MESSAGES}
  GROUP BY ALL""")
def read_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = inputs.messages(spark, sf_dir).select(
        F.col("from_user").alias("user"), "channel", (F.col("offset") + 1).alias("position"),
        F.col("offset").alias("rev"))
    return chat.latest_positions(reads)


_EARLY = f'(SELECT DISTINCT from_user AS "user", channel FROM {MESSAGES} WHERE "offset" < 2)'
_LATER = f'(SELECT DISTINCT from_user AS "user", channel FROM {MESSAGES} WHERE "offset" >= 2)'


@query(f"""SELECT *, 'removed' AS change FROM (SELECT * FROM {_EARLY} EXCEPT SELECT * FROM {_LATER})
  UNION ALL SELECT *, 'added' FROM (SELECT * FROM {_LATER} EXCEPT SELECT * FROM {_EARLY})""")
def subscription_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoke = inputs.messages(spark, sf_dir).select(F.col("from_user").alias("user"), "channel",
                                                  "offset")
    early = spoke.where("offset < 2").select("user", "channel").distinct()
    later = spoke.where("offset >= 2").select("user", "channel").distinct()
    return chat.subscription_changes(early, later)


_SENDS = """(SELECT DISTINCT role AS a, 'user-' || CAST(conv_id AS VARCHAR) AS b
  FROM conversations)"""
_HELD = f"""(SELECT a AS "user", a || '-' || b AS channel FROM {_SENDS} WHERE a = 'assistant')"""


@query(f"""SELECT "user", channel FROM (
    SELECT a AS "user", CASE WHEN a < b THEN a || '-' || b ELSE b || '-' || a END AS channel
    FROM {_SENDS} UNION
    SELECT b, CASE WHEN a < b THEN a || '-' || b ELSE b || '-' || a END FROM {_SENDS})
  EXCEPT SELECT * FROM {_HELD}""")
def dm_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct messages subscribe both sides; assistants are subscribed already."""
    sends = inputs.table(spark, sf_dir, "conversations").select(
        F.col("role").alias("from_user"),
        F.concat(F.lit("user-"), F.col("conv_id").cast("string")).alias("to_user"))
    held = sends.where("from_user = 'assistant'").select(
        F.col("from_user").alias("user"),
        F.concat("from_user", F.lit("-"), "to_user").alias("channel")).distinct()
    return chat.direct_subscriptions(sends, held)


_REQUESTS = """(SELECT DISTINCT role AS "user",
  '#c' || CAST(conv_id + turn AS VARCHAR) AS channel FROM conversations)"""


@query(f"""SELECT r."user", r.channel, CASE WHEN c.channel IS NULL THEN 'no such channel'
    WHEN s.channel IS NOT NULL THEN 'already subscribed' ELSE 'subscribed' END AS outcome
  FROM {_REQUESTS} r LEFT JOIN (SELECT DISTINCT channel FROM {MESSAGES}) c USING (channel)
  LEFT JOIN {SUBSCRIPTIONS} s ON s."user" = r."user" AND s.channel = r.channel""")
def subscribe_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = inputs.table(spark, sf_dir, "conversations").select(
        F.col("role").alias("user"), F.concat(
            F.lit("#c"), (F.col("conv_id") + F.col("turn")).cast("string")).alias("channel"))
    channels = inputs.messages(spark, sf_dir).select("channel")
    return chat.subscribe(requests, channels, inputs.subscriptions(spark, sf_dir))


@query("""SELECT DISTINCT CASE WHEN conv_id % 2 = 0 THEN '#' ELSE '' END
    || 'c' || CAST(conv_id AS VARCHAR) AS given,
  '#c' || CAST(conv_id AS VARCHAR) AS channel, 'c' || CAST(conv_id AS VARCHAR) AS stream,
  lpad('c' || CAST(conv_id AS VARCHAR), 16, ' ') AS padded, conv_id % 2 = 0 AS is_public
  FROM conversations""")
def channel_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs.table(spark, sf_dir, "conversations").select(F.concat(
        F.when(F.expr("conv_id % 2 = 0"), "#").otherwise(""), F.lit("c"),
        F.col("conv_id").cast("string")).alias("given")).distinct()
    stream = channel_stream(F.col("given"))
    return given.select("given", channel_name(F.col("given")).alias("channel"),
                        unpadded_key(padded_key(stream, 16)).alias("stream"),
                        padded_key(stream, 16).alias("padded"),
                        F.col("given").startswith("#").alias("is_public"))


@query(f"""SELECT channel, position FROM {SUBSCRIPTIONS} WHERE "user" = 'system'""")
def subscriptions_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_maps.rows_of(inputs.subscriptions(spark, sf_dir), user="system").select(
        "channel", "position")
