"""Channels, subscriptions and read positions over keyed tables.

messages: channel, offset, from_user, text. subscriptions: user, channel, position,
where position is the next offset to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import chat_line, direct_channel
from .joins import HEAVY_ROWS, salted_join
from .ordered import running_sum


def fan_out(messages: DataFrame, subscriptions: DataFrame, *,
            heavy_rows: int = HEAVY_ROWS, salts: int = 64) -> DataFrame:
    """Messages each subscriber has not read yet, busy channels spread over many tasks."""
    joined = salted_join(messages, subscriptions, ["channel"], ["offset"],
                         heavy_rows=heavy_rows, salts=salts)
    return joined.where("offset >= position").select(
        "user", "channel", "offset", chat_line(F.col("from_user"), F.col("text")).alias("line"))


def unread_counts(messages: DataFrame, subscriptions: DataFrame, *,
                  block: int = 1 << 16) -> DataFrame:
    """Unread messages per subscription, without building message-subscriber pairs.

    One running count over messages and distinct read positions together, by blocks of offsets, gives
    the messages in front of each position; the rest of the channel is unread.
    """
    points = subscriptions.select("channel", "position").distinct()
    # a position comes in front of the message at its offset
    marks = messages.select("channel", (F.col("offset") * 2 + 1).alias("at"), F.lit(1).alias("w")).unionByName(
        points.select("channel", (F.col("position") * 2).alias("at"), F.lit(0).alias("w")))
    read = running_sum(marks, "w", "at", "read", partition_by=["channel"], width=2 * block).where(
        "w = 0").select("channel", F.expr("at div 2").alias("position"), "read")
    sizes = messages.groupBy("channel").agg(F.count(F.lit(1)).alias("size"))
    inbox = salted_join(subscriptions.select("user", "channel", "position"), read.join(sizes, "channel", "left"),
                        ["channel", "position"], ["user"], "left")
    return inbox.select("user", "channel", (F.coalesce("size", F.lit(0)) - F.coalesce("read", F.lit(0))).alias("unread"))


def latest_positions(reads: DataFrame) -> DataFrame:
    """Read position per user and channel: the last recorded one wins."""
    return reads.groupBy("user", "channel").agg(F.max_by("position", "rev").alias("position"))


def subscription_changes(existing: DataFrame, current: DataFrame) -> DataFrame:
    """Subscriptions that went away and that are new."""
    keys = ["user", "channel"]
    gone = existing.join(current, keys, "left_anti").select(*keys, F.lit("removed").alias("change"))
    new = current.join(existing, keys, "left_anti").select(*keys, F.lit("added").alias("change"))
    return gone.unionByName(new)


def direct_subscriptions(sends: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Subscriptions that direct messages bring about: both people, where not yet there.

    sends: from_user, to_user.
    """
    pairs = sends.select("from_user", "to_user").distinct()
    both = pairs.select(
        F.explode(F.array("from_user", "to_user")).alias("user"),
        direct_channel(F.col("from_user"), F.col("to_user")).alias("channel")).distinct()
    return both.join(subscriptions.select("user", "channel"), ["user", "channel"], "left_anti")


def subscribe(requests: DataFrame, channels: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Outcome of subscribe requests: subscribed, already subscribed, or no such channel."""
    known = channels.select("channel", F.lit(True).alias("exists_")).distinct()
    held = subscriptions.select("user", "channel", F.lit(True).alias("held_")).distinct()
    outcome = (F.when(F.col("exists_").isNull(), "no such channel")
               .when(F.col("held_"), "already subscribed").otherwise("subscribed"))
    return (requests.select("user", "channel").distinct()
            .join(known, "channel", "left").join(held, ["user", "channel"], "left")
            .select("user", "channel", outcome.alias("outcome")))


def public_channels(channels: DataFrame) -> DataFrame:
    return channels.where(F.col("channel").startswith("#"))
