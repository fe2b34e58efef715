"""Event-time windows over batch tables; `rillstream.streaming.windows` has the live forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import highest_before


def _bounds(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.select(*keys, F.col("w.start").alias("window_start"),
                     F.col("w.end").alias("window_end"), *values)


def tumbling(df: DataFrame, time: str, size: str, keys: Sequence[str],
             aggregates: Sequence[Column], names: Sequence[str],
             origin: str = "0 seconds") -> DataFrame:
    """Fixed windows of ``size``; ``origin`` shifts their start (day from 08:00: ``8 hours``)."""
    w = F.window(time, size, size, origin).alias("w")
    return _bounds(df.groupBy(*keys, w).agg(*aggregates), keys, names)


def hopping_count(df: DataFrame, time: str, size: str, slide: str, keys: Sequence[str],
                  counted: str, name: str = "cnt") -> DataFrame:
    """Count non-null ``counted`` in windows of ``size`` that start every ``slide``.

    ``slide`` must divide ``size``. Rows are first counted per pane of one slide,
    so a row is not copied into each window it belongs to; only pane
    totals are.
    """
    panes = (df.groupBy(*keys, F.window(time, slide).alias("p"))
             .agg(F.count(counted).alias("n"))
             .select(*keys, F.col("p.start").alias("pane"), "n"))
    windows = panes.groupBy(*keys, F.window("pane", size, slide).alias("w")).agg(
        F.sum("n").alias(name))
    return _bounds(windows, keys, [name])


def averages(df: DataFrame, time: str, size: str, key: str, value: str) -> DataFrame:
    """Average per key and window, stamped with the window end as its new event time."""
    w = F.window(time, size).alias("w")
    return (df.groupBy(key, w).agg(F.avg(value).alias(value))
            .select(key, F.col("w.end").alias(time), value))


def chained_averages(df: DataFrame, time: str, sizes: Sequence[str], key: str,
                     value: str) -> DataFrame:
    """Feed each averaged series into the next, coarser window."""
    for size in sizes:
        df = averages(df, time, size, key, value)
    return df


def cumulative_distinct(df: DataFrame, time: str, who: str, step_minutes: int = 10,
                        name: str = "uv") -> DataFrame:
    """Distinct ``who`` from the start of the day to each step of it.

    A visitor counts from the step of their first visit on, so only the first visit
    per day is shuffled, and the rest is a running sum of at most
    ``1440 / step_minutes`` steps per day.
    """
    last = 1440 // step_minutes - 1
    day = F.date_trunc("day", time).cast("timestamp_ntz")
    minute = F.hour("first") * 60 + F.minute("first")
    firsts = (df.where(F.col(time).isNotNull())
              .groupBy(day.alias("day"), who).agg(F.min(time).alias("first")))
    fresh = (firsts.groupBy("day", F.floor(minute / step_minutes).cast("int").alias("step"))
             .agg(F.count(who).alias("n")))
    # at most one entry per step of the day
    days = fresh.groupBy("day").agg(
        F.min("step").alias("s"),
        F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("new"))
    every = days.select("day", "new", F.explode(F.sequence("s", F.lit(last))).alias("step"))
    running = Window.partitionBy("day").orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.col("day") + F.make_dt_interval(mins=(F.col("step") + 1) * step_minutes)
    new = F.coalesce(F.try_element_at("new", F.col("step")), F.lit(0))
    return every.withColumn(name, F.sum(new).over(running)).select(
        F.col("day").alias("window_start"), end.alias("window_end"), name)


def late_rows(df: DataFrame, time: str, order: str, delay: str, size: str) -> DataFrame:
    """Rows that arrived after their window had closed.

    ``order`` is the micro-batch number of each row. A row is late when its window
    ended at or before the highest time of the earlier batches minus ``delay``. A live job
    still takes late rows of the one batch in which it closes the window, and drops later ones.
    """
    peaks = df.groupBy(order).agg(F.max(time).alias("__peak"))
    marks = highest_before(peaks, "__peak", order, "watermark").select(
        order, (F.col("watermark") - F.expr(f"interval {delay}")).alias("watermark"))
    return (df.join(marks, order)
            .withColumn("__end", F.window(time, size)["end"])
            .where(F.col("__end") <= F.col("watermark")).drop("__end"))
