"""Live event-time windows.

Event time must be TIMESTAMP; late rows (below the watermark) are dropped, and
a window is emitted once the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.words import tokens


def watermarked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """Bounded out-of-orderness on one time column; zoneless times become instants."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def windowed(stream: DataFrame, time: str, delay: str, size: str, keys: Sequence[str],
             aggregates: Sequence[Column], *, slide: str | None = None,
             origin: str = "0 seconds") -> DataFrame:
    """Tumbling (or, with ``slide``, hopping) aggregates for append or update mode."""
    w = F.window(time, size, slide or size, origin).alias("w")
    grouped = watermarked(stream, time, delay).groupBy(*keys, w).agg(*aggregates)
    names = [c for c in grouped.columns if c not in (*keys, "w")]
    return grouped.select(*keys, F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), *names)


def hopping_count(stream: DataFrame, time: str, delay: str, size: str, slide: str,
                  keys: Sequence[str], counted: str, name: str = "cnt") -> DataFrame:
    return windowed(stream, time, delay, size, keys, [F.count(counted).alias(name)], slide=slide)


def averages(stream: DataFrame, time: str, delay: str, size: str, key: str,
             value: str) -> DataFrame:
    """Window averages stamped with the window end, ready to feed a coarser job."""
    out = windowed(stream, time, delay, size, [key], [F.avg(value).alias(value)])
    return out.select(key, F.col("window_end").alias(time), value)


def word_count(stream: DataFrame, line: str = "value", size: str = "10 seconds") -> DataFrame:
    """Words per processing-time window: the clock of the micro-batch is the time."""
    words = stream.select(F.current_timestamp().alias("at"),
                          F.explode(tokens(F.col(line))).alias("word"))
    return windowed(words, "at", "0 seconds", size, ["word"], [F.count(F.lit(1)).alias("cnt")])
