"""Word counts over lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(line: Column) -> Column:
    """Split on single spaces; empty tokens inside the line stay, trailing ones go.

    A line of nothing but spaces has no token; an empty line has one empty token.
    """
    bare = F.rtrim(line)
    return F.when((bare == "") & (F.length(line) > 0), F.array().cast("array<string>")).otherwise(
        F.split(bare, " "))


def word_count(df: DataFrame, line: str, time: str | None = None,
               size: str = "10 seconds") -> DataFrame:
    """Occurrences per word, per tumbling window of ``time`` if it is given."""
    keep = [time] if time else []
    words = df.select(*keep, F.explode(tokens(F.col(line))).alias("word"))
    if not time:
        return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return (words.groupBy(F.window(time, size).alias("w"), "word")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "word", "cnt"))
