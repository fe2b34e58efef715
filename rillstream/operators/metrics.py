"""Latency, throughput and composition reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import base_counts
from .ordered import INDEX_WIDTH, dense_index, running_sums

# Fixed defaults of the statistics report.
PERCENTILES = (0.5, 0.95, 0.99, 0.999)
SAMPLE_ROWS = 500_000

_PER_DOUBLING = 64      # first-level cells per power of two
_LOWEST_EXPONENT = 1080
_OUTMOST = 1 << 20      # cell of infinity, beyond all others
_PARTS = 4096           # equal parts a cell is split into
_LEVELS = 2             # times it is split


def _magnitude_cell(value: Column) -> Column:
    """Order-preserving cell number; there are at most about 270,000 of them."""
    size = F.floor(F.log2(F.abs(value)) * _PER_DOUBLING) + _LOWEST_EXPONENT * _PER_DOUBLING
    finite = F.when(value == 0, 0).when(value > 0, size).otherwise(-size).cast("long")
    endless = F.abs(value) == F.lit(float("inf"))
    return (F.when(F.isnan(value), 2 * _OUTMOST).when(endless & (value > 0), _OUTMOST)
            .when(endless, -_OUTMOST).otherwise(finite).cast("long"))


def _holding(cells: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """For each target rank, the cell that holds it and the rank inside that cell.

    ``cells``: ``within`` columns, ``order``, n, targets (array of p and rank).
    """
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = cells.withColumn("upto", F.sum("n").over(w))
    return placed.select("*", F.explode(F.filter(
        "targets", lambda t: (t["rank"] < F.col("upto"))
        & (t["rank"] >= F.col("upto") - F.col("n")))).alias("t")).select(
        *[c for c in cells.columns if c != "targets"], F.col("t.p").alias("p"),
        (F.col("t.rank") - (F.col("upto") - F.col("n"))).alias("rank"))


def exact_percentiles(df: DataFrame, value: str,
                      percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Exact ``sorted[int(p * n)]`` (from 0) for each p, without sorting the data.

    Counts per magnitude cell find the cell of each rank, counts per part of that cell and per
    part of the part narrow it down, and only the distinct values left (some millions of doubles at most) are
    ordered. Values keep their type; NaN comes after infinity, nulls do not count.
    """
    values = df.where(F.col(value).isNotNull()).select(
        F.col(value).alias("v"), F.col(value).cast("double").alias("d"))
    celled = values.withColumn("cell", _magnitude_cell(F.col("d")))
    bounds = [F.min("d").alias("lo"), F.max("d").alias("hi")]
    counts = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *bounds)
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    targets = F.array(*[F.struct(
        F.lit(p).alias("p"), F.least(F.floor(F.lit(p) * total), total - 1).alias("rank"))
        for p in percentiles])
    # one row per percentile from here on, so the broadcasts below are bounded
    first = _holding(counts.withColumn("targets", targets).withColumn("g", F.lit(0)),
                     ["g"], "cell").drop("g", "n")
    part = F.when(F.col("hi") > F.col("lo"), F.least(
        F.floor((F.col("d") - F.col("lo")) / (F.col("hi") - F.col("lo")) * _PARTS),
        F.lit(_PARTS - 1))).otherwise(0).cast("long")
    left = celled.join(F.broadcast(first), "cell").drop("cell")
    for _ in range(_LEVELS):
        parted = left.withColumn("part", part)
        found = _narrow(parted, "part", *bounds)
        left = parted.drop("rank", "lo", "hi").join(F.broadcast(found), ["p", "part"]).drop("part")
    return _narrow(left, "v").select(F.col("p").alias("percentile"), F.col("v").alias("value"))


def _narrow(rows: DataFrame, cell: str, *bounds: Column) -> DataFrame:
    """Count rows per percentile and cell; keep the cell that holds the percentile's rank, and its bounds."""
    counts = (rows.groupBy("p", "rank", cell).agg(F.count(F.lit(1)).alias("n"), *bounds)
              .withColumn("targets", F.array(F.struct("p", "rank"))).drop("rank")
              .withColumnRenamed("p", "g"))
    return _holding(counts, ["g"], cell).drop("g", "n")


MEGABYTE = 1024.0 * 1024.0      # fixed unit of the report


def _rates(time: str, size: str) -> list[Column]:
    """First and last time of a group's records, and records and megabytes a second between them (null for no time)."""
    first, last = F.min(time), F.max(time)
    micros = F.nullif(F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp")), F.lit(0))
    return [first.alias("first_time"), last.alias("last_time"),
            (F.count(F.lit(1)) * 1e6 / micros).alias("rec_per_s"),
            (F.sum(size) * 1e6 / micros / MEGABYTE).alias("mb_per_s")]


def latency_report(df: DataFrame, value: str, time: str | None = None, size: Column | None = None) -> DataFrame:
    """Count, average and maximum of a reading; with ``time`` and ``size`` also rates over the whole time."""
    rates = [] if time is None or size is None else _rates(time, "__size")
    rows = df if size is None else df.withColumn("__size", size)
    return rows.agg(F.count(value).alias("records"), F.avg(value).alias("avg_value"),
                    F.max(value).alias("max_value"), *rates)


def systematic_sample(df: DataFrame, position: str, most: int = SAMPLE_ROWS, *,
                      width: int = INDEX_WIDTH) -> DataFrame:
    """Every k-th record, with k chosen so that about ``most`` records are taken."""
    every = df.agg(F.expr(f"count(1) div least(count(1), {most})")).scalar()
    indexed = dense_index(df, position, "sample_index", width=width)
    return indexed.where(F.col("sample_index") % every == 0)


def count_windows(df: DataFrame, position: str, value: str, size: Column, rows: int = 200, *,
                  time: str | None = None, width: int = INDEX_WIDTH) -> DataFrame:
    """Statistics per ``rows`` records; an incomplete last window is not reported.

    With ``time`` a window also has the first and last time of its records and their rates in between.
    """
    times = [] if time is None else [time]
    indexed = dense_index(df.select(position, value, size.alias("bytes"), *times), position, "i",
                          width=width)
    return (indexed.groupBy(F.expr(f"i div {rows}").alias("window_no"))
            .agg(F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"),
                 F.avg(value).alias("avg_value"), F.max(value).alias("max_value"),
                 *(_rates(time, "bytes") if time is not None else []))
            .where(F.col("records") == rows))


def throughput(df: DataFrame, time: str, size: Column, window: str = "1 hour") -> DataFrame:
    """Events and bytes per window, with running totals since the start."""
    per = (df.groupBy(F.window(time, window).alias("w"))
           .agg(F.count(F.lit(1)).alias("events"), F.sum(size).alias("bytes"))
           .select(F.col("w.start").alias("window_start"), "events", "bytes",
                   F.unix_seconds(F.col("w.start").cast("timestamp")).alias("at")))
    return running_sums(per, {"total_events": F.col("events"), "total_bytes": F.col("bytes")},
                        "at").drop("at")


def base_composition(df: DataFrame, key: str, text: str) -> DataFrame:
    """A, C, G and T letters of each record's sequence: its second line, or all of a record of one line."""
    sequence = F.coalesce(F.get(F.split(text, "\n"), F.lit(1)), F.col(text))
    return df.select(key, *base_counts(sequence))
