"""Keyed state machine over network events, its alerts and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import dotted_address, lat_lon
from .ordered import CHUNK_WIDTH, Fold, block_of, keyed_scan

# Fixed values of the machine: states, and per state the event codes that lead on.
# Codes a..g are 1..7. TERMINAL starts over at INITIAL.
INITIAL, W, X, Y, Z = range(5)
STATE_NAMES = ["INITIAL", "W", "X", "Y", "Z"]
TRANSITIONS = {
    (INITIAL, 1): W,
    (INITIAL, 3): X,
    (W, 2): Y,
    (X, 2): Y,
    (X, 4): Z,
    (Y, 5): Z,
    (Z, 7): INITIAL,
}
CODES = range(1, 8)


def _moves() -> Column:
    """For each code, the next state of every state; a bad event resets."""
    return F.array(*[
        F.array(*[F.lit(TRANSITIONS.get((s, c), INITIAL)) for s in range(len(STATE_NAMES))])
        for c in CODES])


def _legal() -> Column:
    """Legal (state, code) pairs, encoded as state * 10 + code."""
    return F.array(*[F.lit(s * 10 + c) for s, c in TRANSITIONS])


def _machine(code: str) -> Fold:
    same = F.array(*[F.lit(s) for s in range(len(STATE_NAMES))])
    reset = F.array(*[F.lit(INITIAL) for _ in STATE_NAMES])
    return Fold(
        initial=lambda: F.lit(INITIAL),
        identity=lambda: same,
        effect=lambda row: F.when(row[code].between(1, 7),
                                  F.get(_moves(), row[code].cast("int") - 1)).otherwise(reset),
        compose=lambda f, g: F.transform(f, lambda s: F.get(g, s)),
        apply=lambda f, s: F.get(f, s),
        advance=lambda row, s: F.coalesce(
            F.get(F.get(_moves(), row[code].cast("int") - 1), s), F.lit(INITIAL)))


def anomaly_alerts(events: DataFrame, key: str = "source_address", code: str = "event",
                   position: str = "offset", *, width: int = CHUNK_WIDTH) -> DataFrame:
    """Events that the machine of their key does not accept, with the state before them.

    After a bad or final event the machine is back at INITIAL; the bad
    event itself is not tried again.
    """
    walked = keyed_scan(events, [key], position, _machine(code), width=width)
    names = F.array(*[F.lit(n) for n in STATE_NAMES])
    step = F.col("before") * 10 + F.col(code).cast("int")
    return (walked.where(~F.coalesce(F.array_contains(_legal(), step), F.lit(False)))
            .withColumn("state", F.get(names, F.col("before")))
            .drop("before", "after"))


def alert_summary(alerts: DataFrame, size: str = "30 seconds") -> DataFrame:
    """Alerts per network and window: count, first and last event time, first location.

    Every part is mergeable, so a network with most of the alerts is
    pre-aggregated where the rows are.
    """
    return (
        alerts.groupBy("network_id", F.window("event_time", size).alias("w"))
        .agg(F.count(F.lit(1)).alias("cnt"),
             F.min("event_time").alias("min_time"),
             F.max("event_time").alias("max_time"),
             F.min_by(F.struct("lat", "lon"), "offset").alias("at"))
        .select("network_id", F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"), "cnt", "min_time", "max_time",
                lat_lon(F.col("at.lat"), F.col("at.lon")).alias("location")))


def alert_addresses(alerts: DataFrame, size: str = "30 seconds") -> DataFrame:
    """The addresses behind each summary, duplicates kept as a multiplicity."""
    return (
        alerts.groupBy("network_id", F.window("event_time", size).alias("w"), "source_address")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("network_id", F.col("w.start").alias("window_start"),
                dotted_address(F.col("source_address")).alias("ip_address"), "n"))


def alert_documents(alerts: DataFrame, size: str = "30 seconds", *,
                    page_rows: int = 1 << 16) -> DataFrame:
    """Address lists per network and window in arrival order, in pages.

    A page covers ``page_rows`` log offsets, so no list outgrows a row;
    the pages of a window, in order, are its whole list.
    """
    pages = alerts.groupBy(
        "network_id", F.window("event_time", size).alias("w"),
        block_of("offset", page_rows).alias("page"),
    ).agg(F.sort_array(F.collect_list(F.struct(
        "offset", dotted_address(F.col("source_address")).alias("ip")))).alias("hits"))
    return pages.select("network_id", F.col("w.start").alias("window_start"), "page",
                        F.col("hits.ip").alias("ip_addresses"))


def latest_documents(summaries: DataFrame) -> DataFrame:
    """Upsert by network id: only the newest window of each network remains."""
    rest = [c for c in summaries.columns if c not in ("network_id", "window_end")]
    return (summaries.groupBy("network_id")
            .agg(F.max(F.struct("window_end", *rest)).alias("d"))
            .select("network_id", "d.*").select(*summaries.columns))


def alerts_by_location(summaries: DataFrame) -> DataFrame:
    """Alert total per location, as drawn on a map."""
    return summaries.groupBy("location").agg(F.sum("cnt").alias("alerts"))
