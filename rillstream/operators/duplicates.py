"""Duplicate reports over marked runs of an integer stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import INDEX_WIDTH, running_sum

# Fixed marker values of the event format.
START_MARKER = -1
END_MARKER = -9999


def duplicates_report(events: DataFrame, value: str, position: str, *, segment: str | None = None,
                      width: int = INDEX_WIDTH) -> DataFrame:
    """Every occurrence of a value after its first one inside a run.

    Each start or end marker begins a new run. Only the first position per
    (run, value) is aggregated; it is then taken out again by the unique
    position, so a value that makes up much of the stream is no hot spot.
    Positions that are unique only within a segment need the name of the ``segment`` column (integers
    from 0); the order of arrival is then by position, and by segment where positions are equal.
    """
    places = [position] if segment is None else [segment, position]
    at = F.col(position)
    if segment is not None:
        at = at * events.agg((F.max(segment) + 1).cast("long")).scalar() + F.col(segment)
    marks = F.col(value).isin(START_MARKER, END_MARKER).cast("int")
    runs = running_sum(events.select(value, *places, at.alias("__at")), marks, "__at", "run", width=width)
    firsts = runs.groupBy("run", value).agg(F.min("__at").alias("__at")).select("__at")
    return runs.join(firsts, "__at", "left_anti").select("run", value, *places)


def distinct_by_identity(df: DataFrame, identity: str, arrival: str) -> DataFrame:
    """Keep the first-arriving row of each identity; other fields do not matter."""
    rest = [c for c in df.columns if c not in (identity, arrival)]
    return (df.groupBy(identity)
            .agg(F.min(F.struct(arrival, *rest)).alias("r"))
            .select(identity, f"r.{arrival}", *[f"r.{c}" for c in rest]))
