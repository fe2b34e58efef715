"""Keyed state across micro-batches.

Each function below sees one key's rows of one micro-batch; limit the batch size at the
source (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) to bound it. Rows are put in offset
order first. Batch jobs over full histories use `rillstream.operators` instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.alerts import INITIAL, STATE_NAMES, TRANSITIONS

ALERT_SCHEMA = ("source_address int, event int, event_time timestamp, network_id string, "
                "lat double, lon double, offset long, state string")
_ALERT_COLUMNS = ["event", "event_time", "network_id", "lat", "lon", "offset"]


def anomaly_alerts(stream: DataFrame) -> DataFrame:
    """Alerts of the event state machine, one machine per source address."""
    transitions, names, initial = dict(TRANSITIONS), list(STATE_NAMES), INITIAL
    columns = list(_ALERT_COLUMNS)

    def advance(key: tuple[Any, ...], parts: Iterator[pd.DataFrame],
                state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values("offset")
        current = state.get[0] if state.exists else initial
        bad, seen = [], []
        for at, code in enumerate(rows["event"].tolist()):
            onward = transitions.get((current, code))
            if onward is None:
                bad.append(at)
                seen.append(names[current])
            current = initial if onward is None else onward
        if current == initial:
            state.remove()      # as if the key had never been seen
        else:
            state.update((current,))
        if not bad:
            return
        out = rows.iloc[bad][columns].assign(state=seen)
        out.insert(0, "source_address", key[0])
        yield out

    typed = stream.select("source_address", F.col("event").cast("int").alias("event"),
                          F.col("event_time").cast("timestamp").alias("event_time"),
                          "network_id", "lat", "lon", "offset")
    return typed.groupBy("source_address").applyInPandasWithState(
        advance, ALERT_SCHEMA, "current int", "append", GroupStateTimeout.NoTimeout)


def bookmark_slices(stream: DataFrame, key: str, position: str, of_interest: Column) -> DataFrame:
    """Slices of interest per key, emitted when a later reading closes them."""

    def walk(who: tuple[Any, ...], parts: Iterator[pd.DataFrame],
             state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values("__at")
        pending = state.get[0] if state.exists else None
        found = []
        for at, hit in zip(rows["__at"].tolist(), rows["__hit"].tolist(), strict=True):
            if hit and pending is None:
                pending = at
            elif not hit and pending is not None:
                found.append((who[0], pending, at))
                pending = None
        if pending is None:
            state.remove()
        else:
            state.update((pending,))
        if found:
            yield pd.DataFrame(found, columns=["__key", "start_offset", "end_offset"])

    flags = stream.select(F.col(key).cast("long").alias("__key"),
                          F.col(position).alias("__at"),
                          F.coalesce(of_interest, F.lit(False)).alias("__hit"))
    out = flags.groupBy("__key").applyInPandasWithState(
        walk, "__key long, start_offset long, end_offset long", "pending long", "append",
        GroupStateTimeout.NoTimeout)
    return out.withColumnRenamed("__key", key)
