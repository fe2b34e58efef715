"""Registered queries over the given tables."""

from . import changes, chat, eventlog, live, metrics, network, rides, roundtrips, schemas, sensors
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "chat", "eventlog", "live", "metrics", "network", "rides",
           "roundtrips", "schemas", "sensors"]
