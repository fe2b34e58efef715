"""Event-log and stream analytics as DataFrame jobs."""

from .session import build_session

__all__ = ["build_session"]
