"""The window and lateness policy for single events, as a specification that needs no Spark."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from .exprs import FUTURE_SECONDS, VERY_LATE_SECONDS

WIDTH = timedelta(minutes=5)
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def utc(when: datetime) -> datetime:
    if when.utcoffset() is None:
        raise ValueError("a time needs an explicit UTC offset")
    return when.astimezone(UTC)


def window_of(event: datetime) -> tuple[datetime, datetime]:
    """The half-open UTC-aligned window that holds the event."""
    start = _EPOCH + (utc(event) - _EPOCH) // WIDTH * WIDTH
    return start, start + WIDTH


def arrival(event: datetime, ingested: datetime | None) -> dict:
    """The window, the delay and the observations; unknown ingestion is neither late nor early."""
    start, end = window_of(event)
    delay = None if ingested is None else (utc(ingested) - utc(event)).total_seconds()
    known = delay is not None
    return {
        "window_start": start,
        "window_end": end,
        "delay_seconds": delay,
        "is_late": known and utc(ingested) >= end,
        "is_very_late": known and delay > VERY_LATE_SECONDS,
        "is_future_dated": known and delay < -FUTURE_SECONDS,
        "is_ingestion_unknown": not known,
    }


def frontier(latest: datetime, lag: timedelta) -> datetime:
    """The watermark: no event before it is expected any more."""
    if lag < timedelta(0):
        raise ValueError("allowed lateness can't be negative")
    return utc(latest) - lag
