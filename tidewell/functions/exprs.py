"""Column expressions shared by all layers: identities, instants, languages, lateness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COORDINATES = ["source", "log_topic", "log_partition", "log_offset"]
#: Exclusive end of valid times: the year 10000, in microseconds.
TIME_END_US = 253_402_300_800_000_000
WINDOW = "5 minutes"
#: Observations beyond these count as very late, or as dated in the future; both strict.
VERY_LATE_SECONDS, FUTURE_SECONDS = 600, 300
VERY_LATE = f"{VERY_LATE_SECONDS} seconds"
ARRIVAL_FLAGS = ["is_late", "is_very_late", "is_future_dated", "is_ingestion_unknown"]
EVENT_TYPES = {"create": "content_created", "update": "content_updated", "delete": "content_deleted"}
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def now() -> Column:
    return F.expr("cast(to_utc_timestamp(current_timestamp(), current_timezone()) as timestamp_ntz)")


def instant(micros: str) -> Column:
    """Epoch microseconds as a UTC instant."""
    return F.expr(f"timestampadd(MICROSECOND, {micros}, {EPOCH})")


def _seconds(start: str, end: str) -> str:
    """Decimal seconds between instants; timestampdiff would go through the session's zone and its gaps."""
    return f"cast(cast({end} - {start} as interval second) as decimal(18, 6))"


def micros(when: str) -> Column:
    """A UTC instant as epoch microseconds."""
    return F.expr(f"cast({_seconds(EPOCH, when)} * 1000000 as bigint)")


def blank(c: Column) -> Column:
    return c.isNull() | (F.length(F.trim(c)) == 0)


def physical_event_id() -> Column:
    """Readable identity of one log occurrence."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in COORDINATES])


def occurrence_id() -> Column:
    """Hashed identity of one log occurrence; raw tables have no null coordinates."""
    return F.sha2(F.to_json(F.struct(*COORDINATES)), 256)


def entity_uri(actor: Column, collection: Column, key: Column) -> Column:
    return F.concat(F.lit("at://"), actor, F.lit("/"), collection, F.lit("/"), key)


def event_type(operation: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair])[operation]


def languages(supplied: Column) -> Column:
    """Trimmed, lower-cased, without blanks; the first of equal codes stays in its place."""
    tidy = F.transform(F.filter(supplied, lambda x: ~blank(x)), lambda x: F.lower(F.trim(x)))
    return F.array_distinct(F.coalesce(tidy, F.array().cast("array<string>")))


def delay_seconds(event: str = "event_time", ingested: str = "ingested_at") -> Column:
    return F.expr(_seconds(event, ingested)).cast("double")


def frontier(latest: Column, lag: str = VERY_LATE) -> Column:
    """The latest event time less the allowed lateness, a phrase such as "10 minutes" that isn't negative."""
    count, unit = lag.split()
    if int(count) < 0:
        raise ValueError("allowed lateness can't be negative")
    return latest - F.expr(f"interval '{int(count)}' {unit.rstrip('s')}")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it doesn't or is unknown."""
    return F.when(condition, 1).otherwise(0)


def arrival_flags(event: str = "event_time", ingested: str = "ingested_at", end: str = "window_end") -> dict[str, Column]:
    """How an arrival looks against its window: observations, never a reason to drop it."""
    delay = delay_seconds(event, ingested)
    return {
        "is_late": flag(F.col(ingested) >= F.col(end)),
        "is_very_late": flag(delay > VERY_LATE_SECONDS),
        "is_future_dated": flag(delay < -FUTURE_SECONDS),
        "is_ingestion_unknown": flag(F.col(ingested).isNull()),
    }
