"""Row filters of the query tools."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.times import parse_strict_offset
from tallystream.schemas import BOT_AGENT_PATTERN


def filter_optional(
    events: DataFrame,
    app_id: str | None = None,
    environment: str | None = "prod",
    event_name: str | None = None,
) -> DataFrame:
    """Equality filters; one that is None or '' does not apply."""
    wanted = {"app_id": app_id, "environment": environment, "event_name": event_name}
    for name, value in wanted.items():
        if value:
            events = events.where(F.col(name) == value)
    return events


def is_bot(agent: Column, pattern: str = BOT_AGENT_PATTERN) -> Column:
    return F.lower(F.coalesce(agent, F.lit(""))).rlike(pattern.lower())


def filter_bots(events: DataFrame, exclude_bots: bool = True, pattern: str = BOT_AGENT_PATTERN) -> DataFrame:
    """Drop rows whose agent looks like a bot; a missing agent stays."""
    return events.where(~is_bot(F.col("ingest_user_agent"), pattern)) if exclude_bots else events


def filter_date_range(events: DataFrame, start_date: str | date, end_date: str | date) -> DataFrame:
    """Both days included. event_date is a partition column, so other days are not read."""
    days = F.col("event_date").between(
        F.lit(str(start_date)).cast("date"), F.lit(str(end_date)).cast("date")
    )
    return events.where(days & F.col("event_time").isNotNull())


def with_event_time(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_time").isNotNull())


def filter_received_range(raw: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows received in [start, end) whose event_date lies in [day of start, day of end].

    event_date is text in the raw layer; comparing it with text keeps the
    comparison a partition filter. Late events of older days fall outside.
    """
    received = parse_strict_offset(F.col("received_at"))
    return (
        raw.where(F.col("event_date").between(f"{start:%Y-%m-%d}", f"{end:%Y-%m-%d}"))
        .withColumn("received_at_ts", received)
        .where((F.col("received_at_ts") >= instant_lit(start)) & (F.col("received_at_ts") < instant_lit(end)))
    )


def instant_lit(moment: datetime) -> Column:
    """A naive datetime read as UTC, whatever the driver's own zone."""
    return F.lit(moment.strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z").cast("timestamp")


def clean_steps(steps: Sequence[str]) -> list[str]:
    """Trimmed, blanks removed; 2 to 10 must remain."""
    kept = [s.strip() for s in steps if s.strip()]
    if not 2 <= len(kept) <= 10:
        raise ValueError(f"a funnel has 2 to 10 steps, not {len(kept)}")
    return kept


def filter_steps(events: DataFrame, steps: Sequence[str]) -> DataFrame:
    return events.where(F.col("event_name").isin(sorted(set(clean_steps(steps)))))


def checked_limit(limit: int, maximum: int | None) -> int:
    """At least 1 and at most `maximum`; None is no maximum."""
    return max(1, limit if maximum is None else min(limit, maximum))
