"""The aggregate query tools, over the serving table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.functions.identity import actor_id
from tallystream.functions.json_text import json_keys
from tallystream.operators.filters import (
    checked_limit,
    filter_bots,
    filter_date_range,
    filter_optional,
    with_event_time,
)
from tallystream.schemas import BOT_AGENT_PATTERN, JSON_COLUMNS, MAX_QUERY_ROWS, MAX_SAMPLE_ROWS, SAMPLE_COLUMNS


def table_overview(events: DataFrame, exclude_bots: bool = True, bot_pattern: str = BOT_AGENT_PATTERN) -> DataFrame:
    """One row: events, distinct apps, names and actors, first and last time.

    Rows are first folded to one per (app, name, actor), combined map-side, so
    the three exact distinct counts that follow work on that much smaller set.
    """
    rows = filter_bots(with_event_time(events), exclude_bots, bot_pattern)
    folded = rows.groupBy("app_id", "event_name", actor_id().alias("actor_id")).agg(
        F.count("*").alias("n"), F.min("event_time").alias("lo"), F.max("event_time").alias("hi")
    )
    return folded.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.count_distinct("app_id").alias("apps"),
        F.count_distinct("event_name").alias("event_names"),
        F.count_distinct("actor_id").alias("actors"),
        F.min("lo").alias("first_event_time"),
        F.max("hi").alias("last_event_time"),
    )


def event_catalogue(
    events: DataFrame,
    app_id: str | None = None,
    environment: str | None = "prod",
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
) -> DataFrame:
    """Per event name: events, distinct actors, first and last time.

    Exact distinct actors shuffle by (event_name, actor), so a name that holds a
    third of the rows is spread over all tasks.
    """
    rows = filter_bots(filter_optional(with_event_time(events), app_id, environment), exclude_bots, bot_pattern)
    return rows.groupBy("event_name").agg(
        F.count("*").alias("events"),
        F.count_distinct(actor_id()).alias("actors"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
    )


def list_event_names(
    events: DataFrame,
    app_id: str | None = None,
    environment: str | None = "prod",
    limit: int = 100,
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
    max_rows: int | None = MAX_QUERY_ROWS,
) -> DataFrame:
    """Most frequent names first; equal counts in name order (our tie rule). max_rows: the
    most that `limit` may ask for, None for no such bound."""
    return (
        event_catalogue(events, app_id, environment, exclude_bots, bot_pattern)
        .orderBy(F.desc("events"), "event_name")
        .limit(checked_limit(limit, max_rows))
    )


def json_key_counts(
    events: DataFrame,
    json_column: str = "event_params_json",
    event_name: str | None = None,
    app_id: str | None = None,
    environment: str | None = "prod",
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
) -> DataFrame:
    """Rows that have each top-level key of a JSON column."""
    if json_column not in JSON_COLUMNS:
        raise ValueError(f"{json_column!r} holds no JSON; choose from {', '.join(JSON_COLUMNS)}")
    rows = filter_bots(
        filter_optional(with_event_time(events), app_id, environment, event_name), exclude_bots, bot_pattern
    )
    keys = rows.select(F.explode(json_keys(F.col(json_column))).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("rows_with_key"))


def discover_json_keys(events: DataFrame, json_column: str = "event_params_json", limit: int = 100,
                       max_rows: int | None = MAX_QUERY_ROWS, **filters) -> DataFrame:
    """Most frequent keys first. A column that holds no JSON raises ValueError here; a tool that
    has to answer with an error row turns it into one."""
    return (
        json_key_counts(events, json_column, **filters)
        .orderBy(F.desc("rows_with_key"), "key")
        .limit(checked_limit(limit, max_rows))
    )


def sample_columns(events: DataFrame) -> DataFrame:
    return events.withColumn("actor_id", actor_id()).select(*SAMPLE_COLUMNS)


def sample_events(
    events: DataFrame,
    event_name: str | None = None,
    app_id: str | None = None,
    environment: str | None = "prod",
    limit: int = 20,
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
    max_rows: int | None = MAX_SAMPLE_ROWS,
    newest_first: bool = True,
) -> DataFrame:
    """Newest rows first; equal times in (event_id, sequence) order (our tie rule). Not newest_first:
    any rows, as they are found."""
    rows = filter_bots(
        filter_optional(with_event_time(events), app_id, environment, event_name), exclude_bots, bot_pattern
    )
    if not newest_first:
        return sample_columns(rows.limit(checked_limit(limit, max_rows)))
    # Top-k first, on the stored columns, so that display columns are computed for k rows only.
    newest = rows.orderBy(F.desc("event_time"), "event_id", "nats_sequence").limit(
        checked_limit(limit, max_rows)
    )
    return sample_columns(newest)


def daily_active_users(
    events: DataFrame,
    start_date: str | date,
    end_date: str | date,
    app_id: str | None = None,
    environment: str | None = "prod",
    active_event_name: str | None = None,
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
    max_rows: int | None = None,
) -> DataFrame:
    """Distinct actors per day, days in order; all days unless max_rows says how many."""
    rows = filter_date_range(events, start_date, end_date)
    rows = filter_bots(filter_optional(rows, app_id, environment, active_event_name), exclude_bots, bot_pattern)
    days = rows.groupBy("event_date").agg(F.count_distinct(actor_id()).alias("dau")).orderBy("event_date")
    return days if max_rows is None else days.limit(max_rows)
