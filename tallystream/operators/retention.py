"""Retention: which share of the actors first seen on a day come back n days later.

Every actor has its active days as bits, `DAYS` days to a row. Bits of any set of rows can be
merged with those of any other by a bitwise or, so a day's rows, late ones too, are added without the
rows of other days. The retention of all n comes from one pass over the bits: an actor's first
bit is its cohort, the distance of every other bit to it an n. No self-join.

Bits are combined map-side: an actor costs one row per task and block of days, however many rows it has.

Cases: rows without an event time or an actor do not count; copies and repeated events of a day count
once; an empty table has no cohorts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.identity import actor_id
from tallystream.operators.filters import filter_bots, filter_optional
from tallystream.schemas import BOT_AGENT_PATTERN

DAYS = 63  # bits of a long without its sign
BITS = "app_id string, environment string, actor_id string, block bigint, days bigint"


def active_days(events: DataFrame, exclude_bots: bool = True, bot_pattern: str = BOT_AGENT_PATTERN) -> DataFrame:
    """Active days of the actors in serving rows; columns as in BITS. Bit i of a block is day
    block * DAYS + i since 1970-01-01."""
    day = F.unix_date("event_date")
    rows = filter_bots(events.where("event_date is not null"), exclude_bots, bot_pattern).select(
        "app_id", "environment", actor_id().alias("actor_id"), F.floor(day / DAYS).alias("block"), F.pmod(day, F.lit(DAYS)).alias("bit"))
    return rows.where("actor_id is not null").groupBy("app_id", "environment", "actor_id", "block").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("days"))


def merge_days(bits: DataFrame) -> DataFrame:
    return bits.groupBy("app_id", "environment", "actor_id", "block").agg(F.bit_or("days").alias("days"))


def returns(bits: DataFrame, app_id: str | None = None, environment: str | None = "prod") -> DataFrame:
    """cohort_date, day_n and actors: how many of a cohort were active n days after their first day.
    Day 0 is the cohort itself; an n that nobody came back on has no row."""
    own = filter_optional(bits, app_id, environment)
    blocks = own.groupBy("actor_id", "block").agg(F.bit_or("days").alias("days"))
    # One array per actor, of a row for every two months.
    actors = blocks.groupBy("actor_id").agg(F.collect_list(F.struct("block", "days")).alias("blocks"))
    bit_set = lambda days, i: F.call_function("getbit", days, i) == 1

    def days_of(b: Column) -> Column:
        bits = F.filter(F.sequence(F.lit(0), F.lit(DAYS - 1)), lambda i: bit_set(b["days"], i))
        return F.transform(bits, lambda i: b["block"] * DAYS + i)

    days = actors.select(F.flatten(F.transform("blocks", days_of)).alias("days"))
    days = days.select(F.array_min("days").alias("first"), F.explode("days").alias("day"))
    # A cohort's count for each n meets map-side: at most one row per task, cohort and n.
    counts = days.groupBy("first", (F.col("day") - F.col("first")).alias("day_n")).agg(F.count("*").alias("actors"))
    return counts.select(F.date_from_unix_date(F.col("first").cast("int")).alias("cohort_date"), F.col("day_n").cast("int").alias("day_n"), "actors")


def retention_table(
    bits: DataFrame,
    days: Sequence[int] = (1, 7, 30),
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    app_id: str | None = None,
    environment: str | None = "prod",
) -> DataFrame:
    """Per cohort date, from start to end date, both included: cohort_size and a column day_<n> for each n, 0 where nobody came back."""
    if any(n < 0 for n in days):
        raise ValueError("days after the first are not negative")
    found = returns(bits, app_id, environment)
    if start_date is not None:
        found = found.where(F.col("cohort_date") >= F.lit(str(start_date)).cast("date"))
    if end_date is not None:
        found = found.where(F.col("cohort_date") <= F.lit(str(end_date)).cast("date"))
    on = lambda n: F.coalesce(F.sum(F.when(F.col("day_n") == n, F.col("actors"))), F.lit(0))
    return found.groupBy("cohort_date").agg(on(0).alias("cohort_size"), *[on(n).alias(f"day_{n}") for n in days])


def retention_day_n(
    events: DataFrame,
    days: Sequence[int] = (1, 7, 30),
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    app_id: str | None = None,
    environment: str | None = "prod",
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
) -> DataFrame:
    """The retention table of serving rows in one go. Cohorts are those of the rows given: a first day
    before the rows begin is not known."""
    bits = active_days(events, exclude_bots, bot_pattern)
    return retention_table(bits, days, start_date, end_date, app_id, environment)
