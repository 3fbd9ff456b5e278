"""Ordered funnels.

An actor's level is the length of the longest prefix of the steps that occurs in
order, every step no later than `window` seconds after the first. Times count in
whole seconds; within one second the steps count as ordered; other events in
between do not matter; one event may serve two equal steps.

Shape of the job. Rows are first folded to one per (actor, second) with the steps
seen in that second as bits, combined map-side: that bounds what any actor can
send at one row per second, however many rows it has. Time is then cut into
slices at least one window long, and a second goes to the slice it lies in and,
near its start, also to the one before, so a chain that starts in a slice is whole
inside it. Chains are followed per (actor, slice): an actor holding a third of
all rows is spread over as many tasks as there are slices, and no group exceeds
the seconds of one slice plus one window. All steps share one shuffle and one
sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.functions.identity import actor_id
from tallystream.operators.filters import (
    clean_steps,
    filter_bots,
    filter_date_range,
    filter_optional,
    filter_steps,
)
from tallystream.schemas import BOT_AGENT_PATTERN

MIN_SLICE_SECONDS = 86_400


def window_seconds(window_hours: int) -> int:
    return max(1, window_hours) * 3600


def _step_bits(steps: Sequence[str]) -> Column:
    bits = [F.when(F.col("event_name") == s, F.lit(1 << i)).otherwise(0) for i, s in enumerate(steps)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def funnel_seconds(events: DataFrame, steps: Sequence[str]) -> DataFrame:
    """(actor_id, sec, bits): which steps an actor did in which second."""
    return (
        events.select(
            actor_id().alias("actor_id"),
            F.unix_timestamp("event_time").alias("sec"),
            _step_bits(steps).alias("bits"),
        )
        .groupBy("actor_id", "sec")
        .agg(F.bit_or("bits").alias("bits"))
    )


def funnel_slices(seconds: DataFrame, window: int) -> DataFrame:
    """(actor_id, slice, sec, bits): every second in each slice whose chains may use it."""
    width = max(window, MIN_SLICE_SECONDS)
    own = F.floor(F.col("sec") / width)
    # A chain of the previous slice starts before this one and lasts one window at most.
    shared = F.col("sec") < own * width + window
    sliced = seconds.select(
        "actor_id", "sec", "bits", own.alias("own"),
        F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))).alias("slice"),
    )
    # Chains belong to the slice they start in, so a second lent to the previous
    # slice does not count as a first step there.
    lent = F.col("slice") != F.col("own")
    bits = F.when(lent, F.col("bits").bitwiseAND(~1)).otherwise(F.col("bits"))
    return sliced.select("actor_id", "slice", "sec", bits.alias("bits")).where("bits <> 0")


def funnel_levels(events: DataFrame, steps: Sequence[str], window: int) -> DataFrame:
    """(actor_id, funnel_step): how far each actor that did any step got; 0 without the first."""
    steps = clean_steps(steps)
    chains = funnel_slices(funnel_seconds(filter_steps(events, steps), steps), window)
    so_far = (
        Window.partitionBy("actor_id", "slice")
        .orderBy("sec")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def did(i: int) -> Column:
        return F.col("bits").bitwiseAND(F.lit(1 << i)) != 0

    # start_i: the latest first-step second whose chain reaches step i at this row.
    chains = chains.withColumn("start_0", F.when(did(0), F.col("sec")))
    for i in range(1, len(steps)):
        latest = F.max(f"start_{i - 1}").over(so_far)
        chains = chains.withColumn(f"latest_{i}", latest).withColumn(
            f"start_{i}",
            F.when(did(i) & (F.col("sec") <= F.col(f"latest_{i}") + window), F.col(f"latest_{i}")),
        )
    reached = F.lit(0)
    for i in range(len(steps)):
        reached = F.when(F.col(f"start_{i}").isNotNull(), i + 1).otherwise(reached)
    return chains.groupBy("actor_id").agg(F.max(reached).alias("funnel_step"))


def step_counts(levels: DataFrame, steps: int) -> DataFrame:
    """One row: how many actors got at least as far as each step."""
    return levels.agg(
        *[
            F.count_if(F.col("funnel_step") >= i).alias(f"step_{i}_users")
            for i in range(1, steps + 1)
        ]
    )


def calculate_funnel(
    events: DataFrame,
    steps: Sequence[str],
    start_date: str | date,
    end_date: str | date,
    app_id: str | None = None,
    environment: str | None = "prod",
    window_hours: int = 24,
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
) -> DataFrame:
    steps = clean_steps(steps)
    rows = filter_date_range(events, start_date, end_date)
    rows = filter_bots(filter_optional(rows, app_id, environment), exclude_bots, bot_pattern)
    return step_counts(funnel_levels(rows, steps, window_seconds(window_hours)), len(steps))
