from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallystream.operators import filters, funnel

START = datetime(2024, 1, 1, tzinfo=UTC)


def walk(events, steps, window):
    """Level of one actor, by going through its events in time order."""
    hits = sorted(
        (second, i) for second, name in events for i, step in enumerate(steps) if name == step
    )
    starts = [None] * len(steps)
    for second, i in hits:
        if i == 0:
            starts[0] = second
        elif starts[i - 1] is not None and second <= starts[i - 1] + window:
            starts[i] = starts[i - 1]
            if i == len(steps) - 1:
                return len(steps)
    return max((i + 1 for i, s in enumerate(starts) if s is not None), default=0)


def frame(spark, events):
    rows = [
        (actor, name, START + timedelta(seconds=second, milliseconds=random.randrange(1000)))
        for actor, second, name in events
    ]
    return spark.createDataFrame(rows, "user_pseudo_id string, event_name string, event_time timestamp").withColumn(
        "user_id", F.lit("")
    )


@pytest.mark.parametrize(
    ("steps", "window"),
    [
        (["a", "b", "c"], 60),
        (["a", "b", "c"], 3600),
        (["a", "b", "a"], 7200),
        (["a", "a"], 600),
        (["c", "b", "a", "d"], 86_400),
        (["a", "b", "c", "d"], 3 * 86_400),
    ],
)
def test_levels_equal_a_walk_through_the_events(spark, steps, window):
    random.seed(len(steps) * window)
    events = []
    for n in range(60):
        span = random.choice([120, 5_000, 90_000, 500_000])
        for _ in range(random.randrange(1, 25)):
            events.append((f"u{n}", random.randrange(span), random.choice("abcdx")))
    # One actor with far more rows than seconds, crossing midnights.
    events += [("", 86_000 + random.randrange(90_000), random.choice("abcx")) for _ in range(3_000)]
    got = {r[0]: r[1] for r in funnel.funnel_levels(frame(spark, events), steps, window).collect()}
    want = {}
    for actor in {e[0] for e in events}:
        mine = [(s, n) for a, s, n in events if a == actor]
        if any(n in steps for _, n in mine):
            want[actor] = walk(mine, steps, window)
    assert got == want


def test_chain_across_a_slice_border(spark):
    day = 86_400
    events = [("u", day - 5, "a"), ("u", day + 5, "b"), ("u", 2 * day - 6, "c"),
              ("v", day - 5, "a"), ("v", day + 5, "b"), ("v", 2 * day - 4, "c")]
    got = {r[0]: r[1] for r in funnel.funnel_levels(frame(spark, events), ["a", "b", "c"], day).collect()}
    assert got == {"u": 3, "v": 2}


def test_no_rows_gives_zeros(spark):
    levels = funnel.funnel_levels(frame(spark, [("u", 1, "x")]), ["a", "b"], 60)
    assert tuple(funnel.step_counts(levels, 2).first()) == (0, 0)


def test_steps_and_limits():
    assert filters.clean_steps([" a ", "", "b"]) == ["a", "b"]
    for steps in (["a"], ["a", " "], [str(i) for i in range(11)]):
        with pytest.raises(ValueError):
            filters.clean_steps(steps)
    assert [filters.checked_limit(n, 100) for n in (0, 50, 500)] == [1, 50, 100]
    assert funnel.window_seconds(24) == 86_400 and funnel.window_seconds(0) == 3600


def test_one_shuffle_and_one_sort_follow_all_chains(spark):
    plan = funnel.funnel_levels(frame(spark, [("u", 1, "a")]), ["a", "b", "c", "d"], 60)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(actor_id") == 3  # fold, chains, result
    assert text.count("Window [") == 3 and text.count("Sort [") == 1
