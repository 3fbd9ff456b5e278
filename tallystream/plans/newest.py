"""Newest events of the serving table, day by day from the last one back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystream.operators.filters import checked_limit
from tallystream.operators.metrics import sample_events
from tallystream.schemas import MAX_SAMPLE_ROWS
from tallystream.sources.stores import day_of, scan_serving, serving_folders


def newest_events(spark: SparkSession, root: str, limit: int = 20, max_rows: int | None = MAX_SAMPLE_ROWS, **filters) -> DataFrame:
    """`sample_events` of the stored table, reading only as many of its last days as hold the rows asked for.

    An event of a later day is newer than any of an earlier one, so days that are not needed to fill the sample
    cannot add to it. The last day is tried first, then two days before it, then four, and so on: a filter that
    matches nothing costs the table once, in few jobs, each of which stops when it has found enough.
    """
    wanted = checked_limit(limit, max_rows)
    days = sorted({day_of(n) for n in serving_folders(spark, root)}, reverse=True)
    first, found, step = 0, 0, 1
    while first < len(days) and found < wanted:
        last = min(first + step, len(days))
        part = scan_serving(spark, root, days[last - 1], days[first])
        found += sample_events(part, limit=wanted, max_rows=None, newest_first=False, **filters).count()
        first, step = last, step * 2
    oldest = days[first - 1] if first else None
    return sample_events(scan_serving(spark, root, oldest), limit=limit, max_rows=max_rows, **filters)
