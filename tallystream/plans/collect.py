"""Collector: request batches in, stream messages and rejects out.

Every step works on single rows or on equality joins with small tables, so the
same functions take a table or a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.operators.enrich import to_messages
from tallystream.operators.flatten import flatten_raw
from tallystream.operators.geo import Networks
from tallystream.operators.requests import accepted_batches, judge_requests


def collect_messages(
    requests: DataFrame,
    keys: DataFrame,
    ranges: DataFrame | Networks | None = None,
    salt: str = "",
    prefix: str = "events",
    store_raw_ip: bool = False,
    **limits: int,
) -> DataFrame:
    judged = judge_requests(requests, keys, **limits)
    return to_messages(accepted_batches(judged), ranges, salt, prefix, store_raw_ip, requests)


def messages_to_raw(messages: DataFrame, stream: str = "EVENTS") -> DataFrame:
    """Raw rows of collector messages that have not been through a log yet.

    Without a log there is no log position; the position inside the request
    stands in for it.
    """
    staged = messages.withColumns(
        {"stream": F.lit(stream), "sequence": F.col("position").cast("string")}
    )
    return flatten_raw(staged)
