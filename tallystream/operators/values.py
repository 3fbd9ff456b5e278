"""Daily values of events: exact sums of a number in their JSON.

Sums are decimals, so they do not depend on the order of the rows, and sums of any set of rows can be
merged with those of any other: a late row adds to its day without the day's other rows.

Cases: only JSON numbers are values; text, true, null, lists, objects and a member that is absent are
none, and neither is a number beyond `VALUE`, which counts as unreadable; digits beyond its scale are rounded half up;
rows without an event date do not count; a group without values has NULL as sum, smallest and largest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.functions.json_text import kind
from tallystream.operators.filters import filter_bots
from tallystream.schemas import BOT_AGENT_PATTERN, JSON_COLUMNS

VALUE = "decimal(28,10)"
TOTAL = "decimal(38,10)"
NUMBERS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
DIMENSIONS = ["event_date", "app_id", "environment", "event_name"]
VALUES = (
    "event_date date, app_id string, environment string, event_name string, events bigint, `values` bigint, "
    f"unreadable bigint, total {TOTAL}, smallest {VALUE}, largest {VALUE}"
)


def daily_values(
    events: DataFrame,
    path: str,
    json_column: str = "event_params_json",
    exclude_bots: bool = True,
    bot_pattern: str = BOT_AGENT_PATTERN,
) -> DataFrame:
    """Values at `path` of serving rows by day, app, environment and event name; columns as in VALUES."""
    if json_column not in JSON_COLUMNS:
        raise ValueError(f"{json_column!r} holds no JSON; choose from {', '.join(JSON_COLUMNS)}")
    rows = filter_bots(events.where("event_date is not null"), exclude_bots, bot_pattern)
    parsed = F.try_parse_json(F.col(json_column))
    number = kind(parsed, path).rlike(NUMBERS)
    value = F.when(number, F.try_variant_get(parsed, path, VALUE))
    rows = rows.select(*DIMENSIONS, value.alias("value"), F.coalesce(number, F.lit(False)).alias("number"))
    return rows.groupBy(*DIMENSIONS).agg(
        F.count("*").alias("events"),
        F.count("value").alias("values"),
        F.count_if(F.col("number") & F.col("value").isNull()).alias("unreadable"),
        F.sum("value").cast(TOTAL).alias("total"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
    )


def merge_values(values: DataFrame) -> DataFrame:
    return values.groupBy(*DIMENSIONS).agg(
        *[F.sum(c).alias(c) for c in ("events", "values", "unreadable")],
        F.sum("total").cast(TOTAL).alias("total"), F.min("smallest").alias("smallest"), F.max("largest").alias("largest"))
