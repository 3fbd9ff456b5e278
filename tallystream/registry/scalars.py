"""Small functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.functions import json_text
from tallystream.registry import register
from tallystream.registry.fixture import MESSAGES_CTE, RAW_CTE, messages, raw_rows


@register(
    "json_keys",
    f"""with {RAW_CTE}, t as (select event_params_json as j from raw union all select geo_json from raw
      union all select user_properties_json from raw)
    select key, count(*) as n from (select unnest(json_keys(j)) as key from t where coalesce(j, '') <> '') k group by key""",
)
def _(spark, sf):
    """Keys whose value is null count; blank and NULL texts have none."""
    rows = raw_rows(spark, sf)
    texts = rows.select(
        F.explode(F.array("event_params_json", "geo_json", "user_properties_json")).alias("j")
    )
    keys = texts.select(F.explode(json_text.json_keys(F.col("j"))).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


@register(
    "uint_or_zero",
    f"with {MESSAGES_CTE} select sequence, greatest(coalesce(try_cast(sequence as bigint), 0), 0) as number from messages",
)
def _(spark, sf):
    return messages(spark, sf).select("sequence", json_text.uint_or_zero(F.col("sequence")).alias("number"))
