"""Raw layer -> serving table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallystream.operators.dedupe import distinct_rows
from tallystream.plans import serving
from tallystream.plans.landing import land_raw
from tallystream.registry import register
from tallystream.registry.fixture import (
    RAW_CTE,
    SERVING_CTE,
    raw_rows,
    raw_store,
    serving_store,
    ts_text,
)
from tallystream.schemas import RAW_COLUMNS, SERVING_COLUMNS
from tallystream.session import scratch_path
from tallystream.sources import stores
from tallystream.streaming.landing import load_stream

HOUR = datetime(2024, 1, 10, 13)
PARTITION = """coalesce(try_cast(event_timestamp as timestamp), try_cast(received_at as timestamp))"""
PLACED = f"""{RAW_CTE}, placed as (
  select *, strftime({PARTITION}, '%Y-%m-%d') as event_date, strftime({PARTITION}, '%H') as hour from raw)"""
SERVING_TEXT = ", ".join(
    ts_text(c) if c in ("event_time", "received_time")
    else f"strftime({c}, '%Y-%m-%d') as {c}" if c == "event_date" else c
    for c in SERVING_COLUMNS
)
RAW_TEXT = ", ".join(RAW_COLUMNS)
SERVING_ALL = f"with {SERVING_CTE} select {SERVING_TEXT} from serving"


@register("scan_raw_hour", f"with {PLACED} select {RAW_TEXT}, event_date, hour from placed where event_date = '2024-01-10' and hour = '13'")
def _(spark, sf):
    return stores.scan_raw_hour(spark, raw_store(spark, sf), HOUR)


@register(
    "hour_file_count",
    f"with {PLACED} select event_date, hour, count(distinct app_id) as files, count(*) as rows from placed group by 1, 2",
)
def _(spark, sf):
    """Files per hour, all hours; a small hour lands as one file per app."""
    return stores.hour_file_count(stores.scan_raw(spark, raw_store(spark, sf)))


@register("raw_count", f"with {RAW_CTE} select count(*) as rows from raw")
def _(spark, sf):
    return stores.raw_count(stores.scan_raw(spark, raw_store(spark, sf)))


@register("scan_external", f"with {PLACED} select {RAW_TEXT}, event_date, hour from placed")
def _(spark, sf):
    return stores.scan_raw(spark, raw_store(spark, sf))


@register("distinct_rows", f"with {RAW_CTE} select distinct {RAW_TEXT} from raw")
def _(spark, sf):
    return distinct_rows(raw_rows(spark, sf))


@register(
    "drop_unparseable_time",
    f"with {RAW_CTE} select app_id, event_id, event_timestamp from raw where try_cast(event_timestamp as timestamp) is not null",
)
def _(spark, sf):
    typed = serving.typed_times(raw_rows(spark, sf))
    return serving.drop_unparseable_time(typed).select("app_id", "event_id", "event_timestamp")


@register("serving_projection", SERVING_ALL)
def _(spark, sf):
    return serving.serving_rows(raw_rows(spark, sf))


@register("load_serving", SERVING_ALL)
def _(spark, sf):
    root = scratch_path(spark, "load_serving")
    serving.load_serving(stores.scan_raw(spark, raw_store(spark, sf)), root)
    return stores.scan_serving(spark, root)


@register(
    "load_hour",
    f"with {SERVING_CTE} select {SERVING_TEXT} from serving where date_trunc('hour', event_time) = timestamp '2024-01-10 13:00:00'",
)
def _(spark, sf):
    """The same hour loaded twice, and an hour without files: rows are there once."""
    root, raw = scratch_path(spark, "load_hour"), raw_store(spark, sf)
    serving.load_hour(spark, raw, root, HOUR)
    serving.load_hour(spark, raw, root, HOUR)
    serving.load_hour(spark, raw, root, datetime(2030, 1, 1))
    return stores.scan_serving(spark, root)


@register(
    "reload_corrected_hour",
    f"""with {SERVING_CTE} select {SERVING_TEXT} from serving where date_trunc('hour', event_time) = timestamp '2024-01-10 13:00:00'
    and cast(substr(event_id, 2) as bigint) % 5 <> 0""",
)
def _(spark, sf):
    """An hour loaded, corrected and loaded again: it first holds rows that carry another day,
    in a folder of their own, then those are gone from the raw hour."""
    scratch = scratch_path(spark, "reload_corrected_hour")
    wrong = F.col("event_id").substr(F.lit(2), F.lit(20)).cast("bigint") % 5 == 0
    rows = stores.scan_raw_hour(spark, raw_store(spark, sf), HOUR).drop("event_date", "hour")
    epoch = F.when(wrong, "1704067200").otherwise(F.col("event_timestamp"))
    for name, raw in (("first", rows.withColumn("event_timestamp", epoch)), ("corrected", rows.where(~wrong))):
        land_raw(raw, f"{scratch}/{name}")
        serving.load_hour(spark, f"{scratch}/{name}", f"{scratch}/table", HOUR)
    return stores.scan_serving(spark, f"{scratch}/table")


@register("load_stream", SERVING_ALL)
def _(spark, sf):
    root = scratch_path(spark, "load_stream")
    query = load_stream(spark, raw_store(spark, sf), f"{root}/table", f"{root}/checkpoint")
    query.awaitTermination()
    return stores.scan_serving(spark, f"{root}/table")


@register("compact_serving", SERVING_ALL)
def _(spark, sf):
    """The table loaded by files in several micro-batches, then compacted into a folder a day."""
    root = scratch_path(spark, "compact_serving")
    load_stream(spark, raw_store(spark, sf), f"{root}/table", f"{root}/checkpoint", max_files_per_trigger=1500).awaitTermination()
    serving.compact_serving(spark, f"{root}/table", "2100-01-01")
    return stores.scan_serving(spark, f"{root}/table")


STRICT = ", ".join(
    ts_text(c) if c in ("event_time", "received_time")
    else f"strftime({c}, '%Y-%m-%d') as {c}" if c == "event_date"
    else f"coalesce({c}, '') as {c}" if c in serving.FILLED_STRICT
    else f"greatest({c}, 0) as {c}" if c == "nats_sequence" else c
    for c in SERVING_COLUMNS
)


@register("load_readme_variant", f"with {SERVING_CTE} select {STRICT} from serving")
def _(spark, sf):
    return serving.strict_serving_rows(raw_rows(spark, sf))


@register(
    "late_rows",
    f"""with {PLACED} select event_date, hour, count(*) as late from placed
    where date_trunc('hour', try_cast(received_at as timestamp))
      > cast(event_date || ' ' || hour || ':00:00' as timestamp) + interval '1' hour group by 1, 2""",
)
def _(spark, sf):
    late = serving.late_rows(stores.scan_raw(spark, raw_store(spark, sf)))
    return late.groupBy("event_date", "hour").agg(F.count("*").alias("late"))


@register("event_date_of", f"""with {SERVING_CTE} select strftime(event_date, '%Y-%m-%d') as event_date,
  cast(strftime(event_date, '%Y%m') as integer) as month, count(*) as n from serving group by 1, 2""")
def _(spark, sf):
    from tallystream.functions.times import event_date_of, event_month_of

    rows = stores.scan_serving(spark, serving_store(spark, sf)).select("event_time")
    day = event_date_of(F.col("event_time"))
    return rows.groupBy(day.alias("event_date"), event_month_of(day).alias("month")).agg(F.count("*").alias("n"))
