"""Raw layer -> base model."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallystream.functions import json_text
from tallystream.functions.times import parse_best_effort_ms, parse_strict_offset
from tallystream.operators.dedupe import dedupe_latest
from tallystream.operators.filters import filter_received_range
from tallystream.plans import base_model as model
from tallystream.registry import register
from tallystream.registry.fixture import RAW_CTE, raw_rows, raw_store, ts_text
from tallystream.registry.loading import PLACED, RAW_TEXT
from tallystream.schemas import PROMOTED_FIELDS, RAW_COLUMNS
from tallystream.session import scratch_path
from tallystream.sources.stores import scan_raw

START, MIDDLE, END = datetime(2024, 1, 3), datetime(2024, 1, 17, 9), datetime(2024, 1, 30, 12)
RECEIVED = "try_cast(received_at as timestamp)"


def _range(start: str, end: str) -> str:
    return f"""select *, {RECEIVED} as received_at_ts from placed
      where event_date between '{start[:10]}' and '{end[:10]}'
      and {RECEIVED} >= timestamp '{start}' and {RECEIVED} < timestamp '{end}'"""


def _latest(source: str) -> str:
    return f"""select * exclude (rk) from (select *, row_number() over (partition by app_id, event_id order by
      received_at_ts desc nulls last, nats_sequence desc nulls last, event_timestamp desc nulls last,
      ingest_request_id desc nulls last) as rk from ({source}) s) r where rk = 1"""


MODEL_TEXT = f"{RAW_TEXT}, event_date, hour, json_extract_string(geo_json, '$.country_code') as geo_country_code, {ts_text('received_at_ts')}"
FULL = _range("2024-01-03 00:00:00", "2024-01-30 12:00:00")


def _json_value(column: str, path: str) -> str:
    safe = f"case when json_valid({column}) then {column} end"
    return (
        f"case when json_type({safe}, '{path}') not in ('OBJECT', 'ARRAY', 'NULL') "
        f"then json_extract_string({safe}, '{path}') end"
    )


def _promoted(name: str, column: str, path: str, cast: str | None) -> str:
    value = _json_value(column, path)
    if cast == "boolean":
        value = f"case lower({value}) when 'true' then true when 'false' then false end"
    return f"{value} as {name}"


@register(
    "filter_received_range",
    f"with {PLACED} select app_id, event_id, event_date, {ts_text('received_at_ts')}, nats_sequence from ({FULL}) s",
)
def _(spark, sf):
    rows = filter_received_range(scan_raw(spark, raw_store(spark, sf)), START, END)
    return rows.select("app_id", "event_id", "event_date", "received_at_ts", "nats_sequence")


@register(
    "dedupe_latest",
    f"with {RAW_CTE} select app_id, event_id, received_at, nats_sequence, event_timestamp, ingest_request_id "
    f"from ({_latest(f'select *, {RECEIVED} as received_at_ts from raw')}) s",
)
def _(spark, sf):
    rows = raw_rows(spark, sf).withColumn("received_at_ts", parse_strict_offset(F.col("received_at")))
    return dedupe_latest(rows).select(
        "app_id", "event_id", "received_at", "nats_sequence", "event_timestamp", "ingest_request_id"
    )


@register(
    "promote_fields",
    f"with {RAW_CTE} select app_id, event_id, nats_sequence, "
    + ", ".join(_promoted(*f[:4]) for f in PROMOTED_FIELDS) + " from raw",
)
def _(spark, sf):
    """All defined fields, not only the one promoted by default."""
    names = [f[0] for f in PROMOTED_FIELDS]
    rows = raw_rows(spark, sf)
    return model.promote_fields(rows, model.enabled_fields(names)).select(
        "app_id", "event_id", "nats_sequence", *names
    )


@register("base_model", f"with {PLACED} select {MODEL_TEXT} from ({_latest(FULL)}) s")
def _(spark, sf):
    return model.base_model(scan_raw(spark, raw_store(spark, sf)), START, END)


def _model_columns(rows):
    return rows.select(*RAW_COLUMNS, "event_date", "hour", "geo_country_code", "received_at_ts")


@register("base_model_write", f"with {PLACED} select {MODEL_TEXT} from ({_latest(FULL)}) s")
def _(spark, sf):
    """One refresh of the whole range, read back from the written table."""
    root = scratch_path(spark, "base_model_write")
    model.refresh_model(spark, raw_store(spark, sf), root, START, END, lookback_hours=0)
    return _model_columns(model.scan_model(spark, root))


FIRST_RUN = _latest(_range("2024-01-02 18:00:00", "2024-01-17 09:00:00"))
SECOND_RUN = _latest(_range("2024-01-17 03:00:00", "2024-01-30 12:00:00"))


@register(
    "base_model_incremental",
    f"""with {PLACED} select {MODEL_TEXT} from (
      select * from ({FIRST_RUN}) a where received_at_ts < timestamp '2024-01-17 03:00:00'
      union all select * from ({SECOND_RUN}) b) s""",
)
def _(spark, sf):
    """Two refreshes in turn, the second with its six hours of lookback, then the second again."""
    root, raw = scratch_path(spark, "base_model_incremental"), raw_store(spark, sf)
    model.refresh_model(spark, raw, root, START, MIDDLE)
    model.refresh_model(spark, raw, root, MIDDLE, END)
    return _model_columns(model.scan_model(spark, root))


TEXTS = f"{RAW_CTE}, texts as (select distinct received_at as t from raw union select distinct event_timestamp from raw)"


@register(
    "parse_strict_offset",
    f"with {TEXTS} select t, case when t like '%+00:00' then strftime(try_cast(t as timestamp), '%Y-%m-%d %H:%M:%S.%f') end as parsed from texts",
)
def _(spark, sf):
    """A trailing Z is not an offset here."""
    rows = raw_rows(spark, sf)
    texts = rows.select(F.col("received_at").alias("t")).union(rows.select("event_timestamp")).distinct()
    return texts.select("t", parse_strict_offset(F.col("t")).alias("parsed"))


@register(
    "parse_best_effort_ms",
    f"""with {TEXTS}, digits as (select t from texts union select cast(cast(floor(epoch(try_cast(t as timestamp))) as bigint) as varchar)
      from texts where t <> 'bad-date')
    select t, strftime(date_trunc('milliseconds', case when regexp_matches(t, '^[0-9]+$')
      then make_timestamp(cast(t as bigint) * 1000000) else try_cast(t as timestamp) end), '%Y-%m-%d %H:%M:%S.%f') as parsed from digits""",
)
def _(spark, sf):
    rows = raw_rows(spark, sf)
    texts = rows.select(F.col("received_at").alias("t")).union(rows.select("event_timestamp")).distinct()
    digits = texts.where("t <> 'bad-date'").select(F.unix_timestamp(F.col("t").cast("timestamp")).cast("string"))
    return texts.union(digits).distinct().select("t", parse_best_effort_ms(F.col("t")).alias("parsed"))


@register(
    "json_value",
    f"with {RAW_CTE} select app_id, event_id, nats_sequence, {_json_value('event_params_json', '$.page')} as page, "
    f"{_json_value('event_params_json', '$.dimensions')} as dimensions, {_json_value('event_params_json', '$.result')} as result, "
    f"{_json_value('event_params_json', '$.view.x')} as view_x, {_json_value('event_params_json', '$.k')} as k from raw",
)
def _(spark, sf):
    value = lambda path, name: json_text.json_value(F.col("event_params_json"), path).alias(name)
    return raw_rows(spark, sf).select(
        "app_id", "event_id", "nats_sequence", value("$.page", "page"), value("$.dimensions", "dimensions"),
        value("$.result", "result"), value("$.view.x", "view_x"), value("$.k", "k"),
    )


@register(
    "safe_cast",
    f"""with {RAW_CTE}, t as (select event_id, nats_sequence, session_id, {_json_value('event_params_json', '$.is_pro')} as b,
      split_part(session_id, '-', 1) as i from raw)
    select event_id, nats_sequence, case lower(b) when 'true' then true when 'false' then false end as as_bool,
      try_cast(i as bigint) as as_int, cast(null as bigint) as not_int from t""",
)
def _(spark, sf):
    rows = raw_rows(spark, sf).withColumn("b", json_text.json_value(F.col("event_params_json"), "$.is_pro"))
    return rows.select(
        "event_id", "nats_sequence", json_text.safe_bool(F.col("b")).alias("as_bool"),
        json_text.safe_int(F.substring_index("session_id", "-", 1)).alias("as_int"),
        json_text.safe_int(F.col("session_id")).alias("not_int"),
    )
