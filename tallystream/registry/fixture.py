"""Inputs derived from the given `events`, `supplier` and `nation` tables.

Every text below runs unchanged in Spark and in DuckDB, so both sides of a check
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.plans.landing import land_raw
from tallystream.plans.serving import load_serving
from tallystream.session import scratch_path
from tallystream.sources.stores import scan_raw, scan_serving
from tallystream.streaming.landing import load_stream
from tallystream.streaming.rollups import Rollup, retention_rollup, sessions_rollup, values_rollup

# Driver events with resends: exact copies, after 5 minutes, after 3 hours.
SENT = """
  select event_id, user_id as uid, event_type, ts, props, 0 as resend, ts as sent from {events}
  union all
  select event_id, user_id, event_type, ts, props, 0, ts from {events} where event_id % 110 = 9
  union all
  select event_id, user_id, event_type, ts, props, 1, ts + interval '5' minute from {events} where event_id % 50 = 3
  union all
  select event_id, user_id, event_type, ts, props, 2, ts + interval '3' hour from {events} where event_id % 70 = 5
"""

RAW = """
select
  'e' || cast(event_id as string) as event_id,
  'app_' || cast(uid % 3 as string) as app_id,
  case when event_id % 10 = 0 then 'dev' else 'prod' end as environment,
  event_type as event_name,
  case when event_id % 97 = 0 then 'bad-date'
       else replace(cast(ts as string), ' ', 'T') || 'Z' end as event_timestamp,
  replace(cast(sent + (event_id % 7) * interval '1' minute as string), ' ', 'T') || '+00:00' as received_at,
  case when event_id % 4 = 0 then '' when event_id % 4 = 1 then null else cast(uid as string) end as user_id,
  case when event_id % 12 = 0 then null else 'anon_' || cast(uid as string) end as user_pseudo_id,
  cast(uid as string) || '-' || cast(cast(ts as date) as string) as session_id,
  case uid % 3 when 0 then 'webgl' when 1 then 'ios' else 'android' end as platform,
  '1.' || cast(event_id % 5 as string) as app_version,
  case when event_id % 9 = 0 then null else 'os-' || cast(uid % 4 as string) end as os_version,
  'model-' || cast(uid % 6 as string) as device_model,
  'en-US' as locale,
  'UTC' as timezone,
  case when event_id % 13 = 0 then ''
       when event_id % 13 = 1 then '{"page":"/p","is_pro":true,"dimensions":["a","b"],"view":{"x":1}}'
       when event_id % 13 = 2 then '{"page":null,"is_pro":"false","has_capture":"maybe","product":"gem","result":"{odd"}'
       when event_id % 13 = 3 then null
       else props end as event_params_json,
  case uid % 2 when 0 then '{"plan_tier":"free"}' else '{"plan_tier":"pro","ab_group":"b"}' end
    as user_properties_json,
  '{}' as traffic_source_json,
  '{"country":"X","country_code":"' || case uid % 3 when 0 then 'FI' when 1 then 'DE' else 'US' end
    || '","city":null}' as geo_json,
  '{"analytics_storage":true,"ads_storage":false}' as consent_json,
  'r' || cast(event_id % 500 as string) || '-' || cast(resend as string) as ingest_request_id,
  case when event_id % 20 = 1 then 'Mozilla/5.0 (compatible; Googlebot/2.1)'
       when event_id % 20 = 2 then null else 'Mozilla/5.0' end as ingest_user_agent,
  case when event_id % 3 = 0 then null else 'hash-' || cast(uid as string) end as ingest_ip_hash,
  'EVENTS' as nats_stream,
  event_id * 3 + resend as nats_sequence
from ({sent}) sent
"""

# Messages of the log. Some are not JSON; ids are numbers in some; the receive
# time is outside or inside `ingest`; maps are null, spaced or absent.
MESSAGES = """
select
  case when event_id % 211 = 7 then 'no json ' || cast(event_id as string)
       when event_id % 211 = 8 then '[' || cast(event_id as string) || ']'
       else '{"event_id": ' || case when event_id % 2 = 0 then cast(event_id as string)
                                     else '"e' || cast(event_id as string) || '"' end
    || case when event_id % 31 = 0 then '' when event_id % 31 = 1 then ',"app_id":""'
            else ',"app_id":"app_' || cast(uid % 3 as string) || '"' end
    || ',"environment":' || case when event_id % 10 = 0 then 'null' else '"prod"' end
    || ',"event_name":"' || event_type || '","event_timestamp":"'
    || case when event_id % 97 = 0 then 'bad-date' else replace(cast(ts as string), ' ', 'T') || 'Z' end || '"'
    || case when event_id % 3 = 0 then ',"received_at":"' || replace(cast(sent as string), ' ', 'T') || '+00:00"'
            when event_id % 3 = 1 then ',"received_at":null' else '' end
    || ',"user":' || case when event_id % 4 = 1 then 'null'
                          else '{"user_id":"' || cast(uid as string) || '","session_id":null}' end
    || ',"device":{"platform":"ios","locale":"en-US"}'
    || ',"event_params":' || props
    || case when event_id % 5 = 0 then ',"user_properties":null'
            when event_id % 5 = 1 then ',"user_properties":{ "b" : [1, 2], "a" : "x y" }' else '' end
    || ',"geo":{"country":"X","city":null},"consent":null,"ingest":{"request_id":"r'
    || cast(event_id % 500 as string) || '","received_at":"' || replace(cast(sent as string), ' ', 'T') || 'Z"}}'
  end as value,
  'EVENTS' as stream,
  case when event_id % 89 = 0 then '1180591620717411303424' when event_id % 89 = 1 then '-5'
       when event_id % 89 = 2 then null else cast(event_id * 3 + resend as string) end as sequence,
  sent as published_at,
  'app_' || cast(uid % 3 as string) as app_id,
  'e' || cast(event_id as string) as event_id
from ({sent}) sent
"""

# One request event: (app, batch, ord, txt). A few are invalid in one field each.
REQUEST_EVENTS = """
select
  uid % 3 as app, cast(floor(event_id / 100.0) as bigint) as batch, event_id * 10 + resend as ord,
  sent,
  '{"event_id":"e' || cast(event_id as string) || '","app_id":"app_' || cast(uid % 3 as string) || '"'
    || ',"environment":"prod","event_name":'
    || case when event_id % 1009 = 8 then '7' else '"' || event_type || '"' end
    || ',"event_timestamp":'
    || case when event_id % 1021 = 11 then '"yesterday"' when event_id % 103 = 14 then '1704067200'
            else '"' || replace(cast(ts as string), ' ', 'T') || 'Z"' end
    || ',"user":' || case when event_id % 1013 = 9 then '"x"'
                          else '{"user_pseudo_id":"anon_' || cast(uid as string) || '"}' end
    || case when event_id % 1031 = 12 then ',"device":{"platform":5}' else ',"device":{"platform":"ios"}' end
    || case when event_id % 5 = 0 then ',"geo":{"country":"Wrong","country_code":"WR","city":"Oulu"}' else '' end
    || case when event_id % 1033 = 13 then ',"consent":{"analytics_storage":"maybe"}'
            when event_id % 7 = 1 then ',"consent":{"analytics_storage":true,"ads_storage":"no"}' else '' end
    || case when event_id % 1019 = 10 then ',"event_params":null' else ',"event_params":' || props end
    || case when event_id % 11 = 0 then ',"ingest":{"request_id":"client"}'
            when event_id % 11 = 1 then ',"ingest":{}' else '' end
    || ',"extra":1}' as txt
from ({sent}) sent
"""

# Request headers by (app, batch); body_kind says what happens to the body.
REQUEST_HEADS = """
select app, batch, received_at, txt,
  'q' || cast(batch as string) || '-' || cast(app as string) as request_id,
  case when batch % 17 = 3 then cast(null as string) when batch % 19 = 4 then 'nope'
       when batch % 23 = 5 then 'key_' || cast((app + 1) % 3 as string)
       when batch % 47 = 11 then 'key_blank' else 'key_' || cast(app as string) end as api_key,
  case when batch % 4 = 0 then 'unknown, "' || {octets}.' || cast(batch * 4 % 256 + 1 + app as string) || ':443"'
       when batch % 4 = 1 then cast(null as string)
       when batch % 4 = 2 then ' 1.2.3 , [' || {groups} || '::5]:80, 10.0.0.1'
       else '' end as forwarded_for,
  case when batch % 8 = 1 then '2' || cast(batch % 9 as string) || '.7.7.7' when batch % 8 = 3 then 'unknown'
       else cast(null as string) end as real_ip,
  case when batch % 8 = 3 then cast(null as string) else '172.16.0.' || cast(batch % 200 as string) end as peer_ip,
  case when batch % 6 = 0 then cast(null as string) else 'agent/' || cast(batch % 6 as string) end as user_agent,
  case when batch % 29 = 6 then '{"events":[]}' when batch % 31 = 7 then 'no json'
       when batch % 37 = 8 then '{"events":[' || txt when batch % 41 = 9 then '{"other":1}'
       when batch % 43 = 10 then '{"events":null}'
       else '{"events":[' || txt || ']}' end as body
from ({grouped}) grouped
"""

KEYS = """
select distinct 'key_' || cast(n_nationkey % 3 as string) as api_key,
  'app_' || cast(n_nationkey % 3 as string) as app_id from {nation}
union all
select distinct 'key_blank', '' from {nation}
"""

# Address ranges: three of four IPv4 addresses and one IPv6 block per supplier, and an IPv4
# block of many prefixes per nation. The supplier's key runs over all octets after the first
# (on from 50) and over four groups, four decimal digits each.
RANGES = """
select {octets}.' || cast(s_suppkey * 4 % 256 as string) as lo_ip,
  {octets}.' || cast(s_suppkey * 4 % 256 + 2 as string) as hi_ip,
  ' ' || n_name as nested_name, cast(null as string) as nested_code,
  'flat' as flat_name, lower(substr(n_name, 1, 2)) as flat_code
from {supplier} join {nation} on s_nationkey = n_nationkey
union all
select {groups} || '::', {groups} || ':ffff:ffff',
  n_name, lower(substr(n_name, 1, 2)), '', ''
from {supplier} join {nation} on s_nationkey = n_nationkey
union all
select cast(20 + n_nationkey as string) || '.0.0.0', cast(20 + n_nationkey as string) || '.255.255.255',
  '', '', n_name, cast(null as string)
from {nation}
"""


def octets(key: str) -> str:
    """SQL of a key's first three octets, with its last quote left open."""
    part = lambda size: f"cast(floor({key} * 4 / {size}.0) as bigint)"
    return (f"cast(50 + {part(1 << 24)} as string) || '.' || cast({part(1 << 16)} % 256 as string) || '.' || "
            f"cast({part(1 << 8)} % 256 as string) || '")


def groups(key: str) -> str:
    part = lambda size: f"cast(cast(floor({key} / {size}.0) as bigint) % 10000 as string)"
    return "'2001:db8:' || " + " || ':' || ".join(part(10 ** n) for n in (12, 8, 4, 0))


RANGES = RANGES.replace("{octets}", octets("s_suppkey")).replace("{groups}", groups("s_suppkey"))
REQUEST_HEADS = REQUEST_HEADS.replace("{octets}", octets("batch")).replace("{groups}", groups("batch"))


def duck(text: str) -> str:
    """A fixture text over the pre-registered views."""
    sent = SENT.format(events="events")
    return (
        text.replace("{sent}", sent).replace("{nation}", "nation").replace("{supplier}", "supplier")
    )


def _spark(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    names = [n for n in ("nation", "supplier") if "{" + n + "}" in text]
    tables = {n: read(n) for n in names}
    if "{sent}" in text:
        text = text.replace("{sent}", SENT)
        tables["events"] = read("events")
    # Braces of JSON literals must survive the {table} substitution.
    for name in tables:
        text = text.replace("{" + name + "}", f"@@{name}@@")
    text = text.replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace(f"@@{name}@@", "{" + name + "}")
    return spark.sql(text, **tables)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, RAW)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spark(spark, sf_dir, MESSAGES)
    return rows.withColumn("published_at", F.col("published_at").cast("timestamp"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per request, its events in one body."""
    events = _spark(spark, sf_dir, REQUEST_EVENTS)
    grouped = events.groupBy("app", "batch").agg(
        (F.max("sent") + F.expr("interval 1 minute")).alias("received_at"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "txt"))), lambda e: e["txt"]), ","
        ).alias("txt"),
    )
    heads = spark.sql(
        REQUEST_HEADS.replace("{grouped}", "@@").replace("{", "{{").replace("}", "}}").replace("(@@)", "{grouped}"),
        grouped=grouped,
    )
    return heads.withColumn("received_at", F.col("received_at").cast("timestamp")).drop("app", "batch", "txt")


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, KEYS)


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _spark(spark, sf_dir, RANGES)
    return flat.select(
        "lo_ip",
        "hi_ip",
        F.struct(F.col("nested_name").alias("name"), F.col("nested_code").alias("iso_code")).alias("country"),
        F.col("flat_name").alias("country_name"),
        F.col("flat_code").alias("country_code"),
    )


# --- DuckDB side ------------------------------------------------------------------

RAW_CTE = f"raw as ({duck(RAW)})"
MESSAGES_CTE = f"messages as ({duck(MESSAGES)})"

REQUESTS_CTE = f"""
request_events as ({duck(REQUEST_EVENTS)}),
requests as ({REQUEST_HEADS.replace("({grouped})", '''(
  select app, batch, max(sent) + interval '1' minute as received_at,
    string_agg(txt, ',' order by ord, txt) as txt
  from request_events group by app, batch)''')}),
keys as ({duck(KEYS)})
"""


def duck_time(text: str) -> str:
    return f"date_trunc('milliseconds', try_cast({text} as timestamp))"


def ts_text(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') as {alias or column}"


SERVING_CTE = f"""{RAW_CTE},
typed as (
  select distinct *, {duck_time('event_timestamp')} as event_time, {duck_time('received_at')} as received_time
  from raw),
serving as (
  select event_id, coalesce(app_id, '') as app_id, coalesce(environment, '') as environment,
    coalesce(event_name, '') as event_name, event_time, cast(event_time as date) as event_date,
    received_time, user_id, coalesce(user_pseudo_id, '') as user_pseudo_id, session_id, platform,
    app_version, os_version, device_model, locale, timezone, event_params_json,
    user_properties_json, traffic_source_json, geo_json, consent_json, ingest_request_id,
    ingest_user_agent, ingest_ip_hash, nats_stream, nats_sequence,
    coalesce(nullif(user_id, ''), coalesce(user_pseudo_id, '')) as actor
  from typed where event_time is not null)"""

# --- stores written once per session -------------------------------------------------

_stores: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _stores:
        path = scratch_path(spark, kind)
        write(path)
        _stores[key] = path
    return _stores[key]


def raw_store(spark: SparkSession, sf_dir: str) -> str:
    return _store(spark, sf_dir, "raw", lambda path: land_raw(raw_rows(spark, sf_dir), path))


def serving_store(spark: SparkSession, sf_dir: str) -> str:
    """The serving table as the loader writes it."""
    return _store(spark, sf_dir, "serving", lambda path: load_serving(scan_raw(spark, raw_store(spark, sf_dir)), path))


def loaded_rollups(spark: SparkSession, sf_dir: str) -> dict[str, Rollup]:
    """Rollups that followed a stream which loaded the raw layer in several micro-batches."""

    def named(path: str) -> dict[str, Rollup]:
        return {"sessions": sessions_rollup(f"{path}/sessions"), "retention": retention_rollup(f"{path}/retention"),
                "values": values_rollup(f"{path}/values", "$.k")}

    def write(path: str) -> None:
        sinks = [r.sink("fixture") for r in named(path).values()]
        raw = raw_store(spark, sf_dir)
        load_stream(spark, raw, f"{path}/table", f"{path}/checkpoint", max_files_per_trigger=800, sinks=sinks).awaitTermination()
        for rollup in named(path).values():
            rollup.compact(spark)

    return named(_store(spark, sf_dir, "rollups", write))


def file_share(spark: SparkSession, sf_dir: str, rows: int = 1_000_000) -> int:
    """How many files an eighth of the log takes, one for every `rows` events of the table."""
    return 1 + spark.read.parquet(f"{sf_dir}/events.parquet").count() // rows


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """Log files for the streaming queries, split by time into eight parts of `file_share` files."""

    def write(path: str) -> None:
        rows = messages(spark, sf_dir)
        rows.repartitionByRange(8 * file_share(spark, sf_dir), "published_at").sortWithinPartitions("published_at").write.json(path)

    return _store(spark, sf_dir, "messages", write)


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table."""
    return scan_serving(spark, serving_store(spark, sf_dir))
