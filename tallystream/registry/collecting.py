"""Request batches -> verdicts, lookups, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.functions import identity
from tallystream.functions.network import client_ip, ip_key
from tallystream.operators import enrich, geo
from tallystream.operators import requests as ops
from tallystream.plans.collect import collect_messages, messages_to_raw
from tallystream.registry import register
from tallystream.registry.fixture import RANGES, RAW_CTE, REQUESTS_CTE, duck, keys, ranges, raw_rows, requests
from tallystream.session import freed_shuffles, scratch_path
from tallystream.sources.requests import read_requests
from tallystream.sources.stores import scan_raw
from tallystream.streaming.collect import collect_stream

SALT = "pepper"
MAX_BYTES, MAX_EVENTS = 16_000, 37

# The event array of a body, [] when the member is absent, NULL when unreadable.
BODY_CTE = f"""{REQUESTS_CTE},
bodies as (select *, json_valid(body) as ok, octet_length(encode(body)) as request_bytes from requests),
listed as (select *, case when ok and json_type(body) = 'OBJECT' then
    case when json_type(body, '$.events') is null then [] when json_type(body, '$.events') = 'ARRAY'
      then cast(json_extract(body, '$.events[*]') as json[]) end end as events from bodies),
event_rows as (select request_id, request_bytes, api_key, received_at, user_agent, forwarded_for, real_ip, peer_ip,
    unnest(events) as e, generate_subscripts(events, 1) - 1 as position from listed)"""
PROBLEM = """case
  when coalesce(json_type(e, '$.event_id'), '') <> 'VARCHAR' then 'event_id'
  when coalesce(json_type(e, '$.app_id'), '') <> 'VARCHAR' then 'app_id'
  when coalesce(json_type(e, '$.event_name'), '') <> 'VARCHAR' then 'event_name'
  when json_type(e, '$.event_timestamp') = 'VARCHAR'
    and try_cast(json_extract_string(e, '$.event_timestamp') as timestamp) is null then 'event_timestamp'
  when coalesce(json_type(e, '$.user'), 'NULL') not in ('NULL', 'OBJECT') then 'user'
  when coalesce(json_type(e, '$.device.platform'), 'NULL') not in ('NULL', 'VARCHAR') then 'device.platform'
  when json_type(e, '$.consent.analytics_storage') = 'VARCHAR'
    and lower(json_extract_string(e, '$.consent.analytics_storage')) not in ('true','false','yes','no') then 'consent.analytics_storage'
  when json_type(e, '$.event_params') <> 'OBJECT' then 'event_params' end"""


def _verdict_cte(max_bytes: int, max_events: int) -> str:
    return f"""{BODY_CTE},
checked as (select request_id, bool_or(({PROBLEM}) is not null) as broken,
    bool_or(json_extract_string(e, '$.app_id') is distinct from k.app_id) as other_app
  from event_rows left join keys k using (api_key) group by 1),
verdicts as (select l.*, case
    when request_bytes > {max_bytes} then 'request_too_large'
    when events is null or broken then 'validation_error'
    when len(events) = 0 then 'empty_events'
    when len(events) > {max_events} then 'events_limit_exceeded'
    when coalesce(api_key, '') = '' then 'auth_missing_key'
    when coalesce(k.app_id, '') = '' then 'auth_invalid_key'
    when other_app then 'auth_app_mismatch' end as reason
  from listed l left join checked using (request_id) left join keys k using (api_key))"""


VERDICTS = _verdict_cte(ops.MAX_REQUEST_BYTES, ops.MAX_EVENTS_PER_REQUEST)

# First usable address; the fixture's forwarded items are known by shape.
CLIENT_IP = r"""case
  when regexp_matches(coalesce(forwarded_for, ''), '"[0-9.]+:443"') then regexp_extract(forwarded_for, '"([0-9.]+):443"', 1)
  when regexp_matches(coalesce(forwarded_for, ''), '\[2001') then regexp_extract(forwarded_for, '\[([^\]]+)\]', 1)
  when real_ip is not null and real_ip <> 'unknown' then real_ip
  else coalesce(peer_ip, '') end"""
# A range lookup written out per block kind: supplier blocks, then nation blocks.
PART = lambda mark, n: f"try_cast(split_part(client_ip, '{mark}', {n}) as bigint)"
LOCATED_CTE = f"""spoken as (select *, {CLIENT_IP} as client_ip from requests),
clients as (select *,
  ((({PART('.', 1)} - 50) * 256 + {PART('.', 2)}) * 256 + {PART('.', 3)}) * 256 + {PART('.', 4)} as number4,
  (({PART(':', 3)} * 10000 + {PART(':', 4)}) * 10000 + {PART(':', 5)}) * 10000 + {PART(':', 6)} as number6 from spoken),
located as (
  select c.*,
    coalesce(n4.n_name, n6.n_name, nb.n_name) as geo_name,
    upper(substr(coalesce(n4.n_name, n6.n_name), 1, 2)) as geo_code
  from clients c
  left join supplier s4 on client_ip like '%.%' and s4.s_suppkey * 4 = number4 - number4 % 4 and number4 % 4 <= 2
  left join nation n4 on n4.n_nationkey = s4.s_nationkey
  left join supplier s6 on client_ip like '2001:%' and s6.s_suppkey = number6
  left join nation n6 on n6.n_nationkey = s6.s_nationkey
  left join nation nb on client_ip like '2_.%' and nb.n_nationkey = try_cast(split_part(client_ip, '.', 1) as bigint) - 20)"""


def _judged(spark, sf):
    return ops.judge_requests(requests(spark, sf), keys(spark, sf))


@register(
    "ingest_batches",
    f"with {BODY_CTE} select request_id, position, json_extract_string(e, '$.event_id') as event_id, "
    "json_extract_string(e, '$.event_params.k') as k from event_rows",
)
def _(spark, sf):
    """Request files read back, one row per event."""
    path = scratch_path(spark, "requests")
    requests(spark, sf).write.json(path)
    events = ops.explode_events(ops.split_events(read_requests(spark, path)))
    return events.select(
        "request_id", "position",
        F.get_json_object("event", "$.event_id").alias("event_id"),
        F.get_json_object("event", "$.event_params.k").alias("k"),
    )


@register(
    "validate_envelope",
    f"with {BODY_CTE} select request_id, position, {PROBLEM} as problem from event_rows",
)
def _(spark, sf):
    events = ops.explode_events(ops.split_events(requests(spark, sf)))
    return events.select("request_id", "position", ops.envelope_problem(F.col("event")).alias("problem"))


@register(
    "batch_limits",
    f"with {_verdict_cte(MAX_BYTES, MAX_EVENTS)} select request_id, request_bytes, reason from verdicts",
)
def _(spark, sf):
    """Verdicts under limits tight enough to matter for these batches."""
    judged = ops.judge_requests(requests(spark, sf), keys(spark, sf), MAX_BYTES, MAX_EVENTS)
    return judged.select("request_id", "request_bytes", "reason")


@register(
    "route_by_key",
    f"""with {BODY_CTE} select request_id, position, k.app_id as allowed_app, case
      when coalesce(api_key, '') = '' then 'auth_missing_key' when coalesce(k.app_id, '') = '' then 'auth_invalid_key'
      when k.app_id <> json_extract_string(e, '$.app_id') then 'auth_app_mismatch' end as reason
    from event_rows left join keys k using (api_key)""",
)
def _(spark, sf):
    keyed = ops.with_allowed_app(ops.split_events(requests(spark, sf)), keys(spark, sf))
    events = ops.explode_events(keyed)
    app = F.get_json_object("event", "$.app_id")
    return events.select(
        "request_id", "position", "allowed_app",
        ops.auth_reason(F.col("api_key"), F.col("allowed_app"), app).alias("reason"),
    )


@register("reject_whole_batch", f"with {VERDICTS} select request_id, reason, len(events) as events from verdicts where reason is not null")
def _(spark, sf):
    rejected = ops.rejected_batches(_judged(spark, sf))
    return rejected.select("request_id", "reason", F.size("events").alias("events")).withColumn(
        "events", F.when(F.col("events") >= 0, F.col("events"))
    )


@register(
    "batch_summary",
    f"""with {VERDICTS} select v.request_id, count(*) as accepted_events,
      count(distinct json_extract_string(e.e, '$.app_id')) as distinct_app_ids, max(v.request_bytes) as request_bytes
    from verdicts v join event_rows e using (request_id) where reason is null group by 1""",
)
def _(spark, sf):
    return ops.batch_summary(_judged(spark, sf))


@register("reject_summary", f"with {VERDICTS} select reason, count(*) as batches from verdicts where reason is not null group by 1")
def _(spark, sf):
    return ops.reject_summary(_judged(spark, sf))


@register("client_ip", f"with {REQUESTS_CTE} select request_id, {CLIENT_IP} as client_ip from requests")
def _(spark, sf):
    ip = client_ip(F.col("forwarded_for"), F.col("real_ip"), F.col("peer_ip"))
    return requests(spark, sf).select("request_id", ip.alias("client_ip"))


@register(
    "ip_hash",
    f"with {REQUESTS_CTE}, c as (select request_id, {CLIENT_IP} as client_ip from requests) "
    f"select request_id, case when client_ip <> '' then sha256('{SALT}:' || client_ip) end as client_ip_hash from c",
)
def _(spark, sf):
    return enrich.with_client(requests(spark, sf), SALT).select("request_id", "client_ip_hash")


@register("geo_enrich", f"with {REQUESTS_CTE}, {LOCATED_CTE} select request_id, client_ip, geo_name, geo_code from located")
def _(spark, sf):
    clients = enrich.with_client(requests(spark, sf), SALT)
    return geo.with_country(clients, ranges(spark, sf)).select("request_id", "client_ip", "geo_name", "geo_code")


@register(
    "country_normalise",
    f"""select lo_ip, hi_ip, coalesce(nullif(trim(nested_name), ''), nullif(trim(flat_name), '')) as geo_name,
      upper(coalesce(nullif(trim(nested_code), ''), nullif(trim(flat_code), ''))) as geo_code from ({duck(RANGES)}) r""",
)
def _(spark, sf):
    return geo.normalise_country(ranges(spark, sf))


@register(
    "route_subject",
    f"with {RAW_CTE} select app_id, 'in.' || replace(trim(' ' || app_id || ' x '), ' ', '_') as subject, count(*) as n from raw group by 1, 2",
)
def _(spark, sf):
    odd = F.concat(F.lit(" "), F.col("app_id"), F.lit(" x "))
    rows = raw_rows(spark, sf).select("app_id", identity.route_subject("in", odd).alias("subject"))
    return rows.groupBy("app_id", "subject").agg(F.count("*").alias("n"))


# What the collector hands on, member by member.
OUT_CTE = f"""{VERDICTS}, {LOCATED_CTE},
outgoing as (select e.request_id, e.position, e.e, l.client_ip, l.geo_name, l.geo_code, l.received_at, l.user_agent
  from event_rows e join verdicts v using (request_id) join located l using (request_id) where v.reason is null)"""
SERVER_TIME = """strftime(received_at, '%Y-%m-%dT%H:%M:%S') ||
  case when microsecond(received_at) % 1000000 = 0 then '' else strftime(received_at, '.%f') end || '+00:00'"""
EVENT_TIME = """case when json_type(e, '$.event_timestamp') <> 'VARCHAR' then '2024-01-01T00:00:00Z' else
  strftime(try_cast(json_extract_string(e, '$.event_timestamp') as timestamp), '%Y-%m-%dT%H:%M:%S') ||
  case when microsecond(try_cast(json_extract_string(e, '$.event_timestamp') as timestamp)) % 1000000 = 0 then ''
    else strftime(try_cast(json_extract_string(e, '$.event_timestamp') as timestamp), '.%f') end || 'Z' end"""
CLIENT_INGEST = "json_type(e, '$.ingest') = 'OBJECT'"
GEO = """case
  when json_type(e, '$.geo') = 'OBJECT' then '{"country":"' || coalesce(geo_name, 'Wrong') || '","country_code":"'
    || coalesce(geo_code, 'WR') || '","city":"Oulu","region":null,"timezone":null}'
  when geo_name is not null then '{"country":"' || geo_name || '"' || coalesce(',"country_code":"' || geo_code || '"', '') || '}'
  else '{}' end"""


def _messages(spark, sf):
    return collect_messages(requests(spark, sf), keys(spark, sf), ranges(spark, sf), SALT)


@register(
    "ingest_defaults",
    f"""with {OUT_CTE} select request_id, position,
      case when {CLIENT_INGEST} then json_extract_string(e, '$.ingest.request_id') else request_id end as ingest_request_id,
      case when {CLIENT_INGEST} then null else user_agent end as ingest_user_agent,
      case when not coalesce({CLIENT_INGEST}, false) and client_ip <> '' then sha256('{SALT}:' || client_ip) end as ingest_ip_hash,
      case when {CLIENT_INGEST} then null else {SERVER_TIME} end as received_at
    from outgoing""",
)
def _(spark, sf):
    """Server-side ingest facts, absent as soon as the client sends any ingest object."""
    value = lambda path: F.get_json_object("value", path)
    return _messages(spark, sf).select(
        "request_id", "position",
        value("$.ingest.request_id").alias("ingest_request_id"),
        value("$.ingest.user_agent").alias("ingest_user_agent"),
        value("$.ingest.ip_hash").alias("ingest_ip_hash"),
        value("$.ingest.received_at").alias("received_at"),
    )


@register("geo_merge", f"with {OUT_CTE} select request_id, position, {GEO} as geo_json from outgoing")
def _(spark, sf):
    geo_text = F.coalesce(F.get_json_object("value", "$.geo"), F.lit("{}"))
    return _messages(spark, sf).select("request_id", "position", geo_text.alias("geo_json"))


@register(
    "collect_to_raw",
    f"""with {OUT_CTE} select json_extract_string(e, '$.event_id') as event_id, json_extract_string(e, '$.app_id') as app_id,
      'prod' as environment, json_extract_string(e, '$.event_name') as event_name, {EVENT_TIME} as event_timestamp,
      case when {CLIENT_INGEST} then null else {SERVER_TIME} end as received_at,
      json_extract_string(e, '$.user.user_pseudo_id') as user_pseudo_id, 'ios' as platform,
      cast(json_extract(e, '$.event_params') as varchar) as event_params_json, {GEO} as geo_json,
      case when json_type(e, '$.consent') = 'OBJECT'
        then '{{"analytics_storage":true,"ads_storage":false,"personalization":null}}' else '{{}}' end as consent_json,
      'EVENTS' as nats_stream, position as nats_sequence from outgoing""",
)
def _(spark, sf):
    """The whole collector: judged, enriched, spelled out as a message, flattened."""
    raw = messages_to_raw(_messages(spark, sf))
    return raw.select(
        "event_id", "app_id", "environment", "event_name", "event_timestamp", "received_at", "user_pseudo_id",
        "platform", "event_params_json", "geo_json", "consent_json", "nats_stream", "nats_sequence",
    )


@register(
    "collect_stream",
    f"""with {OUT_CTE} select json_extract_string(e, '$.app_id') as app_id, json_extract_string(e, '$.event_id') as event_id,
      cast(2 as bigint) as n from outgoing group by all""",
)
def _(spark, sf):
    """Requests that are sent again within the window and once more after it, streamed through to the raw layer."""
    root = scratch_path(spark, "collect_stream")
    for part, times in enumerate(([("0 minutes", 0)], [("5 minutes", 5), ("1 hour", 60)])):
        later = F.array(*[F.struct(F.lit(text).alias("later"), F.lit(minutes).alias("minutes")) for text, minutes in times])
        sent = requests(spark, sf).select("*", F.inline(later)).withColumns({
            "request_id": F.concat_ws(" after ", "request_id", "later"),
            "received_at": F.col("received_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("minutes")),
        }).drop("later", "minutes")
        # The requests of a part are put together once, and packed: as plain text the log is most of what lies on disk.
        # A packed file is one task's, so each has few requests.
        with freed_shuffles(spark):
            sent.write.option("maxRecordsPerFile", 1000).json(f"{root}/log/part={part}", compression="gzip")
        log = read_requests(spark, f"{root}/log/part=*", stream=True)
        collect_stream(
            log, keys(spark, sf), ranges(spark, sf), f"{root}/raw", f"{root}/state", f"{root}/checkpoint",
            every_seconds=None, salt=SALT,
        ).awaitTermination()
    return scan_raw(spark, f"{root}/raw").groupBy("app_id", "event_id").agg(F.count("*").alias("n"))


@register(
    "ip_key",
    r"""select lo_ip, case when lo_ip like '%.%' then '00000000000000000000ffff' || lower(
        printf('%02x%02x%02x%02x', cast(split_part(lo_ip, '.', 1) as bigint), cast(split_part(lo_ip, '.', 2) as bigint),
          cast(split_part(lo_ip, '.', 3) as bigint), cast(split_part(lo_ip, '.', 4) as bigint)))
      else '20010db8' || lpad(split_part(lo_ip, ':', 3), 4, '0') || lpad(split_part(lo_ip, ':', 4), 4, '0')
        || lpad(split_part(lo_ip, ':', 5), 4, '0') || lpad(split_part(lo_ip, ':', 6), 4, '0') || repeat('0', 8) end as ip_key from ("""
    + duck(RANGES) + ") r",
)
def _(spark, sf):
    return ranges(spark, sf).select("lo_ip", ip_key(F.col("lo_ip")).alias("ip_key"))
