"""Stream messages -> raw layer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallystream.functions.json_text import compact_json, int_or_zero
from tallystream.functions.times import parse_iso
from tallystream.operators import flatten
from tallystream.operators.dedupe import dedupe_window
from tallystream.plans.landing import land_raw, partitioned_raw
from tallystream.registry import register
from tallystream.registry.fixture import MESSAGES_CTE, RAW_CTE, file_share, message_files, messages, raw_rows
from tallystream.registry.loading import PLACED, RAW_TEXT
from tallystream.session import scratch_path
from tallystream.sources.requests import stream_events
from tallystream.sources.stores import scan_raw
from tallystream.streaming.dedupe import dedupe_stream, read_kept
from tallystream.streaming.landing import dead_letters_stream, land_stream

DECODABLE = "json_valid(value) and json_type(case when json_valid(value) then value end) = 'OBJECT'"


def _s(path: str, source: str = "value") -> str:
    return f"json_extract_string({source}, '$.{path}')"


def _j(name: str) -> str:
    """Compact JSON of a member; a missing or null one is an empty object."""
    return (
        f"case when coalesce(json_type(value, '$.{name}'), 'NULL') = 'NULL' then '{{}}' "
        f"else cast(json_extract(value, '$.{name}') as varchar) end"
    )


FLAT_CTE = f"""{MESSAGES_CTE},
decoded as (select * from messages where {DECODABLE}),
flat as (select
  {_s('event_id')} as event_id, coalesce(nullif({_s('app_id')}, ''), 'unknown_app') as app_id,
  {_s('environment')} as environment, {_s('event_name')} as event_name,
  {_s('event_timestamp')} as event_timestamp,
  coalesce(nullif({_s('received_at')}, ''), {_s('ingest.received_at')}) as received_at,
  {_s('user.user_id')} as user_id, {_s('user.user_pseudo_id')} as user_pseudo_id,
  {_s('user.session_id')} as session_id, {_s('device.platform')} as platform,
  {_s('device.app_version')} as app_version, {_s('device.os_version')} as os_version,
  {_s('device.device_model')} as device_model, {_s('device.locale')} as locale,
  {_s('device.timezone')} as timezone, {_j('event_params')} as event_params_json,
  {_j('user_properties')} as user_properties_json, {_j('traffic_source')} as traffic_source_json,
  {_j('geo')} as geo_json, {_j('consent')} as consent_json,
  {_s('ingest.request_id')} as ingest_request_id, {_s('ingest.user_agent')} as ingest_user_agent,
  {_s('ingest.ip_hash')} as ingest_ip_hash, stream as nats_stream,
  coalesce(try_cast(sequence as bigint), 0) as nats_sequence,
  octet_length(encode(value)) as message_bytes
  from decoded),
flat_placed as (select *,
  strftime(coalesce(try_cast(event_timestamp as timestamp), try_cast(received_at as timestamp)), '%Y-%m-%d') as event_date,
  strftime(coalesce(try_cast(event_timestamp as timestamp), try_cast(received_at as timestamp)), '%H') as hour
  from flat)"""
FLAT_STORED = f"with {FLAT_CTE} select {RAW_TEXT}, event_date, hour from flat_placed"

# Keep, per key, the first message and then each first one a window after the last kept.
DEDUPE_SQL = f"""with recursive {MESSAGES_CTE},
t as (select distinct app_id, event_id, cast(floor(epoch(published_at)) as bigint) as s from messages),
kept as (
  select app_id, event_id, min(s) as s from t group by 1, 2
  union all
  select k.app_id, k.event_id, (select min(t.s) from t where t.app_id = k.app_id
    and t.event_id = k.event_id and t.s >= k.s + 600) as s
  from kept k where exists (select 1 from t where t.app_id = k.app_id
    and t.event_id = k.event_id and t.s >= k.s + 600))
select app_id, event_id, s as second from kept"""


@register("stream_events", f"with {MESSAGES_CTE} select value, stream, sequence, cast(floor(epoch(published_at)) as bigint) as second from messages")
def _(spark, sf):
    """The log read as a stream, a few files per micro-batch."""
    root = scratch_path(spark, "stream_events")
    stream = stream_events(spark, message_files(spark, sf), max_files_per_trigger=3 * file_share(spark, sf))
    (
        stream.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        .awaitTermination()
    )
    rows = spark.read.parquet(f"{root}/out")
    return rows.select("value", "stream", "sequence", F.unix_timestamp("published_at").alias("second"))


@register("flatten_raw", f"with {FLAT_CTE} select {RAW_TEXT} from flat")
def _(spark, sf):
    events, _ = flatten.undecodable_split(messages(spark, sf))
    return flatten.flatten_raw(events)


@register("partition_keys", f"with {FLAT_CTE} select app_id, event_date, hour, count(*) as n from flat_placed group by all")
def _(spark, sf):
    events, _ = flatten.undecodable_split(messages(spark, sf))
    placed = flatten.with_partition(flatten.flatten_raw(events))
    return placed.groupBy("app_id", "event_date", "hour").agg(F.count("*").alias("n"))


@register(
    "undecodable_split",
    f"with {MESSAGES_CTE} select {DECODABLE} as decodable, count(*) as n from messages group by 1",
)
def _(spark, sf):
    events, rejects = flatten.undecodable_split(messages(spark, sf))
    count = lambda rows, ok: rows.agg(F.count("*").alias("n")).select(F.lit(ok).alias("decodable"), "n")
    return count(events, True).unionByName(count(rejects, False))


@register(
    "landing_summary",
    f"with {FLAT_CTE} select app_id, event_date, hour, count(*) as rows, cast(sum(message_bytes) as bigint) as bytes "
    "from flat_placed group by 1, 2, 3",
)
def _(spark, sf):
    events, _ = flatten.undecodable_split(messages(spark, sf))
    sized = events.withColumn("message_bytes", F.octet_length("value"))
    return flatten.landing_summary(flatten.with_partition(flatten.flatten_raw(sized, "message_bytes")))


@register("land_raw", f"with {PLACED} select {RAW_TEXT}, event_date, hour from placed")
def _(spark, sf):
    root = scratch_path(spark, "land_raw")
    land_raw(partitioned_raw(raw_rows(spark, sf)), root)
    return scan_raw(spark, root)


@register("land_stream", FLAT_STORED)
def _(spark, sf):
    """The log landed by a stream in several micro-batches."""
    root = scratch_path(spark, "land_stream")
    log = stream_events(spark, message_files(spark, sf), max_files_per_trigger=4 * file_share(spark, sf))
    land_stream(log, f"{root}/raw", f"{root}/checkpoint", every_seconds=None).awaitTermination()
    return scan_raw(spark, f"{root}/raw")


@register("land_restart", FLAT_STORED)
def _(spark, sf):
    """The log landed by a stream that stops and starts again, with a batch landing of what came
    last into the same layer in between."""
    root = scratch_path(spark, "land_restart")
    at = lambda day: F.col("published_at") >= F.lit(day).cast("timestamp")
    rows, (middle, last) = messages(spark, sf), (at("2024-01-12"), at("2024-01-25"))

    def stream_on():
        log = stream_events(spark, f"{root}/log", max_files_per_trigger=8)
        land_stream(log, f"{root}/raw", f"{root}/checkpoint", every_seconds=None).awaitTermination()

    rows.where(~middle).write.mode("append").json(f"{root}/log")
    stream_on()
    late, _ = flatten.undecodable_split(rows.where(last))
    land_raw(partitioned_raw(flatten.flatten_raw(late)), f"{root}/raw")
    rows.where(middle & ~last).write.mode("append").json(f"{root}/log")
    for _ in range(2):
        stream_on()
    return scan_raw(spark, f"{root}/raw")


@register(
    "land_commit",
    f"with {MESSAGES_CTE} select value, stream from messages where not coalesce({DECODABLE}, false)",
)
def _(spark, sf):
    """Rejects set aside by a stream that is stopped, restarted and has nothing new to do."""
    root = scratch_path(spark, "land_commit")
    for _ in range(2):
        log = stream_events(spark, message_files(spark, sf))
        dead_letters_stream(log, f"{root}/rejects", f"{root}/checkpoint", every_seconds=None).awaitTermination()
    return spark.read.schema("value string, stream string").json(f"{root}/rejects")


@register("dedupe_window", DEDUPE_SQL)
def _(spark, sf):
    kept = dedupe_window(messages(spark, sf))
    return kept.select("app_id", "event_id", F.unix_timestamp("published_at").alias("second"))


@register("dedupe_stream", DEDUPE_SQL)
def _(spark, sf):
    """The same rule with recent keys carried over micro-batches that follow each other in time."""
    root = scratch_path(spark, "dedupe_stream")
    rows = messages(spark, sf).select("app_id", "event_id", "published_at", "sequence")
    for step, part in enumerate(("published_at < timestamp '2024-01-15'", "published_at >= timestamp '2024-01-15'")):
        rows.where(part).write.mode("append").parquet(f"{root}/log/part={step}")
        log = spark.readStream.schema(rows.schema).parquet(f"{root}/log/part=*")
        dedupe_stream(log, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    kept = read_kept(spark, f"{root}/out", rows.schema)
    return kept.select("app_id", "event_id", F.unix_timestamp("published_at").alias("second"))


@register("dedupe_stream_unordered", DEDUPE_SQL)
def _(spark, sf):
    """Out of order: each key's later resends come first, then the first messages of half the keys, then the others'."""
    root = scratch_path(spark, "dedupe_stream_unordered")
    rows = messages(spark, sf).select("app_id", "event_id", "published_at", "sequence")
    # Resends come after five minutes or three hours, so messages within a window of each other stay together.
    cut = F.pmod(F.xxhash64("app_id", "event_id"), F.lit(2)) == 0
    first = F.min("published_at").over(Window.partitionBy("app_id", "event_id"))
    late = F.unix_timestamp("published_at") - F.unix_timestamp(first) >= 3600
    rows = rows.withColumns({"_late": late, "_cut": cut}).withColumn("_part", F.when(F.col("_late"), 0).when(F.col("_cut"), 1).otherwise(2))
    for part in range(3):
        rows.where(F.col("_part") == part).select("app_id", "event_id", "published_at", "sequence").write.parquet(f"{root}/log/part={part}")
        log = spark.readStream.schema("app_id string, event_id string, published_at timestamp, sequence string").parquet(f"{root}/log/part=*")
        dedupe_stream(log, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    kept = read_kept(spark, f"{root}/out", log.schema)
    return kept.select("app_id", "event_id", F.unix_timestamp("published_at").alias("second"))


@register(
    "parse_iso",
    f"""with {RAW_CTE} select event_timestamp as text, strftime(try_cast(event_timestamp as timestamp), '%Y-%m-%d %H:%M:%S.%f') as parsed from raw
    union all select replace(substr(event_timestamp, 1, 10), '-', '') || 'T' || replace(substr(event_timestamp, 12, 8), ':', '') || 'Z',
      strftime(try_cast(substr(event_timestamp, 1, 19) as timestamp), '%Y-%m-%d %H:%M:%S.%f') from raw where event_timestamp <> 'bad-date'""",
)
def _(spark, sf):
    """Extended and compact spellings of every event time."""
    texts = raw_rows(spark, sf).select(F.col("event_timestamp").alias("text"))
    compact = texts.where("text <> 'bad-date'").select(
        F.concat(F.regexp_replace(F.substring("text", 1, 19), "[-:]", ""), F.lit("Z")).alias("text")
    )
    return texts.unionByName(compact).select("text", parse_iso(F.col("text")).alias("parsed"))


@register(
    "compact_json",
    r"""select 'd' || cast(doc_id as varchar) as id,
    '{"text":"' || list_aggregate(list_transform(regexp_extract_all(text, '(?s).'), lambda c: case
      when c = '"' then '\"' when c = '\' then '\\' when unicode(c) = 10 then '\n' when unicode(c) = 13 then '\r'
      when unicode(c) = 9 then '\t' when unicode(c) = 8 then '\b' when unicode(c) = 12 then '\f'
      when unicode(c) between 32 and 126 then c
      when unicode(c) = 127 then c
      when unicode(c) < 65536 then printf('\u%04x', unicode(c))
      else printf('\u%04x\u%04x', 55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024) end),
      'string_agg', '') || '"}' as compact from documents""",
)
def _(spark, sf):
    """A document's whole text as JSON, re-spelled in ASCII."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spaced = F.concat(
        F.lit('{ "ignored" : 1, "text" : { "text" : '),
        F.regexp_replace(F.to_json(F.struct("text")), r'^\{"text":(.*)\}$', "$1"),
        F.lit(" } }"),
    )
    return docs.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        compact_json(F.get_json_object(spaced, "$.text")).alias("compact"),
    )


@register(
    "int_or_zero",
    f"with {MESSAGES_CTE} select sequence, coalesce(try_cast(sequence as bigint), 0) as number from messages",
)
def _(spark, sf):
    return messages(spark, sf).select("sequence", int_or_zero(F.col("sequence")).alias("number"))
