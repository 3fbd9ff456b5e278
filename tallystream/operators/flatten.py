"""Stream message -> raw row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.json_text import compact_json, int_or_zero, is_object, kind
from tallystream.functions.times import partition_date, partition_hour, partition_instant
from tallystream.schemas import CONTEXTS, RAW_COLUMNS

_TOP = [
    "event_id", "app_id", "environment", "event_name", "event_timestamp", "received_at",
    "user", "device", "event_params", "user_properties", "traffic_source", "geo", "consent",
    "ingest",
]


def decodable(value: Column) -> Column:
    """True for a JSON object; such messages can become rows."""
    return is_object(value)


def undecodable_split(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages that are events, messages to set aside for good)."""
    ok = decodable(F.col("value"))
    return messages.where(ok), messages.where(~ok)


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def flatten_raw(messages: DataFrame, *keep: str) -> DataFrame:
    """The 25 raw columns from `value`, `stream`, `sequence`; `keep` passes more through.

    json_tuple reads all top-level members in one pass over the text.
    """
    tops = messages.select(
        "value", "stream", "sequence", *keep, F.json_tuple("value", *_TOP).alias(*[f"m_{t}" for t in _TOP])
    )
    m = lambda name: F.col(f"m_{name}")

    def said(name: str) -> Column:
        """Text of a scalar; a bare JSON true/false is spelled True/False."""
        flag = m(name).isin("true", "false") & (
            kind(F.try_parse_json(F.col("value")), f"$.{name}") == "BOOLEAN"
        )
        return F.when(flag, F.initcap(m(name))).otherwise(m(name))

    inner = {
        context: F.from_json(m(context), ", ".join(f"{x} string" for x in CONTEXTS[context]))
        for context in ("user", "device", "ingest")
    }
    staged = tops.withColumns({f"c_{context}": column for context, column in inner.items()})

    def c(context: str, member: str) -> Column:
        """Text of a member, bare booleans spelled as above; parsed again only where it may be one."""
        text = F.col(f"c_{context}.{member}")
        flag = text.isin("true", "false") & (kind(F.try_parse_json(m(context)), f"$.{member}") == "BOOLEAN")
        return F.when(flag, F.initcap(text)).otherwise(text)

    columns = {
        "event_id": said("event_id"),
        "app_id": F.coalesce(_filled(said("app_id")), F.lit("unknown_app")),
        "environment": said("environment"),
        "event_name": said("event_name"),
        "event_timestamp": said("event_timestamp"),
        "received_at": F.coalesce(_filled(m("received_at")), c("ingest", "received_at")),
        **{name: c("user", name) for name in CONTEXTS["user"]},
        **{name: c("device", name) for name in CONTEXTS["device"]},
        **{
            f"{name}_json": compact_json(m(name))
            for name in ("event_params", "user_properties", "traffic_source", "geo", "consent")
        },
        "ingest_request_id": c("ingest", "request_id"),
        "ingest_user_agent": c("ingest", "user_agent"),
        "ingest_ip_hash": c("ingest", "ip_hash"),
        "nats_stream": F.col("stream"),
        "nats_sequence": int_or_zero(F.col("sequence")),
    }
    return staged.select(*keep, *[columns[name].alias(name) for name in RAW_COLUMNS])


def with_partition(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Add event_date and hour as text: event time, else receive time, else `now`."""
    instant = partition_instant(F.col("event_timestamp"), F.col("received_at"), now)
    return (
        rows.withColumn("_at", instant)
        .withColumns({"event_date": partition_date(F.col("_at")), "hour": partition_hour(F.col("_at"))})
        .drop("_at")
    )


def landing_summary(rows: DataFrame, message_bytes: str = "message_bytes") -> DataFrame:
    """Rows and message bytes per landing partition. Needs app_id, event_date, hour."""
    return rows.groupBy("app_id", "event_date", "hour").agg(
        F.count("*").alias("rows"), F.sum(message_bytes).alias("bytes")
    )
