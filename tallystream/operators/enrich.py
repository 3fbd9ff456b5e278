"""From an accepted batch to stream messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.identity import ip_hash, message_id, route_subject
from tallystream.functions.network import client_ip
from tallystream.functions.times import client_time_text, iso_offset_text
from tallystream.operators.geo import Networks, with_country
from tallystream.operators.requests import FALSE_WORDS, TRUE_WORDS, explode_events
from tallystream.schemas import CONTEXTS, OPEN_MAPS

# One read of an event; the open maps and all scalars stay text.
_EVENT = ", ".join(
    [f"{name} string" for name in ("event_id", "app_id", "environment", "event_name")]
    + [f"{name} string" for name in ("event_timestamp", "received_at", *OPEN_MAPS)]
    + [f"{name} struct<{', '.join(f'{m}: string' for m in members)}>" for name, members in CONTEXTS.items()]
)


def with_client(requests: DataFrame, salt: str) -> DataFrame:
    """Add client_ip ('' when unknown) and client_ip_hash (NULL when unknown)."""
    return requests.withColumn(
        "client_ip", client_ip(F.col("forwarded_for"), F.col("real_ip"), F.col("peer_ip"))
    ).withColumn("client_ip_hash", F.when(F.col("client_ip") != "", ip_hash(F.col("client_ip"), salt)))


def _json(**members: Column) -> Column:
    """An object with all its members, absent ones null."""
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in members.items()]), {"ignoreNullFields": "false"}
    )


def _extended(json: Column, *members: tuple[str, Column]) -> Column:
    """`json` with (name, JSON text) members added at its end; NULL ones are left out."""
    added = [F.coalesce(F.concat(F.lit(f',"{name}":'), value), F.lit("")) for name, value in members]
    return F.concat(F.substr(json, F.lit(1), F.length(json) - 1), *added, F.lit("}"))


def _flag(text: Column) -> Column:
    word, number = F.lower(text), text.try_cast("double")
    return F.when(word.isin(TRUE_WORDS) | (number == 1.0), True).when(
        word.isin(FALSE_WORDS) | (number == 0.0), False
    )


def geo_json(client: Column, name: Column, code: Column) -> Column:
    """The lookup overrides country and country_code and nothing else.

    Without a client geo the result holds only what the lookup found; with neither
    it is NULL.
    """
    merged = _json(
        country=F.coalesce(name, client["country"]),
        country_code=F.coalesce(code, client["country_code"]),
        city=client["city"],
        region=client["region"],
        timezone=client["timezone"],
    )
    found = F.to_json(F.struct(name.alias("country"), code.alias("country_code")))
    return F.when(client.isNotNull(), merged).when(name.isNotNull() | code.isNotNull(), found)


def ingest_json(client: Column, store_raw_ip: bool = False) -> Column:
    """Server-side ingest facts, used only when the client sent no ingest object at all."""
    sent = _json(
        **{
            m: client_time_text(client[m]) if m == "received_at" else client[m]
            for m in CONTEXTS["ingest"]
        }
    )
    # A hash and a checked address need no JSON escaping.
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    address = [("ip_hash", quoted(F.col("client_ip_hash")))]
    if store_raw_ip:
        address.append(("ip", quoted(F.nullif(F.col("client_ip"), F.lit("")))))
    server = _extended(
        _json(
            received_at=iso_offset_text(F.col("received_at")),
            request_id=F.col("request_id"),
            user_agent=F.col("user_agent"),
        ),
        *address,
    )
    return F.when(client.isNotNull(), sent).otherwise(server)


def to_messages(
    accepted: DataFrame,
    ranges: DataFrame | Networks | None,
    salt: str,
    prefix: str = "events",
    store_raw_ip: bool = False,
    requests: DataFrame | None = None,
) -> DataFrame:
    """One row per event: subject, message_id, app_id, event_id, published_at, value.

    Address parsing, hashing and the country lookup run once per request, before
    the events are exploded; each event is parsed once. `requests`, if given, are those that the
    accepted ones come from: the lookup takes the addresses from there, so that no request is judged
    a second time for its address.
    """
    addresses = None if requests is None else with_client(requests, salt).select("client_ip")
    requests = with_client(accepted, salt)
    if ranges is None:
        requests = requests.withColumns(
            {"geo_name": F.lit(None).cast("string"), "geo_code": F.lit(None).cast("string")}
        )
    else:
        requests = with_country(requests, ranges, addresses=addresses)
    events = explode_events(requests).withColumn("e", F.from_json("event", _EVENT))
    e = lambda path: F.col(f"e.{path}")
    consent = F.when(
        e("consent").isNotNull(),
        F.struct(*[_flag(e(f"consent.{m}")).alias(m) for m in CONTEXTS["consent"]]),
    )
    envelope = _json(
        event_id=e("event_id"),
        app_id=e("app_id"),
        environment=e("environment"),
        event_name=e("event_name"),
        event_timestamp=client_time_text(e("event_timestamp")),
        received_at=client_time_text(e("received_at")),
        user=e("user"),
        device=e("device"),
        traffic_source=e("traffic_source"),
        consent=consent,
    )
    value = _extended(
        envelope,
        ("geo", F.coalesce(geo_json(e("geo"), F.col("geo_name"), F.col("geo_code")), F.lit("null"))),
        *[(name, F.coalesce(e(name), F.lit("{}"))) for name in OPEN_MAPS],
        ("ingest", ingest_json(e("ingest"), store_raw_ip)),
    )
    return events.select(
        "request_id",
        "position",
        e("app_id").alias("app_id"),
        e("event_id").alias("event_id"),
        route_subject(prefix, e("app_id")).alias("subject"),
        message_id(e("app_id"), e("event_id")).alias("message_id"),
        F.col("received_at").alias("published_at"),
        value.alias("value"),
    )
