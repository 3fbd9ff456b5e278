"""Judging request batches.

A request is one row: request_id, received_at, api_key, forwarded_for, real_ip,
peer_ip, user_agent, body. Its events stay together as an array until the batch
has been judged, so "one bad event rejects the batch" needs no shuffle; the size
limit on the body bounds the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.json_text import kind
from tallystream.functions.times import client_time_ok
from tallystream.schemas import (
    CONTEXTS,
    MAX_EVENTS_PER_REQUEST,
    MAX_REQUEST_BYTES,
    OPEN_MAPS,
    REQUIRED_TEXT,
)

# --- fixed values: words a client may use for true and false, JSON kinds -----------
TRUE_WORDS = ["1", "true", "t", "yes", "y", "on"]
FALSE_WORDS = ["0", "false", "f", "no", "n", "off"]
# A list of objects, or one that is empty or holds nothing but nulls.
EVENT_LIST_KIND = "^ARRAY<(OBJECT|VOID)"
NUMBER_KINDS = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
# --- end of fixed values ------------------------------------------------------------


def _let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`."""
    return F.transform(F.array(value), body)[0]


def _wrong_time(kind_: Column, text: Column) -> Column:
    return ~(((kind_ == "STRING") | kind_.rlike(NUMBER_KINDS)) & client_time_ok(text))


def _wrong_flag(kind_: Column, text: Column) -> Column:
    word = F.lower(text)
    return ~(
        (kind_ == "BOOLEAN")
        | ((kind_ == "STRING") & word.isin(TRUE_WORDS + FALSE_WORDS))
        | (kind_.rlike(NUMBER_KINDS) & F.coalesce(word.try_cast("double").isin(0.0, 1.0), F.lit(False)))
    )


def _members() -> list[tuple[str, str, bool, bool]]:
    """(path, rule, must be present, may be null) in the order they are judged."""
    rules = [(name, "text", True, False) for name in REQUIRED_TEXT]
    rules += [("event_timestamp", "time", True, False)]
    rules += [("environment", "text", False, True), ("received_at", "time", False, True)]
    rules += [(name, "object", False, True) for name in CONTEXTS]
    for context, members in CONTEXTS.items():
        for member in members:
            rule = "flag" if context == "consent" else "time" if member == "received_at" else "text"
            rules.append((f"{context}.{member}", rule, False, True))
    return rules + [(name, "object", False, False) for name in OPEN_MAPS]


# One pass over an event lays its members out; what is no object has no members here. An open map
# is there if it is an object, whatever it holds.
_LAID_OUT = "struct<{}>".format(
    ", ".join(
        [f"{path}: variant" for path, rule, _, _ in _members() if rule != "object" and "." not in path]
        + [f"{name}: struct<{', '.join(f'{m}: variant' for m in members)}>" for name, members in CONTEXTS.items()]
        + [f"{name}: struct<{name}: variant>" for name in OPEN_MAPS]
    )
)


def envelope_problem(event_json: Column) -> Column:
    """First offending field of an event, NULL when the event is acceptable.

    Text fields must be JSON strings (a number is refused, not converted); times
    may be ISO text or epoch numbers; flags may be true/false or the usual words
    for them; contexts may be null, the two open maps may only be left out.
    Unknown fields are ignored.

    The members are judged as an array by one expression, which keeps the plan small: a
    stream plans it for each micro-batch.
    """
    paths, rules, required, nullable = (F.lit(list(column)) for column in zip(*_members()))

    def value(v: Column, laid: Column, path: str, rule: str) -> Column:
        found = laid
        for name in path.split("."):
            found = found[name]
        # Looked up only where the layout shows no object: left out, null, or something else.
        return F.when(found.isNull(), F.try_variant_get(v, f"$.{path}", "variant")) if rule == "object" else found

    def wrong(value: Column, i: Column) -> Column:
        of_kind = lambda k: (
            F.when(k == "VOID", ~nullable[i])
            .when(rules[i] == "text", k != "STRING")
            .when(rules[i] == "object", True)
            .otherwise(
                _let(
                    F.try_variant_get(value, "$", "string"),
                    lambda text: F.when(rules[i] == "time", _wrong_time(k, text)).otherwise(_wrong_flag(k, text)),
                )
            )
        )
        judged = F.coalesce(_let(F.schema_of_variant(value), of_kind), F.lit(True))
        return F.when(value.isNull(), required[i]).otherwise(judged)

    def judge(v: Column) -> Column:
        def verdict(laid: Column) -> Column:
            values = F.array(*[value(v, laid, path, rule) for path, rule, _, _ in _members()])
            found = F.filter(F.transform(values, lambda x, i: F.when(wrong(x, i), paths[i])), lambda p: p.isNotNull())
            return F.when(laid.isNull(), "event").otherwise(F.try_element_at(found, F.lit(1)))

        return _let(F.try_variant_get(v, "$", _LAID_OUT), verdict)

    return _let(F.try_parse_json(event_json), judge)


def auth_reason(api_key: Column, allowed_app: Column, app_id: Column) -> Column:
    """Why this key may not send this app's events; NULL when it may."""
    return (
        F.when(F.coalesce(api_key, F.lit("")) == "", "auth_missing_key")
        .when(F.coalesce(allowed_app, F.lit("")) == "", "auth_invalid_key")
        .when(~F.coalesce(allowed_app == app_id, F.lit(False)), "auth_app_mismatch")
    )


def split_events(requests: DataFrame, max_bytes: int = MAX_REQUEST_BYTES) -> DataFrame:
    """Add request_bytes, events (each event's JSON text) and readable.

    A body over the limit is never parsed.
    """
    body = F.when(F.octet_length("body") <= max_bytes, F.col("body"))
    # Kind of the events member: NULL when absent, "unreadable" when the body is no object.
    listed = _let(
        F.try_parse_json(body),
        lambda root: F.when(root.isNull() | ~F.ltrim(body).startswith("{"), "unreadable").otherwise(
            kind(root, "$.events")
        ),
    )
    staged = requests.withColumns({"request_bytes": F.octet_length("body"), "_listed": listed})
    listed = F.col("_listed")
    readable = listed.isNull() | listed.rlike(EVENT_LIST_KIND)
    events = F.when(listed.isNull(), F.array().cast("array<string>")).otherwise(
        F.from_json(body, "events array<string>")["events"]
    )
    return staged.withColumns({"events": F.when(readable, events), "readable": readable}).drop("_listed")


def with_allowed_app(requests: DataFrame, keys: DataFrame) -> DataFrame:
    """Left lookup api_key -> allowed_app. `keys` has columns api_key, app_id; of a key
    listed more than once the first app by name counts."""
    lookup = keys.groupBy("api_key").agg(F.min("app_id").alias("allowed_app"))
    return requests.join(lookup, "api_key", "left")


def judge_requests(
    requests: DataFrame,
    keys: DataFrame,
    max_bytes: int = MAX_REQUEST_BYTES,
    max_events: int = MAX_EVENTS_PER_REQUEST,
) -> DataFrame:
    """One row per request with `reason`, NULL for an accepted batch.

    Checks run in the order size, validity, emptiness, count, key; the first
    failure names the batch.
    """
    judged = with_allowed_app(split_events(requests, max_bytes), keys)
    broken = F.exists("events", lambda e: envelope_problem(e).isNotNull())
    sizes = batch_limit_reason(
        F.col("request_bytes"),
        ~F.col("readable") | F.coalesce(broken, F.lit(True)),
        F.size("events"),
        max_bytes,
        max_events,
    )
    refusals = F.transform(
        "events",
        lambda e: auth_reason(F.col("api_key"), F.col("allowed_app"), F.get_json_object(e, "$.app_id")),
    )
    first_refusal = F.try_element_at(F.filter(refusals, lambda r: r.isNotNull()), F.lit(1))
    return judged.withColumn("reason", F.coalesce(sizes, first_refusal))


def batch_limit_reason(
    request_bytes: Column,
    invalid: Column,
    events: Column,
    max_bytes: int = MAX_REQUEST_BYTES,
    max_events: int = MAX_EVENTS_PER_REQUEST,
) -> Column:
    return (
        F.when(request_bytes > max_bytes, "request_too_large")
        .when(invalid, "validation_error")
        .when(events == 0, "empty_events")
        .when(events > max_events, "events_limit_exceeded")
    )


def accepted_batches(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull())


def rejected_batches(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull())


def explode_events(judged: DataFrame) -> DataFrame:
    """One row per event: its request's columns, position and JSON text.

    The outer form with a filter after it, since for the plain form the optimizer
    adds a size check below, which would parse every body once more.
    """
    kept = [c for c in judged.columns if c not in ("events", "body", "readable")]
    return judged.select(*kept, F.posexplode_outer("events").alias("position", "event")).where(
        F.col("position").isNotNull()
    )


def batch_summary(judged: DataFrame) -> DataFrame:
    """Accepted batches: events, distinct apps, bytes. One row in, one row out."""
    apps = F.array_distinct(F.transform("events", lambda e: F.get_json_object(e, "$.app_id")))
    return accepted_batches(judged).select(
        "request_id",
        F.size("events").alias("accepted_events"),
        F.size(apps).alias("distinct_app_ids"),
        "request_bytes",
    )


def reject_summary(judged: DataFrame) -> DataFrame:
    return rejected_batches(judged).groupBy("reason").agg(F.count("*").alias("batches"))
