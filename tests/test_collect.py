from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallystream.session import scratch_path
from tallystream.operators import enrich, flatten, geo
from tallystream.operators import requests as ops
from tallystream.plans.collect import collect_messages, messages_to_raw
from tallystream.schemas import RAW_COLUMNS, RAW_SCHEMA

EVENT = {"event_id": "1", "app_id": "a", "event_name": "n", "event_timestamp": "2026-03-20T18:42:15.123Z"}


def test_envelope(evaluate):
    cases = [
        ({}, None),
        ({"event_id": 1}, "event_id"),
        ({"app_id": None}, "app_id"),
        ({"event_name": ...}, "event_name"),
        ({"event_timestamp": "soon"}, "event_timestamp"),
        ({"event_timestamp": 1704067200}, None),
        ({"event_timestamp": True}, "event_timestamp"),
        ({"environment": None}, None),
        ({"environment": 5}, "environment"),
        ({"received_at": "x"}, "received_at"),
        ({"user": None}, None),
        ({"user": []}, "user"),
        ({"user": {"user_id": 5}}, "user.user_id"),
        ({"consent": {"ads_storage": "yes", "personalization": 1}}, None),
        ({"consent": {"ads_storage": "maybe"}}, "consent.ads_storage"),
        ({"ingest": {"received_at": "never"}}, "ingest.received_at"),
        ({"event_params": None}, "event_params"),
        ({"event_params": {"any": [1, {"x": None}]}}, None),
        ({"user_properties": "x"}, "user_properties"),
        ({"unknown": {"x": 1}}, None),
        ({"app_id": {"app_id": "a"}}, "app_id"),
        ({"event_timestamp": "2026-03-20T25:00:00Z"}, "event_timestamp"),
        ({"event_timestamp": ["2026-03-20"]}, "event_timestamp"),
        ({"received_at": None, "geo": {}, "ingest": {"received_at": None}}, None),
        ({"device": "phone", "geo": {"city": 1}}, "device"),
        ({"geo": {"city": {"x": 1}}}, "geo.city"),
        ({"consent": {"ads_storage": []}}, "consent.ads_storage"),
        ({"event_params": {}}, None),
        ({"event_params": []}, "event_params"),
        ({"event_params": {"event_params": 5}}, None),
    ]
    events = [{k: v for k, v in {**EVENT, **change}.items() if v is not ...} for change, _ in cases]
    got = evaluate([json.dumps(event) for event in events], ops.envelope_problem)
    assert [(change, problem) for (change, _), problem in zip(cases, got, strict=True)] == cases


def test_not_an_event(evaluate):
    assert evaluate(["5", "nope", "[]", None], ops.envelope_problem) == ["event"] * 4


def request(spark, *bodies, **headers):
    row = {"received_at": datetime(2026, 3, 20, 19), "api_key": "k", "forwarded_for": "203.0.113.8",
           "real_ip": None, "peer_ip": "10.0.0.1", "user_agent": "ua", **headers}
    rows = [(f"r{i}", *row.values(), body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(
        rows, "request_id string, received_at timestamp, api_key string, forwarded_for string, "
              "real_ip string, peer_ip string, user_agent string, body string",
    )


def body(*events):
    return json.dumps({"events": list(events)})


@pytest.fixture
def keys(spark):
    return spark.createDataFrame([("k", "a"), ("blank", "")], "api_key string, app_id string")


@pytest.fixture
def ranges(spark):
    return spark.createDataFrame(
        [("203.0.113.0", "203.0.113.255", (" Finland", "fi"), None, None),
         ("198.51.100.0", "198.51.100.255", None, "Sweden ", "se"),
         ("32.0.0.0", "35.255.255.255", ("Wide", None), "", ""),
         ("2001:db8:7::", "2001:db8:7:ffff:ffff:ffff:ffff:ffff", ("Six", "sx"), None, None)],
        "lo_ip string, hi_ip string, country struct<name: string, iso_code: string>, "
        "country_name string, country_code string",
    )


def test_reasons_come_in_order(spark, keys):
    bodies = [
        "x" * 400, "{", "[]", '{"events":null}', json.dumps({"events": [json.dumps(EVENT)]}),
        json.dumps({"events": [EVENT, 5]}), json.dumps({"events": [EVENT, None]}), "{}", body(), body(EVENT, EVENT, EVENT), body(EVENT, {**EVENT, "event_id": 1}),
        body(EVENT, {**EVENT, "app_id": "b"}), body(EVENT),
    ]
    judged = ops.judge_requests(request(spark, *bodies), keys, max_bytes=399, max_events=2)
    got = {r["request_id"]: r["reason"] for r in judged.collect()}
    assert [got[f"r{i}"] for i in range(len(bodies))] == [
        "request_too_large", *["validation_error"] * 6, "empty_events",
        "empty_events", "events_limit_exceeded", "validation_error", "auth_app_mismatch", None,
    ]
    for key, reason in [(None, "auth_missing_key"), ("", "auth_missing_key"), ("z", "auth_invalid_key"), ("blank", "auth_invalid_key")]:
        row = ops.judge_requests(request(spark, body(EVENT), api_key=key), keys).first()
        assert row["reason"] == reason


def test_country_lookup(spark, ranges):
    ips = spark.createDataFrame(
        [("203.0.113.8",), ("198.51.100.4",), ("33.1.2.3",), ("2001:db8:7::1",), ("9.9.9.9",), ("",), (None,)],
        "client_ip string",
    )
    got = {r[0]: (r[1], r[2]) for r in geo.with_country(ips, ranges).collect()}
    assert got == {
        "203.0.113.8": ("Finland", "FI"), "198.51.100.4": ("Sweden", "SE"), "33.1.2.3": ("Wide", None),
        "2001:db8:7::1": ("Six", "SX"), "9.9.9.9": (None, None), "": (None, None), None: (None, None),
    }


def messages(spark, keys, ranges, event, **headers):
    out = collect_messages(request(spark, body(event), **headers), keys, ranges, "salt")
    return json.loads(out.first()["value"])


def test_lookup_overrides_only_country_fields(spark, keys, ranges):
    event = {**EVENT, "geo": {"country": "Wrong", "country_code": "WR", "city": "Oulu"}}
    got = messages(spark, keys, ranges, event)
    assert got["geo"] == {"country": "Finland", "country_code": "FI", "city": "Oulu", "region": None, "timezone": None}
    assert got["ingest"]["request_id"] == "r0"
    assert messages(spark, keys, ranges, EVENT)["geo"] == {"country": "Finland", "country_code": "FI"}


def test_no_match_or_no_address_leaves_geo_alone(spark, keys, ranges):
    assert messages(spark, keys, ranges, EVENT, forwarded_for="9.9.9.9")["geo"] is None
    got = messages(spark, keys, ranges, EVENT, forwarded_for=None, peer_ip=None)
    assert got["geo"] is None and "ip_hash" not in got["ingest"]


def test_any_client_ingest_object_wins(spark, keys, ranges):
    got = messages(spark, keys, ranges, {**EVENT, "ingest": {}})
    assert got["ingest"] == dict.fromkeys(["user_agent", "ip_hash", "ip", "received_at", "request_id"])


def test_collected_event_as_raw_row(spark, keys):
    event = {**EVENT, "event_params": {"level": 3, "é": [1, "x y"]}, "user": {"user_pseudo_id": 'p"q'}}
    out = collect_messages(request(spark, body(event)), keys, None, "salt", store_raw_ip=True)
    row = messages_to_raw(out).first()
    assert row["event_timestamp"] == "2026-03-20T18:42:15.123000Z"
    assert row["received_at"] == "2026-03-20T19:00:00+00:00"
    assert row["event_params_json"] == json.dumps(event["event_params"], separators=(",", ":"), ensure_ascii=True)
    assert row["user_pseudo_id"] == 'p"q' and row["geo_json"] == "{}" and row["user_properties_json"] == "{}"
    assert json.loads(out.first()["value"])["ingest"]["ip"] == "203.0.113.8"


def flat(spark, event, stream="EVENTS", sequence="12345"):
    rows = spark.createDataFrame([(json.dumps(event), stream, sequence)], "value string, stream string, sequence string")
    return flatten.with_partition(flatten.flatten_raw(rows)).first()


def test_flatten_normalises_types(spark):
    row = flat(spark, {
        "event_id": 55, "app_id": "org.sample.maps", "environment": False, "event_name": 3.5,
        "event_timestamp": "2025-11-02T23:59:59Z", "received_at": "2025-11-03T00:00:02Z",
        "user": {"user_id": True, "user_pseudo_id": "true", "session_id": 0},
        "device": {"platform": "tv", "locale": False}, "event_params": {"list": [True, None]}, "consent": None,
        "ingest": {"request_id": 4, "ip_hash": "ff"},
    })
    assert (row["app_id"], row["event_date"], row["hour"]) == ("org.sample.maps", "2025-11-02", "23")
    assert (row["event_id"], row["environment"], row["event_name"]) == ("55", "False", "3.5")
    # A bare boolean is spelled as at the top level; a text that reads like one stays.
    assert (row["user_id"], row["user_pseudo_id"], row["session_id"], row["locale"]) == ("True", "true", "0", "False")
    assert (row["ingest_request_id"], row["nats_stream"], row["nats_sequence"]) == ("4", "EVENTS", 12345)
    assert (row["event_params_json"], row["consent_json"]) == ('{"list":[true,null]}', "{}")


def test_flatten_missing_parts(spark):
    row = flat(spark, {"event_id": "e", "event_timestamp": "x", "received_at": "", "app_id": "",
                       "ingest": {"received_at": "2026-04-13T11:00:00Z"}}, None, str(2**70))
    assert row["app_id"] == "unknown_app" and row["environment"] is None and row["user_id"] is None
    assert row["nats_stream"] is None and row["nats_sequence"] == 0 and row["hour"] == "11"


def test_flatten_schema_is_the_contract(spark):
    rows = spark.createDataFrame([("{}", None, None)], "value string, stream string, sequence string")
    got = flatten.flatten_raw(rows)
    assert got.columns == RAW_COLUMNS
    assert [f.dataType for f in got.schema] == [f.dataType for f in RAW_SCHEMA]


def test_a_repeated_key_does_not_double_batches(spark):
    twice = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "a")], "api_key string, app_id string")
    rows = ops.with_allowed_app(spark.createDataFrame([("r", "k"), ("s", "x")], "request_id string, api_key string"), twice)
    assert sorted(map(tuple, rows.select("request_id", "allowed_app").collect())) == [("r", "a"), ("s", None)]


def test_network_blocks_cover_their_range_and_nothing_else(spark):
    import random

    draw, rows = random.Random(3), []
    for i in range(120):
        size = draw.choice([1, 2, 40, 300, 5000, 65536])
        lo = draw.randrange(2**20 - size)
        rows.append((i, f"{lo:032x}", f"{lo + draw.randrange(size):032x}"))
    rows += [(900, "0" * 32, "f" * 32), (901, "1" * 32, "1" * 32), (902, "a" + "0" * 31, "b" + "f" * 31), (903, "5" * 32, "4" * 32)]
    df = spark.createDataFrame(rows, "i int, lo string, hi string").withColumn("blocks", geo.network_blocks(F.col("lo"), F.col("hi")))
    for row in df.collect():
        lo, hi = int(row.lo, 16), int(row.hi, 16)
        if lo > hi:
            assert row.blocks is None
            continue
        ends = sorted((int((p + "0" * 32)[:32], 16), int((p + "f" * 32)[:32], 16)) for p in row.blocks)
        assert ends[0][0] == lo and ends[-1][1] == hi
        assert all(a[1] + 1 == b[0] for a, b in zip(ends, ends[1:]))
    assert [len(r.blocks) for r in df.where("i in (900, 901, 902)").orderBy("i").collect()] == [1, 1, 2]


def test_lookup_of_wide_nested_and_neighbouring_ranges(spark):
    country = lambda n: (None, n, n[:2].lower())
    schema = "lo_ip string, hi_ip string, country struct<name:string,iso_code:string>, country_name string, country_code string"
    table = spark.createDataFrame([
        ("10.0.0.0", "13.255.255.255", *country("Wide")), ("11.1.2.3", "11.1.2.3", *country("Inner")),
        ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", *country("Provider")),
        *[(f"2001:dc8:{i:x}::", f"2001:dc8:{i:x}:ffff:ffff:ffff:ffff:ffff", *country(f"C{i}")) for i in range(300)],
    ], schema)
    asked = {"12.4.5.6": "Wide", "11.1.2.3": "Inner", "14.0.0.0": None, "2001:db8:5::1": "Provider", "2001:dc8:12b::9": "C299",
             "2001:dc8:12c::9": None, None: None, "nonsense": None}
    ips = spark.createDataFrame([(k,) for k in asked], "client_ip string")
    found = geo.with_country(ips, table)
    assert {r.client_ip: r.geo_name for r in found.collect()} == asked
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(sign in line for line in joins for sign in (" >= ", " <= ", " < ", " > "))


def test_only_prefixes_that_blocks_have_are_asked_for(spark):
    table = spark.createDataFrame(
        [("10.0.0.0", "10.255.255.255", None, "Ten", "te"), ("10.1.2.0", "10.1.2.255", None, "Inner", "in"), ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", None, "Six", "si")],
        "lo_ip string, hi_ip string, country struct<name:string,iso_code:string>, country_name string, country_code string")
    networks = geo.keep_networks(table, scratch_path(spark, "networks"))
    assert networks.lengths == [8, 26, 30]
    ips = spark.createDataFrame([("10.1.2.3",), ("10.9.9.9",), ("11.0.0.1",), ("2001:db8::1",), ("x",), (None,)], "client_ip string")
    got = {r.client_ip: r.geo_name for r in geo.with_country(ips, networks).collect()}
    assert got == {"10.1.2.3": "Inner", "10.9.9.9": "Ten", "11.0.0.1": None, "2001:db8::1": "Six", "x": None, None: None}
    none = geo.keep_networks(table.where("false"), scratch_path(spark, "networks"))
    assert none.lengths == [] and geo.with_country(ips, none).where("geo_name is not null").count() == 0
