from __future__ import annotations

import ipaddress
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tallystream.functions import identity, json_text, network, times


def test_parse_iso_matches_the_standard_reading(evaluate):
    good = [
        "2026-03-16T18:42:15.123Z", "2026-03-16 18:42:15", "2026-03-16T18:42", "2026-03-16",
        "2026-03-16T18:42:15+02:00", "2026-03-16T18:42:15-0530", "20260316T184215Z", "20260316",
        "2026-03-16T18:42:15.123456+00:00", " 2026-03-16T18:42:15Z ", "2026-03-16T18",
    ]

    def expected(text):
        parsed = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
        parsed = parsed if parsed.tzinfo else parsed.replace(tzinfo=UTC)
        return int(parsed.timestamp() * 1_000_000)

    got = evaluate(good, lambda v: F.unix_micros(times.parse_iso(v)))
    assert got == [expected(t) for t in good]
    bad = ["bad-date", "", "2026", "T12:00", "2026-13-01", "2026-02-30T00:00:00Z", "1710614535", None]
    assert evaluate(bad, times.parse_iso) == [None] * len(bad)


def test_best_effort_takes_epoch_seconds_and_cuts_to_milliseconds(evaluate):
    texts = ["1704067200", "2024-01-01T00:00:00.123999Z", "123", "nope", None]
    got = evaluate(texts, lambda v: F.unix_micros(times.parse_best_effort_ms(v)))
    assert got == [1704067200_000000, 1704067200_123000, None, None, None]


def test_strict_offset_needs_a_numeric_offset(evaluate):
    texts = ["2024-01-01T00:00:00+00:00", "2024-01-01T02:00:00.5+02:00", "2024-01-01T00:00:00Z",
             "2024-01-01T00:00:00", "2024-01-01 00:00:00+00:00"]
    got = evaluate(texts, lambda v: F.unix_micros(times.parse_strict_offset(v)))
    assert got == [1704067200_000000, 1704067200_500000, None, None, None]


def test_partition_uses_event_time_then_receive_time(spark):
    rows = spark.createDataFrame(
        [("2026-03-16T18:42:15.123Z", "2026-03-16T20:00:00Z"), ("bad-date", "2026-03-16T20:00:00Z"), ("x", None)],
        "a string, b string",
    )
    at = times.partition_instant(F.col("a"), F.col("b"), F.lit("2030-01-02T03:00:00Z").cast("timestamp"))
    got = [tuple(r) for r in rows.select(times.partition_date(at), times.partition_hour(at)).collect()]
    assert got == [("2026-03-16", "18"), ("2026-03-16", "20"), ("2030-01-02", "03")]


def test_client_times_are_spelled_one_way(evaluate):
    spelled = {
        "2026-03-20T18:42:15.123Z": "2026-03-20T18:42:15.123000Z",
        "2026-03-20T18:42:15Z": "2026-03-20T18:42:15Z",
        "2026-03-20T18:42:15.000Z": "2026-03-20T18:42:15Z",
        "2026-03-20T18:42:15.1234567Z": "2026-03-20T18:42:15.123456Z",
        "2026-03-20t18:42z": "2026-03-20T18:42:00Z",
        "2026-03-20 18:42:15.5+0200": "2026-03-20T18:42:15.500000+02:00",
        "2026-03-20T18:42:15+00:00": "2026-03-20T18:42:15Z",
        "2026-03-20T18:42:15.000000": "2026-03-20T18:42:15",
        "2026-03-20": "2026-03-20T00:00:00",
        "1704067200": "2024-01-01T00:00:00Z",
        "1704067200123": "2024-01-01T00:00:00.123000Z",
    }
    assert evaluate(list(spelled), times.client_time_text) == list(spelled.values())
    assert all(evaluate(list(spelled), times.client_time_ok))
    assert not any(evaluate(["yesterday", "", "2026-02-30T00:00:00Z", "2026-03-20T25:00:00Z"], times.client_time_ok))


def test_ascii_json_equals_the_standard_dump(evaluate):
    values = [{"a": "é😀x"}, {"b": "tab\tquote\"back\\slash"}, {"c": "\u001f/\\u00E9"}, {"日本": ["語", 1, None]}, {}]
    texts = [json.dumps(v, ensure_ascii=False) for v in values]
    got = evaluate(texts, lambda v: json_text.compact_json(F.get_json_object(v, "$")))
    assert got == [json.dumps(v, separators=(",", ":"), ensure_ascii=True) for v in values]
    assert evaluate([None], json_text.compact_json) == ["{}"]


def test_integers(evaluate):
    texts = ["12345", " 7 ", "-5", "12.0", str(2**70), str(-(2**70)), "true", "", None, str(2**63 - 1)]
    assert evaluate(texts, json_text.int_or_zero) == [12345, 7, -5, 0, 0, 0, 0, 0, 0, 2**63 - 1]
    assert evaluate(["-5", "5"], json_text.uint_or_zero) == [0, 5]


def test_json_value_gives_scalars_only(evaluate):
    texts = ['{"a":"x"}', '{"a":1.50}', '{"a":null}', '{"a":[1]}', '{"a":{"b":1}}', '{"a":"[odd"}', '{"a":"x"', None]
    got = evaluate(texts, lambda v: json_text.json_value(v, "$.a"))
    assert got[0] == "x" and float(got[1]) == 1.5
    assert got[2:] == [None, None, None, "[odd", None, None]


def test_json_keys(evaluate):
    assert evaluate(['{"a":null,"b":1}', "", "[]", "bad", None], json_text.json_keys) == [["a", "b"], None, None, None, None]


def test_addresses_agree_with_the_standard_library(evaluate):
    texts = [
        "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3", "::", "::1", "1::", "2001:db8::5", "1:2:3:4:5:6:7:8",
        "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4::5:6:7:8", "1::2::3", ":::", "12345::", "g::",
        "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "::1.2.3", "fe80::1%eth0", "fe80::1%", "1:2:3:4:5:6:7", "ABCD::EF01", "",
        "::1.2.3.4:5", "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4:5::1.2.3.4", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:",
    ]

    def valid(text):
        try:
            return ipaddress.ip_address(text)
        except ValueError:
            return None

    assert evaluate(texts, network.is_ip) == [valid(t) is not None for t in texts]

    def key(text):
        address = valid(text)
        if address is None:
            return None
        return f"{int(address):032x}" if address.version == 6 else f"00000000000000000000ffff{int(address):08x}"

    assert evaluate(texts, network.ip_key) == [key(t) for t in texts]


def test_client_ip_order(spark):
    rows = [
        ("203.0.113.8, 10.0.0.1", "198.51.100.4", "172.16.0.2", "203.0.113.8"),
        ("unknown", "198.51.100.4", "172.16.0.2", "198.51.100.4"),
        (None, None, "172.16.0.2", "172.16.0.2"),
        ('"1.2.3.4:80"', None, None, "1.2.3.4"),
        ("x, [2001:db8::1]:443", None, None, "2001:db8::1"),
        ("[1.2.3.4:80]", None, None, "1.2.3.4"),
        ("", "UNKNOWN", None, ""),
    ]
    df = spark.createDataFrame(rows, "f string, r string, p string, want string")
    got = df.select(network.client_ip(F.col("f"), F.col("r"), F.col("p")), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_identity(evaluate):
    import hashlib

    assert evaluate(["1.2.3.4"], lambda v: identity.ip_hash(v, "salt")) == [hashlib.sha256(b"salt:1.2.3.4").hexdigest()]
    assert evaluate(["com.example.app", " a b "], lambda v: identity.route_subject("events", v)) == [
        "events.com.example.app", "events.a_b",
    ]
    assert evaluate(["", "u", None], lambda v: identity.actor_id(v, F.lit("anon"))) == ["anon", "u", "anon"]


@pytest.mark.parametrize(("text", "day_time"), [
    ("1704067200", "2024-01-01 00:00:00.000"), ("1704067200123", "2024-01-01 00:00:00.123"),
    ("1704067200123456", "2024-01-01 00:00:00.123"), ("20240101100000", "2024-01-01 10:00:00.000"),
    ("2024/01/02", "2024-01-02 00:00:00.000"), ("2024/01/01 10:00:00", "2024-01-01 10:00:00.000"),
    ("Mon, 01 Jan 2024 10:00:00 GMT", "2024-01-01 10:00:00.000"), ("1 Feb 2024 10:00:00 +0000", "2024-02-01 10:00:00.000"),
    ("20240101T1000Z", "2024-01-01 10:00:00.000"), ("20240101T10", "2024-01-01 10:00:00.000"),
    ("2024-W01-1", "2024-01-01 00:00:00.000"), ("2021W537", None), ("2020-W53", "2020-12-28 00:00:00.000"),
    ("2024W017", "2024-01-07 00:00:00.000"), ("99 Jan 2024 10:00:00 GMT", None), ("1 Foo 2024 10:00:00 GMT", None),
    ("20241301100000", None), ("12345678", None), ("tomorrow", None),
])
def test_more_best_effort_times(evaluate, text, day_time):
    shown = lambda c: F.date_format(times.parse_best_effort_ms(c), "yyyy-MM-dd HH:mm:ss.SSS")
    assert evaluate([text], shown) == [day_time]


def test_an_object_is_told_as_by_its_kind(evaluate):
    texts = [None, "", "{", "{}", " {}", '\t\r\n{"a":1}', "\x0b{}", "{}x", "{} {}", "[]", "[{}]", '"{}"', "null", "5", '{"a":}', "{'a':1}",
             '{"a":1,}', "\xa0{}", "\ufeff{}", '{"a":{"b":[1,null]}}']
    by_kind = evaluate(texts, lambda v: F.coalesce(json_text.kind(F.try_parse_json(v)).startswith("OBJECT"), F.lit(False)))
    assert evaluate(texts, json_text.is_object) == by_kind
    # Spark's reader stops at the end of the first value.
    assert [t for t, found in zip(texts, by_kind, strict=True) if found] == ["{}", " {}", '\t\r\n{"a":1}', "{}x", "{} {}", '{"a":{"b":[1,null]}}']
