"""Sessions, retention and daily values by brute force; rollups of micro-batches as of all rows."""

from __future__ import annotations

import random
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystream.operators import retention, sessions, values
from tallystream.plans import serving
from tallystream.plans.landing import land_raw
from tallystream.sources import snapshots
from tallystream.sources.stores import scan_raw, scan_serving
from tallystream.streaming.landing import load_stream
from tallystream.streaming.rollups import retention_rollup, sessions_rollup, values_rollup
from tests.test_layers import events, raw

START = datetime(2026, 4, 10, tzinfo=UTC)


def iso(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def visits(seed: int, count: int = 300) -> list[dict]:
    """Actors of all habits; one has a third of all rows, for days on end."""
    draw = random.Random(seed)
    out = []
    for n in range(count):
        hot = n % 3 == 0
        moment = START + timedelta(milliseconds=draw.randrange(4 * 86_400_000))
        if hot:
            moment = START + timedelta(seconds=1700 * (n // 3), milliseconds=draw.randrange(1000))
        out.append({"event_id": str(n), "event_timestamp": iso(moment), "event_name": draw.choice("abc"), "app_id": draw.choice(["x", "x", "y"]) if not hot else "x",
                    "user_id": "hot" if hot else draw.choice(["", None, "u1", "u2", "u3"]), "user_pseudo_id": draw.choice(["p1", None]),
                    "environment": "prod" if draw.random() < 0.9 else "dev", "event_params_json": f'{{"v":{draw.randrange(-9999, 9999) / 100}}}',
                    "session_id": draw.choice(["s1", "s2", "", None]), "ingest_user_agent": draw.choice(["a", "a", None, "GoogleBot"])})
    return out


def brute(rows, gap):
    owners, found = {}, []
    for r in rows:
        owners.setdefault((r["app_id"], r["environment"], r["actor"]), []).append((r["event_time"], r["event_name"]))
    for owner, times in owners.items():
        run = []
        for at in sorted(times) + [None]:
            if run and (at is None or (at[0] - run[-1][0]).total_seconds() >= gap):
                found.append((*owner, run[0][0], run[-1][0], len(run), round((run[-1][0] - run[0][0]).total_seconds() * 1000), run[0][1], run[-1][1]))
                run = []
            run.append(at)
    return sorted(found, key=repr)


def with_actor(rows):
    return rows.withColumn("actor", F.expr("coalesce(nullif(user_id, ''), user_pseudo_id)"))


@pytest.mark.parametrize("gap", [1, 1700, 1800, 100_000])
def test_sessions_by_brute_force(spark, gap):
    rows = events(spark, *visits(1))
    want = brute([r.asDict() for r in with_actor(rows).collect()], gap)
    got = sessions.actor_sessions(rows, gap)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    parts = [sessions.session_parts(rows.where(F.col("event_id") % 3 == n), gap, slice_seconds=5000) for n in range(3)]
    merged = sessions.sessions_of(parts[2].unionByName(parts[0]).unionByName(parts[1]), gap)
    assert sorted(map(tuple, merged.collect()), key=repr) == want


def test_an_actor_is_cut_by_slices(spark):
    """The exchange that orders rows deals them out by actor and slice; the one by actor alone sees parts."""
    rows = spark.range(400_000).selectExpr(
        "'x' as app_id", "'prod' as environment", "'hot' as user_id", "'' as user_pseudo_id",
        "timestamp_seconds(1775779200 + id) as event_time", "'a' as event_name")
    parts = sessions.session_parts(rows)
    assert [r["events"] for r in parts.orderBy("slice").collect()] == [86_400] * 4 + [54_400]
    assert [r["events"] for r in sessions.sessions_of(parts).collect()] == [400_000]
    with pytest.raises(ValueError):
        sessions.session_parts(rows, 0)


def test_client_sessions_and_summary(spark):
    rows = events(spark, *visits(2))
    held = [r.asDict() for r in with_actor(rows).collect() if r["session_id"]]
    got = {(r["app_id"], r["session_id"]): (r["events"], r["actors"]) for r in sessions.client_sessions(rows).collect()}
    assert got == {k: (len(own := [r for r in held if (r["app_id"], r["session_id"]) == k]), len({r["actor"] for r in own}))
                   for k in {(r["app_id"], r["session_id"]) for r in held}}
    found = sessions.actor_sessions(rows).collect()
    for day in sessions.session_summary(sessions.actor_sessions(rows)).collect():
        own = [s for s in found if s["session_start"].date() == day["session_date"]]
        assert (day["sessions"], day["actors"], day["events"], day["single_event_sessions"], day["total_ms"], day["longest_ms"]) == (
            len(own), len({s["actor_id"] for s in own}), sum(s["events"] for s in own), sum(s["events"] == 1 for s in own),
            sum(s["duration_ms"] for s in own), max(s["duration_ms"] for s in own))
    assert sessions.session_summary(sessions.actor_sessions(rows.where("false"))).count() == 0


def test_retention_by_brute_force(spark):
    draw = random.Random(4)
    first = date(2026, 1, 1)
    seen = {(f"u{draw.randrange(40)}", draw.randrange(200)) for _ in range(500)} | {("old", -40_000)}
    rows = events(spark, *[{"user_id": u, "event_timestamp": f"{first + timedelta(days=d)}T10:00:00Z"} for u, d in seen if u != "old"])
    starts = {u: min(d for v, d in seen if v == u) for u, _ in seen}
    want = {}
    for u, d in seen - {("old", -40_000)}:
        key = (first + timedelta(days=starts[u]), d - starts[u])
        want[key] = want.get(key, 0) + 1
    bits = retention.active_days(rows)
    assert {(r["cohort_date"], r["day_n"]): r["actors"] for r in retention.returns(bits).collect()} == want
    table = retention.retention_day_n(rows, (1, 30), start_date=first + timedelta(days=3)).collect()
    assert {r["cohort_date"]: (r["cohort_size"], r["day_1"], r["day_30"]) for r in table} == {
        c: (want[c, 0], want.get((c, 1), 0), want.get((c, 30), 0)) for c, n in want if n == 0 and c >= first + timedelta(days=3)}
    assert retention.retention_day_n(rows, environment="dev").count() == 0
    with pytest.raises(ValueError):
        retention.retention_table(bits, (-1,))


def test_days_before_1970_have_bits_too(spark):
    rows = events(spark, {"event_timestamp": "1969-12-30T10:00:00Z"}, {"event_timestamp": "1970-01-02T10:00:00Z"})
    assert [(str(r["cohort_date"]), r["day_n"]) for r in retention.returns(retention.active_days(rows)).orderBy("day_n").collect()] == [
        ("1969-12-30", 0), ("1969-12-30", 3)]


def test_values_are_exact(spark):
    texts = ['{"v":0.1}', '{"v":0.2}', '{"v":1e3}', '{"v":-7}', '{"v":"5"}', '{"v":true}', '{"v":null}', '{"v":[1]}', "{}", "", None, "no",
             '{"v":123456789012345678901234567890}', '{"v":99999999999999999.9}']
    rows = events(spark, *[{"event_params_json": t} for t in texts])
    row = values.daily_values(rows, "$.v").first()
    assert (row["events"], row["values"], row["unreadable"]) == (14, 5, 1)
    assert row["total"] == Decimal("100000000000000993.2") and row["smallest"] == Decimal(-7)
    with pytest.raises(ValueError):
        values.daily_values(rows, "$.v", "user_id")
    empty = values.daily_values(events(spark, {"event_params_json": "{}"}), "$.v").first()
    assert empty["total"] is None and empty["values"] == 0


def test_rollups_follow_the_table(spark, tmp_path):
    """Rows in any order over several micro-batches, late and sent twice, one batch run again, folders merged in between."""
    rows = visits(6, 240)
    random.Random(1).shuffle(rows)
    raw_root, root = f"{tmp_path}/raw", f"{tmp_path}/table"
    rollups = [sessions_rollup(f"{tmp_path}/s"), retention_rollup(f"{tmp_path}/r"), values_rollup(f"{tmp_path}/v", "$.v")]
    fails = []

    def shaky(new, number):
        if number == 2 and not fails:
            fails.append(new.count())
            raise OSError("lost")

    def run():
        sinks = [*[r.sink("t") for r in rollups], shaky]
        load_stream(spark, raw_root, root, f"{tmp_path}/c", sinks=sinks).awaitTermination()

    for turn in range(4):
        own = rows[turn * 60:(turn + 1) * 60] + rows[:turn * 10]
        land_raw(raw(spark, *own).coalesce(1), raw_root)
        if turn == 2:
            with pytest.raises(Exception, match="lost"):
                run()
        run()
        if turn == 2:
            assert [r.compact(spark) for r in rollups] == [2, 2, 2]
    assert all(len(snapshots.latest(spark, r.root).folders) == 3 for r in rollups)
    table = scan_serving(spark, root)
    assert table.count() == serving.serving_rows(scan_raw(spark, raw_root)).count() == 240
    same = lambda a, b: sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert same(sessions.sessions_of(rollups[0].read(spark)), sessions.actor_sessions(table))
    assert same(retention.returns(rollups[1].read(spark)), retention.returns(retention.active_days(table)))
    assert same(rollups[2].read(spark), values.daily_values(table, "$.v"))
    # A batch whose folder was merged does not come back.
    before = snapshots.latest(spark, rollups[0].root)
    rollups[0].sink("t")(table, 1)
    assert snapshots.latest(spark, rollups[0].root) == before
