from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest

from tallystream.operators import filters, metrics
from tallystream.plans import base_model as model
from tallystream.plans import readonly_sql as sql
from tallystream.plans.landing import land_raw
from tallystream.plans.newest import newest_events
from tallystream.plans.serving import load_hour, load_serving, serving_rows
from tallystream.schemas import JSON_COLUMNS, PROMOTED_FIELDS, RAW_COLUMNS, RAW_SCHEMA, SERVING_COLUMNS
from tallystream.sources import snapshots
from tallystream.sources.stores import scan_raw, scan_raw_hour, scan_serving
from tallystream.streaming.landing import dead_letters_stream, land_stream, load_stream

BASE = dict(
    event_id="first", app_id="org.sample.maps", environment="prod", event_name="route_shown",
    event_timestamp="2026-04-13T10:00:00Z", received_at="2026-04-13T10:00:01+00:00", user_id="u-17",
    user_pseudo_id="p-17", session_id="17-a", platform="ios", app_version="8.2", os_version="26.1",
    device_model="phone", locale="fi-FI", timezone="Europe/Helsinki", event_params_json='{"km":3}', user_properties_json="{}",
    traffic_source_json="{}", geo_json='{"country_code":"FI"}', consent_json="{}", ingest_request_id="q-5",
    ingest_user_agent="maps/8.2", ingest_ip_hash="0f", nats_stream="EVENTS", nats_sequence=123,
)


def raw(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}[k] for k in RAW_COLUMNS) for c in changes], RAW_SCHEMA)


def test_landing_layout_and_null_heavy_rows(spark, tmp_path):
    sparse = {k: None for k in RAW_COLUMNS if k not in ("app_id", "event_id", "event_name", "event_timestamp", "nats_sequence")}
    land_raw(raw(spark, {}, {**sparse, "event_timestamp": "2026-04-13T09:30:00Z"}), str(tmp_path / "raw"))
    assert os.path.isdir(tmp_path / "raw/app_id=org.sample.maps/event_date=2026-04-13/hour=09")
    back = scan_raw(spark, str(tmp_path / "raw"))
    assert back.columns == RAW_COLUMNS + ["event_date", "hour"]
    assert sorted(r["hour"] for r in back.collect()) == ["09", "10"]
    row = scan_raw_hour(spark, str(tmp_path / "raw"), datetime(2026, 4, 13, 9)).first()
    assert row["user_id"] is None and row["nats_sequence"] == 123
    # Only the hour's own folders are read, and an hour without any is empty.
    files = scan_raw_hour(spark, str(tmp_path / "raw"), datetime(2026, 4, 13, 9)).inputFiles()
    assert len(files) == 1 and "/hour=09/" in files[0]
    assert scan_raw_hour(spark, str(tmp_path / "raw"), datetime(2026, 4, 13, 11)).count() == 0


def test_serving_rows(spark):
    rows = raw(spark, {}, {}, {"event_timestamp": "bad"}, {"app_id": None, "environment": None, "user_pseudo_id": None, "user_id": None})
    got = serving_rows(rows)
    assert got.columns == SERVING_COLUMNS and got.count() == 2
    blank = got.where("app_id = ''").first()
    assert (blank["environment"], blank["user_pseudo_id"], blank["user_id"]) == ("", "", None)


def test_hour_load_is_repeatable_and_keeps_other_hours(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "serving")
    # The second row has an epoch time, so it lands under its receive hour.
    land_raw(raw(spark, {}, {"event_id": "2", "event_timestamp": "1704067200"}), raw_root)
    land_raw(raw(spark, {"event_id": "3", "event_timestamp": "2024-01-01T00:00:00Z"}), raw_root)
    assert load_hour(spark, raw_root, root, datetime(2024, 1, 1, 0))
    for _ in range(2):
        assert load_hour(spark, raw_root, root, datetime(2026, 4, 13, 10))
    assert not load_hour(spark, raw_root, root, datetime(2026, 4, 13, 11))
    got = sorted((r["event_id"], str(r["event_date"])) for r in scan_serving(spark, root).collect())
    assert got == [("2", "2024-01-01"), ("3", "2024-01-01"), ("first", "2026-04-13")]
    # Corrected and emptied hours: their folders go, others stay.
    land_raw(raw(spark, {"event_id": "4"}), str(tmp_path / "fixed"))
    assert load_hour(spark, str(tmp_path / "fixed"), root, datetime(2026, 4, 13, 10))
    assert not load_hour(spark, str(tmp_path / "fixed"), root, datetime(2024, 1, 1, 0))
    assert [r["event_id"] for r in scan_serving(spark, root).collect()] == ["4"]
    assert [f["hours"] for f in snapshots.latest(spark, root).folders.values()] == [["2026-04-13-10"]]


def test_streams_land_load_and_restart(spark, tmp_path):
    def message(n, hour):
        return (f'{{"event_id":"{n}","app_id":"a","event_timestamp":"2026-04-13T{hour}:00:00Z"}}', "EVENTS", str(n), None)

    def put(*rows):
        spark.createDataFrame(rows, "value string, stream string, sequence string, published_at timestamp").coalesce(
            1
        ).write.mode("append").json(f"{tmp_path}/log")

    def run():
        schema = "value string, stream string, sequence string, published_at timestamp"
        log = spark.readStream.schema(schema).json(f"{tmp_path}/log")
        land_stream(log, f"{tmp_path}/raw", f"{tmp_path}/c1", every_seconds=None).awaitTermination()
        dead_letters_stream(log, f"{tmp_path}/dead", f"{tmp_path}/c2", every_seconds=None).awaitTermination()
        load_stream(spark, f"{tmp_path}/raw", f"{tmp_path}/serving", f"{tmp_path}/c3").awaitTermination()
        return sorted(r["event_id"] for r in scan_serving(spark, f"{tmp_path}/serving").collect())

    put(message(1, "09"), message(2, "10"), ("broken", "EVENTS", "3", None))
    assert run() == ["1", "2"]
    # A resend of 1 (an exact copy) and a late event for the same old hour.
    put(message(1, "09"), message(4, "09"))
    assert run() == ["1", "2", "4"]
    assert run() == ["1", "2", "4"]
    assert [r["value"] for r in spark.read.schema("value string").json(f"{tmp_path}/dead").collect()] == ["broken"]


def test_model_refresh_empties_folders_that_lost_their_rows(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "model")
    day = datetime(2026, 4, 13)
    land_raw(raw(spark, {}, {"event_id": "2", "received_at": "2026-04-13T09:00:00+00:00"}), raw_root)
    model.refresh_model(spark, raw_root, root, day, day + timedelta(hours=11))
    land_raw(raw(spark, {"received_at": "2026-04-13T11:30:00+00:00", "nats_sequence": 9}), raw_root)
    for _ in range(2):
        model.refresh_model(spark, raw_root, root, day + timedelta(hours=11), day + timedelta(hours=12))
        got = sorted((r["event_id"], r["nats_sequence"], r["geo_country_code"]) for r in model.scan_model(spark, root).collect())
        assert got == [("2", 123, "FI"), ("first", 9, "FI")]


def test_model_refresh_of_part_of_an_hour_keeps_the_rest(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "model")
    times = [f"2026-04-13T10:{m}:00+00:00" for m in ("10", "20", "40")]
    land_raw(raw(spark, *[{"event_id": str(i), "received_at": t} for i, t in enumerate(times)]), raw_root)
    at = lambda m: datetime(2026, 4, 13, 10, m)
    model.refresh_model(spark, raw_root, root, at(0), at(0) + timedelta(hours=1), lookback_hours=0)
    model.refresh_model(spark, raw_root, root, at(15), at(30), lookback_hours=0)
    assert sorted(r["event_id"] for r in model.scan_model(spark, root).collect()) == ["0", "1", "2"]


def test_promoted_fields_may_be_none_or_all(spark):
    rows = raw(spark, {})
    assert model.promote_fields(rows, []).columns == RAW_COLUMNS
    names = [f[0] for f in PROMOTED_FIELDS]
    assert model.promote_fields(rows, model.enabled_fields(names)).columns == RAW_COLUMNS + names
    assert [f[0] for f in model.enabled_fields()] == ["geo_country_code"]


def test_late_events_of_old_days_stay_outside(spark, tmp_path):
    raw_root = str(tmp_path / "raw")
    land_raw(raw(spark, {}, {"event_id": "old", "event_timestamp": "2026-04-01T00:00:00Z"}), raw_root)
    rows = filters.filter_received_range(scan_raw(spark, raw_root), datetime(2026, 4, 13), datetime(2026, 4, 14))
    assert [r["event_id"] for r in rows.collect()] == ["first"]


def events(spark, *changes):
    return serving_rows(raw(spark, *[{"event_id": str(i), **c} for i, c in enumerate(changes)]))


def test_tools_count_blank_actors_once_and_skip_bots(spark):
    rows = events(
        spark, {}, {"user_id": "", "user_pseudo_id": None}, {"user_id": None, "user_pseudo_id": None},
        {"ingest_user_agent": "GoogleBot/2"}, {"ingest_user_agent": None, "user_id": "u2"}, {"environment": "dev"},
    )
    assert metrics.table_overview(rows).first()["actors"] == 3
    assert metrics.table_overview(rows).first()["events"] == 5
    assert metrics.table_overview(rows, exclude_bots=False).first()["events"] == 6
    assert metrics.list_event_names(rows).first()["events"] == 4
    assert metrics.list_event_names(rows, environment="").first()["events"] == 5
    assert metrics.daily_active_users(rows, "2026-04-13", "2026-04-13").first()["dau"] == 3
    assert metrics.table_overview(rows.where("false")).first()["events"] == 0


def test_json_key_tool(spark):
    rows = events(spark, {"geo_json": '{"country":"X","city":null}'}, {"geo_json": ""}, {"geo_json": None}, {"geo_json": '{"country":"Y"}'})
    got = [tuple(r) for r in metrics.discover_json_keys(rows, "geo_json").collect()]
    assert got == [("country", 2), ("city", 1)]
    with pytest.raises(ValueError, match=", ".join(JSON_COLUMNS)):
        metrics.discover_json_keys(rows, "user_id")


def test_sample_is_newest_first_and_capped(spark):
    rows = events(spark, *[{"event_timestamp": f"2026-04-13T10:00:{i:02d}Z"} for i in range(60)])
    got = metrics.sample_events(rows, limit=500).collect()
    assert len(got) == 50 and got[0]["event_id"] == "59"


def test_readonly_words():
    assert sql.checked_words(" select 1 ;; ") == "select 1"
    for text in ("values (1)", "", " ; ", "select 1; select 2", "select 'kill'", "with a as (select 1) delete from a"):
        with pytest.raises(sql.RefusedStatement):
            sql.checked_words(text)


def test_readonly_rows(spark):
    spark.range(1000).createOrReplaceTempView("numbers")
    count = lambda text, **kw: sql.readonly_sql(spark, text, **kw).count()
    assert count("select * from numbers") == 100
    assert count("select * from numbers", limit=10_000) == 500
    assert count("select * from numbers", limit=900, max_rows=None) == 900
    assert count("select * from numbers limit 700") == 500
    assert count("with n as (select * from numbers) select * from n where id < :top", args={"top": 7}) == 7
    assert count("select n.id, (select max(id) from numbers) m from numbers n where exists (select 1 from numbers k where k.id = n.id) order by 1 limit 3") == 3
    assert count("select id % 3 as k, count(*) as c, rank() over (order by id % 3) r from numbers group by 1 having count(*) > 1") == 3
    assert count("describe numbers", limit=0) == 1 and count("explain select * from numbers") == 1


@pytest.mark.parametrize("text", [
    "select transform(id) using 'cat' as (x string) from numbers", "select * from text.`/etc/hostname`",
    "select reflect('java.lang.System', 'getProperty', 'user.name')", "select java_method('java.lang.Math', 'random')",
    "select (select max(value) from text.`/etc/hostname`)", "with t as (select * from json.`/tmp/x`) select * from t",
    "select * from absent", "select * from hidden", "describe hidden", "explain select * from text.`/etc/hostname`",
    "show create table numbers", "describe text.`/etc/hostname`", "select * from numbers where try_reflect('a', 'b') = '1'",
])
def test_readonly_refuses_what_is_no_query_over_the_views(spark, text):
    spark.range(1000).createOrReplaceTempView("numbers")
    spark.range(3).createOrReplaceTempView("hidden")
    with pytest.raises(sql.RefusedStatement):
        sql.readonly_sql(spark, text, views=["numbers"])


def test_date_filter_and_columns_reach_the_scan(spark, tmp_path):
    root = str(tmp_path / "serving")
    land_raw(raw(spark, {}), str(tmp_path / "raw"))
    load_hour(spark, str(tmp_path / "raw"), root, datetime(2026, 4, 13, 10))
    plan = metrics.daily_active_users(scan_serving(spark, root), "2026-04-13", "2026-04-14")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and "EqualTo(environment,prod)" in text
    schema = text[text.index("ReadSchema"):]
    assert "user_pseudo_id" in schema and "geo_json" not in schema



def test_mixed_writers_and_a_batch_that_runs_again(spark, tmp_path):
    schema = "value string, stream string, sequence string, published_at timestamp"
    text = '{"event_id":"%s","app_id":"a","event_timestamp":"2026-04-13T10:00:00Z"}'
    spark.createDataFrame([(text % i, "EVENTS", str(i), None) for i in range(5)], schema).coalesce(1).write.json(f"{tmp_path}/log")
    root = f"{tmp_path}/raw"
    run = lambda: land_stream(spark.readStream.schema(schema).json(f"{tmp_path}/log"), root, f"{tmp_path}/c", None).awaitTermination()
    run()
    land_raw(raw(spark, {}), root)
    # As after a failure between the move and the commit: the same batch once more.
    for name in os.listdir(f"{tmp_path}/c/commits"):
        os.remove(f"{tmp_path}/c/commits/{name}")
    run()
    assert scan_raw(spark, root).count() == 6
    # And as after a failure in the middle of the move.
    for name in os.listdir(f"{tmp_path}/c/commits"):
        os.remove(f"{tmp_path}/c/commits/{name}")
    (mark,) = [n for n in os.listdir(root) if n.startswith("_landed")]
    os.rmdir(f"{root}/{mark}")
    folder = "app_id=a/event_date=2026-04-13/hour=10"
    (file,) = [n for n in os.listdir(f"{root}/{folder}") if n.startswith("s") and n.endswith("parquet")]
    staged = f"{root}/{mark.replace('_landed', '_landing')}"
    os.makedirs(f"{staged}/{folder}")
    os.rename(f"{root}/{folder}/{file}", f"{staged}/{folder}/{file[len(mark) - 7:]}")
    open(f"{staged}/_SUCCESS", "w").close()
    run()
    assert sorted(r["event_id"] for r in scan_raw(spark, root).collect()) == ["0", "1", "2", "3", "4", "first"]
    assert not [n for n in os.listdir(root) if n.startswith("_landing")]


def test_stored_model_reads_any_cast_type(spark, tmp_path):
    fields = [("km", "event_params_json", "$.km", "double"), ("at", "event_params_json", "$.at", "timestamp")]
    land_raw(raw(spark, {}), str(tmp_path / "raw"))
    model.refresh_model(spark, str(tmp_path / "raw"), str(tmp_path / "m"), datetime(2026, 4, 13, 10), datetime(2026, 4, 13, 11), fields=fields)
    row = model.scan_model(spark, str(tmp_path / "m"), fields).first()
    assert row["km"] == 3.0 and row["at"] is None


def test_active_users_of_all_days_unless_asked(spark):
    rows = events(spark, *[{"event_timestamp": f"{2000 + i // 12}-{i % 12 + 1:02d}-03T10:00:00Z"} for i in range(520)])
    assert metrics.daily_active_users(rows, "2000-01-01", "2050-01-01").count() == 520
    assert metrics.daily_active_users(rows, "2000-01-01", "2050-01-01", max_rows=500).count() == 500
    assert metrics.list_event_names(rows, bot_pattern="maps").count() == 0


def test_newest_events_read_the_last_days_only(spark, tmp_path):
    rows = [{"event_id": f"{d}-{n}", "event_timestamp": f"2026-04-{d:02d}T{n:02d}:00:00Z", "event_name": "rare" if d == 2 else "common"}
            for d in range(1, 21) for n in range(4)]
    land_raw(raw(spark, *rows), str(tmp_path / "raw"))
    root = str(tmp_path / "table")
    load_serving(scan_raw(spark, str(tmp_path / "raw")), root)
    for limit, days in ((4, 1), (5, 3), (50, 20)):
        got = newest_events(spark, root, limit=limit)
        assert [r.event_id for r in got.collect()] == [r.event_id for r in metrics.sample_events(scan_serving(spark, root), limit=limit).collect()]
        assert len({f.split("event_date=")[1][:10] for f in got.inputFiles()}) <= days
    assert [r.event_id for r in newest_events(spark, root, event_name="rare", limit=2).collect()] == ["2-3", "2-2"]
    assert newest_events(spark, root, event_name="none").count() == 0 and newest_events(spark, str(tmp_path / "no"), limit=3).count() == 0


def test_a_slow_statement_is_stopped_and_others_go_on(spark):
    spark.range(50).createOrReplaceTempView("numbers")
    spark.range(3_000_000).createOrReplaceTempView("many")
    slow = "select sum(length(sha2(cast(a.id * b.id as string), 512))) as s from many a join numbers n on a.id % 50 = n.id join many b on a.id % 1000 = b.id % 1000"
    with ThreadPoolExecutor(2) as pool:
        other = pool.submit(lambda: [len(sql.run_readonly_sql(spark, "select * from numbers", seconds=60)) for _ in range(8)])
        with pytest.raises(sql.TimeLimit):
            sql.run_readonly_sql(spark, slow, seconds=1.5)
        assert other.result() == [50] * 8
    assert sql.run_readonly_sql(spark, "select count(*) as n from numbers")[0].n == 50
    with pytest.raises(sql.RefusedStatement):
        sql.run_readonly_sql(spark, "drop view numbers")


def test_a_model_refresh_lists_its_own_folders_only(spark, tmp_path, monkeypatch):
    raw_root, root, seen = str(tmp_path / "raw"), str(tmp_path / "model"), []
    land_raw(raw(spark, *[{"event_id": str(d), "event_timestamp": f"2026-04-{d:02d}T10:00:00Z", "received_at": f"2026-04-{d:02d}T10:00:01+00:00"} for d in range(1, 6)]), raw_root)
    scan = model.base_model
    monkeypatch.setattr(model, "base_model", lambda rows, *rest: seen.append(rows.inputFiles()) or scan(rows, *rest))
    for d in range(1, 6):
        model.refresh_model(spark, raw_root, root, datetime(2026, 4, d, 10), datetime(2026, 4, d, 11))
    assert sorted(r.event_id for r in model.scan_model(spark, root).collect()) == list("12345")
    assert [len(files) for files in seen] == [1] * 5 and "event_date=2026-04-05" in seen[-1][0]
    model.refresh_model(spark, str(tmp_path / "none"), str(tmp_path / "empty"), datetime(2026, 4, 1), datetime(2026, 4, 2))
    assert model.scan_model(spark, str(tmp_path / "empty")).count() == 0
