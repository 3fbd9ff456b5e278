"""Steps that must spread over tasks, or shuffle less, as their input grows."""

from __future__ import annotations

import json
import os
from collections import Counter
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import functions as F

from tallystream.operators import geo
from tallystream.operators.dedupe import distinct_rows, distinct_wide_rows
from tallystream.plans import serving
from tallystream.plans.collect import collect_messages
from tallystream.plans.landing import land_raw, numbered_files
from tallystream.registry.fixture import file_share
from tallystream.session import FREE_SHUFFLES, freed_shuffles
from tallystream.sources.requests import REQUEST_SCHEMA, read_requests
from tallystream.sources.stores import scan_raw, scan_serving
from tallystream.streaming.collect import collect_stream
from tallystream.streaming.dedupe import dedupe_batch, marked_rows
from tests.test_layers import raw

RANGE = "lo_ip string, hi_ip string, country struct<name string, iso_code string>, country_name string, country_code string"


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    was = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in was.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def some_ranges(spark, n=400):
    rows = [(f"60.1.{i // 64}.{i % 64 * 4}", f"60.1.{i // 64}.{i % 64 * 4 + 2}", None, f"C{i}", "cc") for i in range(n)]
    return spark.createDataFrame([*rows, ("60.9.0.9", "60.9.0.1", None, "none", None)], RANGE)


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_ranges_of_one_file_are_cut_by_many_tasks(spark):
    with settings(spark, spark__sql__shuffle__partitions="8"):
        table = geo.network_table(some_ranges(spark).coalesce(1))
        held = table.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == 8 and max(r["count"] for r in held) < 1200 * 0.5
    assert sorted(r.geo_name for r in table.select("geo_name").distinct().collect()) == sorted(f"C{i}" for i in range(400))


def test_rows_without_an_address_are_not_one_task_s(spark):
    rows = [(str(i), "") for i in range(1000)] + [("x", "60.1.0.5"), ("y", "60.1.0.7"), ("z", None)]
    with settings(spark, spark__sql__shuffle__partitions="8", spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = geo.with_country(spark.createDataFrame(rows, "id string, client_ip string"), some_ranges(spark))
        held = found.groupBy(F.spark_partition_id()).count().collect()
        got = found.where("geo_name is not null or id in ('y', 'z')").select("id", "geo_name").collect()
    assert sum(r["count"] for r in held) == 1003 and max(r["count"] for r in held) < 400
    assert sorted((r.id, r.geo_name or "") for r in got) == [("x", "C1"), ("y", ""), ("z", "")]


def test_no_request_is_judged_again_for_its_address(spark, tmp_path):
    event = {"event_id": "1", "app_id": "a", "event_name": "n", "event_timestamp": "2026-03-20T18:42:15.123Z"}
    bodies = [("ok", "60.1.0.5", [event]), ("refused", "60.1.0.9", [event, {}]), ("nowhere", None, [event])]
    rows = [(i, datetime(2026, 3, 20), "k", None, ip, None, None, json.dumps({"events": e})) for i, ip, e in bodies]
    spark.createDataFrame(rows, REQUEST_SCHEMA).write.parquet(f"{tmp_path}/requests")
    requests = spark.read.schema(REQUEST_SCHEMA).parquet(f"{tmp_path}/requests")
    keys = spark.createDataFrame([("k", "a")], "api_key string, app_id string")
    messages = collect_messages(requests, keys, some_ranges(spark))
    assert sum("FileScan" in line and "body#" in line for line in plan_of(messages).splitlines()) == 1
    got = {r.request_id: json.loads(r.value)["geo"] for r in messages.collect()}
    assert got == {"ok": {"country": "C1", "country_code": "CC"}, "nowhere": None}


def test_distinct_wide_rows_equals_distinct_rows(spark, tmp_path):
    rows = [("a", None, 1), (None, "a", 1), ("a", None, 1), ("b", "b", 2), (None, None, None), (None, None, None), ("c", "", 3), ("c", None, 3)]
    table = spark.createDataFrame(rows, "x string, y string, n bigint")
    want = Counter(distinct_rows(table).collect())
    for most in (10, 0):
        assert Counter(distinct_wide_rows(table, f"{tmp_path}/copies{most}", most).collect()) == want
    # Whole rows meet only where their digest is repeated.
    plan = plan_of(distinct_wide_rows(table, f"{tmp_path}/plan"))
    assert plan.count("Exchange hashpartitioning(x") == 1 and plan.count("LeftAnti") >= 1 and plan.count("LeftSemi") >= 1


def test_a_load_of_everything_compares_digests(spark, tmp_path, monkeypatch):
    event = lambda n: {"event_id": str(n), "event_timestamp": f"2026-04-13T09:{n % 60:02d}:00Z"}
    rows = [event(n) for n in range(50)] + [event(n) for n in range(0, 50, 10)] + [{"event_id": "x", "event_timestamp": "never"}]
    land_raw(raw(spark, *rows), f"{tmp_path}/raw")
    used = []
    monkeypatch.setattr(serving, "distinct_wide_rows", lambda rows, path: used.append(path) or distinct_wide_rows(rows, path))
    serving.load_serving(scan_raw(spark, f"{tmp_path}/raw"), f"{tmp_path}/table")
    assert sorted(int(r.event_id) for r in scan_serving(spark, f"{tmp_path}/table").collect()) == list(range(50))
    assert len(used) == 1 and not os.path.exists(used[0])


def test_numbered_files_go_to_as_many_tasks_as_their_bytes_ask_for(spark):
    rows = spark.range(20_000).selectExpr(
        "concat('app', id % 3) as app_id", "concat('2026-04-1', id % 1) as event_date", "concat('0', id % 1) as hour", "'S' as nats_stream",
        "id as nats_sequence", "'e' as event_id", "10 as message_bytes")
    files = numbered_files(rows, 100, 0, share_rows=500, task_bytes=20_000).withColumn("task", F.spark_partition_id())
    assert files.rdd.getNumPartitions() == 10
    found = files.groupBy("app_id", "file").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks")).collect()
    assert sum(f.n for f in found) == 20_000 and max(f.n for f in found) <= 100 and {f.tasks for f in found} == {1}
    # One shuffle of whole rows: the numbers need none of their own.
    assert plan_of(files).split("Initial Plan")[0].count("Exchange hashpartitioning(app_id") == 2  # sizes, rows


def test_log_files_grow_in_number_with_the_table(spark, tmp_path):
    spark.range(25).write.parquet(f"{tmp_path}/events.parquet")
    assert [file_share(spark, str(tmp_path), rows) for rows in (10, 26)] == [3, 1]


def shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_steps_that_write_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(1000).withColumn("x", F.col("id") % 7).repartition(5, "x")
    before = shuffle_files(spark)
    for step in range(2):  # the same rows may be written again
        with freed_shuffles(spark):
            rows.write.parquet(f"{tmp_path}/{step}")
        assert not shuffle_files(spark) - before
    assert spark.conf.get(FREE_SHUFFLES, "false") == "false"
    rows.write.parquet(f"{tmp_path}/2")
    assert shuffle_files(spark) - before
    assert [spark.read.parquet(f"{tmp_path}/{step}").count() for step in range(3)] == [1000] * 3


def test_resends_are_found_without_shuffling_whole_messages(spark, tmp_path):
    at = lambda second: datetime(2024, 1, 1, 0, second // 60, second % 60)
    rows = [("a", f"k{i % 90}", at(i), f"{i:04d}", f"body {i}", i * 3) for i in range(900)]
    rows += [("a", None, None, "x", "no time", 5_000_000_063), ("a", None, at(0), "y", "first", 5_000_000_064)]
    schema = "app_id string, event_id string, published_at timestamp, sequence string, body string, row bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/sent")
    got = {}
    for row in (None, "row"):
        for number, part in enumerate(("row < 900", "row >= 900")):
            sent = spark.read.schema(schema).parquet(f"{tmp_path}/sent").where(part)
            kept = []
            dedupe_batch(sent, number, f"{tmp_path}/{row}", 300, sink=lambda k, n: kept.append((plan_of(k), sorted(k.collect(), key=lambda r: r.sequence))), row=row)
            got[row, number] = kept[0][1]
            if row:
                assert "Exchange hashpartitioning" not in kept[0][0] and "body" not in spark.read.parquet(f"{tmp_path}/row/kept/batch={number}").columns
    for number in (0, 1):
        assert got["row", number] == got[None, number]
    assert [r.body for r in got["row", 0]] == [f"body {i}" for i in range(90)]
    # At 300 s every key comes again within a window of nothing kept; the message without a time is the newest.
    assert len(got["row", 1]) == 90 * 2 + 2 and {r.body for r in got["row", 1]} >= {"first", "no time"}


def test_marked_rows_of_more_words_than_tasks_may_hold(spark, tmp_path):
    numbers = [0, 1, 62, 63, 64, 127, 128, (1 << 33) + 63, (1 << 33) + 64]
    rows = spark.createDataFrame([(n, f"v{n}") for n in numbers] + [(None, "none")], "row bigint, value string")
    kept = spark.createDataFrame([(n,) for n in numbers[::2]], "row bigint")
    for most in (100, 1):
        assert sorted(r.row for r in marked_rows(rows, kept, "row", f"{tmp_path}/{most}", most).collect()) == numbers[::2]


def test_a_collector_s_batches_keep_what_is_no_resend_and_hold_messages_once(spark, tmp_path):
    event = lambda n: {"event_id": str(n), "app_id": "a", "event_name": "n", "event_timestamp": "2026-03-20T18:42:15.123Z"}
    keys = spark.createDataFrame([("k", "a")], "api_key string, app_id string")
    before = shuffle_files(spark)
    for part in range(2):
        rows = [(f"r{part}-{minute}", datetime(2026, 3, 20, part, minute), "k", None, "60.1.0.5", None, None, json.dumps({"events": [event(n) for n in range(30)]}))
                for minute in (0, 5, 20)]
        rows += [(f"r{part}-none", None, "k", None, None, None, None, json.dumps({"events": [event(-1)]}))]
        spark.createDataFrame(rows, REQUEST_SCHEMA).coalesce(2).write.mode("append").json(f"{tmp_path}/log")
        collect_stream(read_requests(spark, f"{tmp_path}/log", stream=True), keys, some_ranges(spark, 20), f"{tmp_path}/raw", f"{tmp_path}/state",
                       f"{tmp_path}/checkpoint", every_seconds=None).awaitTermination()
    got = Counter(r.event_id for r in scan_raw(spark, f"{tmp_path}/raw").collect())
    assert got == {str(n): 2 if n < 0 else 4 for n in range(-1, 30)}
    assert "value" not in spark.read.parquet(f"{tmp_path}/state/kept").columns
    # Only the networks, cut before the stream, shuffle outside its steps.
    assert len(shuffle_files(spark) - before) < 40
