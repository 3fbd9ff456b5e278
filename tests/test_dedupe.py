from __future__ import annotations

import os
import random
from contextlib import suppress
from datetime import UTC, datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallystream.operators.dedupe import dedupe_latest, dedupe_window, distinct_rows
from tallystream.streaming.dedupe import dedupe_stream, forget_before, read_kept

START = datetime(2024, 1, 1, tzinfo=UTC)
SCHEMA = "app_id string, event_id string, published_at timestamp, sequence string, body string"


def resends(seed):
    random.seed(seed)
    rows = []
    for n in range(40):
        for _ in range(random.randrange(1, 12)):
            rows.append((f"k{n}", random.randrange(6_000)))
    # One key with a third of all rows, sent so often that runs go on and on.
    rows += [("hot", random.randrange(20_000)) for _ in range(len(rows) // 2)]
    return [
        ("a", key, START + timedelta(seconds=s, milliseconds=random.randrange(1000)), f"{i:06d}", f"b{i}")
        for i, (key, s) in enumerate(rows)
    ]


def walk(rows, window):
    kept, last = [], {}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        second = int(row[2].timestamp())
        if row[1] not in last or second >= last[row[1]] + window:
            last[row[1]] = second
            kept.append(row[4])
    return sorted(kept)


def test_window_equals_a_walk(spark):
    for seed in range(3):
        rows = resends(seed)
        got = dedupe_window(spark.createDataFrame(rows, SCHEMA), 600)
        assert got.columns == ["app_id", "event_id", "published_at", "sequence", "body"]
        assert sorted(r["body"] for r in got.collect()) == walk(rows, 600)


def test_a_run_longer_than_a_batch_of_rows(spark):
    """Every second of a quarter of a day, once with and once without an id."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        every = spark.range(21_600).select(
            F.lit("a").alias("app_id"), F.lit("hot").alias("event_id"),
            F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("published_at"),
            F.col("id").cast("string").alias("sequence"), F.col("id").cast("string").alias("body"))
        rows = every.unionByName(every.withColumn("event_id", F.lit(None).cast("string")))
        got = dedupe_window(rows, 600).groupBy("event_id").agg(F.collect_list("body").alias("kept")).collect()
        assert {r.event_id: sorted(map(int, r.kept)) for r in got} == dict.fromkeys(["hot", None], list(range(0, 21_600, 600)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stream_equals_batch(spark, tmp_path):
    rows = sorted(resends(7), key=lambda r: r[2])
    size = len(rows) // 5 + 1
    for step in range(5):
        part = spark.createDataFrame(rows[step * size:(step + 1) * size], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        log = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/log")
        dedupe_stream(log, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = read_kept(spark, f"{tmp_path}/out", log.schema)
    assert sorted(r["body"] for r in got.collect()) == walk(rows, 600)


def stream_over(spark, tmp_path, parts):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        log = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/log")
        dedupe_stream(log, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    return sorted(r["body"] for r in read_kept(spark, f"{tmp_path}/out", log.schema).collect())


def at_second(key, second, body):
    return ("a", key, START + timedelta(seconds=second), body, body)


def test_a_stream_out_of_order_equals_the_batch(spark, tmp_path):
    """Older messages, times years ahead, and kept seconds on both sides, in the wrong order."""
    ahead = 40 * 365 * 86_400
    parts = [
        [at_second("k", 10_000, "b"), at_second("f", ahead, "far"), at_second(None, 5_000, "n2")],
        [at_second("k", 5_000, "a"), at_second("k", 20_000, "c"), at_second("f", 100, "f1"), at_second("f", 500, "resend of f1"), at_second(None, 4_000, "n1")],
        [at_second("k", 10_599, "resend of b"), at_second("k", 9_401, "resend of b, earlier"), at_second("k", 10_600, "d"), at_second("k", 9_400, "e"),
         at_second("f", ahead + 700, "f3"), at_second("f", 701, "f2"), at_second("f", ahead - 1, "resend of far"), at_second(None, 4_599, "resend of n1")],
    ]
    got = stream_over(spark, tmp_path, parts)
    assert got == sorted(["a", "b", "c", "d", "e", "far", "f1", "f2", "f3", "n1", "n2"])
    rows = [r for part in parts for r in part if not r[4].startswith("resend")]
    assert got == sorted(r["body"] for r in dedupe_window(spark.createDataFrame(rows, SCHEMA)).collect())


def test_days_in_any_order_equal_the_batch(spark, tmp_path):
    """Each part has a day of every key; days come last to first, the hot key's too."""
    random.seed(5)
    days = [[("a", key, START + timedelta(days=day, seconds=random.randrange(40_000)), f"{day}-{i:04d}", f"{day}-{i}")
             for i in range(90) for key in ("hot", "hot", f"k{i % 7}")] for day in range(4)]
    days = [[(*r[:3], f"{r[3]}-{n}", f"{r[4]}-{n}") for n, r in enumerate(day)] for day in days]
    rows = [r for day in days for r in day]
    got = stream_over(spark, tmp_path, days[::-1])
    assert got == walk(rows, 600) == sorted(r["body"] for r in dedupe_window(spark.createDataFrame(rows, SCHEMA)).collect())


def test_state_is_added_to_and_forgotten_by_slots(spark, tmp_path):
    root = tmp_path / "out/recent"
    stream_over(spark, tmp_path, [[at_second("k", 0, "a"), at_second("k", 86_400, "b")]])
    before = {f: os.stat(f).st_mtime_ns for f in map(str, root.rglob("*.parquet"))}
    stream_over(spark, tmp_path, [[at_second("k", 86_500, "resend of b"), at_second("k", 87_100, "c")]])
    after = {f: os.stat(f).st_mtime_ns for f in map(str, root.rglob("*.parquet"))}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert forget_before(spark, f"{tmp_path}/out", START + timedelta(hours=12)) == 1
    got = stream_over(spark, tmp_path, [[at_second("k", 1, "a again"), at_second("k", 86_401, "resend of b")]])
    assert got == ["a", "a again", "b", "c"]


def test_a_sink_that_fails_gets_the_same_batch_again(spark, tmp_path):
    rows = resends(11)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/log")
    got = []

    def sink(kept, number):
        got.append((number, sorted(r["body"] for r in kept.collect())))
        if len(got) == 1:
            raise OSError("lost")

    for _ in range(2):
        log = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/log")
        query = dedupe_stream(log, f"{tmp_path}/out", f"{tmp_path}/checkpoint", sink=sink)
        with suppress(StreamingQueryException):
            query.awaitTermination()
    assert got == [(0, walk(rows, 600))] * 2


def test_latest_prefers_receive_time_then_sequence_then_the_rest(spark):
    t = [START + timedelta(hours=i) for i in range(3)]
    rows = [
        ("a", "1", t[1], 5, "x", "q", "old"), ("a", "1", t[2], 1, "x", "q", "new"),
        ("a", "2", t[1], 1, "x", "q", "low"), ("a", "2", t[1], 2, "x", "q", "high"),
        ("a", "3", None, 9, "x", "q", "none"), ("a", "3", t[0], 1, "x", "q", "some"),
        ("a", "4", t[0], 1, None, "q", "null"), ("a", "4", t[0], 1, "w", "p", "p"), ("a", "4", t[0], 1, "w", "r", "r"),
        ("b", "1", t[0], 1, "x", "q", "other app"),
    ]
    df = spark.createDataFrame(
        rows, "app_id string, event_id string, received_at_ts timestamp, nats_sequence long, "
              "event_timestamp string, ingest_request_id string, tag string",
    )
    latest = dedupe_latest(df)
    assert sorted(r["tag"] for r in latest.collect()) == ["high", "new", "other app", "r", "some"]
    # Each task keeps one row per event before the shuffle.
    assert "WindowGroupLimit [app_id#" in latest._jdf.queryExecution().executedPlan().toString()


def test_distinct_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("a", None)], "x string, y int")
    assert distinct_rows(df).count() == 2
    assert distinct_rows(df).where(F.col("y").isNull()).count() == 1
