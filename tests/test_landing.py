"""Bounded files and messages that are set aside."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tallystream.plans.landing import numbered_files
from tallystream.schemas import MESSAGE_SCHEMA
from tallystream.sources.stores import scan_raw
from tallystream.streaming import landing

SCHEMA = "value string, stream string, sequence string, published_at timestamp"


def message(n: int, app: str = "a", hour: int = 9, pad: int = 0) -> tuple:
    body = {"event_id": str(n), "app_id": app, "event_timestamp": f"2026-04-13T{hour:02d}:00:00Z", "event_params": {"x": "y" * pad}}
    return (json.dumps(body), "EVENTS", str(n), None)


def land(spark, tmp_path, rows, **options):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").json(f"{tmp_path}/log")
    log = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/log")
    landing.land_stream(log, f"{tmp_path}/raw", f"{tmp_path}/c", every_seconds=None, **options).awaitTermination()
    return scan_raw(spark, f"{tmp_path}/raw")


def test_files_are_bounded_by_rows_and_bytes(spark, tmp_path):
    """A hot hour of small messages, one of large ones, one message beyond the bound, and small hours."""
    rows = [message(n) for n in range(2500)] + [message(5000 + n, hour=10, pad=900) for n in range(100)]
    rows += [message(6000, hour=11, pad=30_000), message(6001, hour=12), message(6002, hour=12), message(6003, "b c/d")]
    got = land(spark, tmp_path, rows, max_rows_per_file=1000, max_bytes_per_file=20_000)
    assert got.count() == len(rows) and sorted(int(r.event_id) for r in got.collect()) == sorted(int(r[2]) for r in rows)
    size = {int(r[2]): len(r[0]) for r in rows}
    largest = {9: 200, 10: 1200, 11: 40_000, 12: 200}
    files = got.select("hour", "app_id", F.col("event_id").cast("int").alias("n"), F.col("_metadata.file_path").alias("f")).groupBy("hour", "app_id", "f").agg(F.collect_list("n").alias("ids")).collect()
    assert all(len(f.ids) <= 1000 and sum(size[i] for i in f.ids) < 20_000 + largest[int(f.hour)] for f in files)
    count = lambda hour, app: sum(f.hour == hour and f.app_id == app for f in files)
    assert count("09", "a") <= 2500 * 110 / 20_000 + 4 and count("12", "a") == count("11", "a") == count("09", "b c/d") == 1


def test_a_hot_folder_is_numbered_by_many_tasks(spark):
    rows = spark.range(20_000).selectExpr(
        "'hot' as app_id", "'2026-04-13' as event_date", "'09' as hour", "'S' as nats_stream", "id as nats_sequence", "'e' as event_id", "10 as message_bytes")
    got = numbered_files(rows, 100, 0, share_rows=1000)
    files = got.groupBy("file").count().collect()
    assert len({f.file.split("-")[0] for f in files}) == 20 and max(f["count"] for f in files) <= 100 and sum(f["count"] for f in files) == 20_000
    whole = numbered_files(rows.limit(50), 100, 0).select("file").distinct().collect()
    assert [r.file for r in whole] == ["0-0-0"]


def broken(flatten):
    """A flattening that fails on some messages."""

    def run(messages, *keep):
        poison = F.col("value").contains("poison")
        checked = messages.withColumn("value", F.when(poison, F.raise_error(F.lit("bad message"))).otherwise(F.col("value")))
        return flatten(checked, *keep)

    return run


@pytest.mark.parametrize("bounds", [{}, {"max_rows_per_file": 0, "max_bytes_per_file": 0}])
def test_one_bad_message_does_not_stop_the_stream(spark, tmp_path, monkeypatch, bounds):
    monkeypatch.setattr(landing, "flatten_raw", broken(landing.flatten_raw))
    rows = [message(n) for n in range(20)] + [message(99, "poison"), message(98, "poison")]
    got = land(spark, tmp_path, rows, max_deliveries=2, **bounds)
    assert sorted(int(r.event_id) for r in got.collect()) == list(range(20))
    aside = landing.read_quarantine(spark, f"{tmp_path}/raw", MESSAGE_SCHEMA).collect()
    assert sorted(r.sequence for r in aside) == ["98", "99"] and all("bad message" in r.failure for r in aside)
    # The stream goes on, and the batch does not come again.
    assert land(spark, tmp_path, [message(50)], max_deliveries=2, **bounds).count() == 21
    assert not [p.name for p in (tmp_path / "raw").iterdir() if p.name.startswith(("_landing", "_flat")) or "half" in p.name]


def test_a_fault_of_the_store_sets_nothing_aside(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "flatten_raw", broken(landing.flatten_raw))
    batch = spark.createDataFrame([message(n, "poison") for n in range(4)], SCHEMA)
    with pytest.raises(Exception, match="bad message"):
        landing.land_or_set_aside(batch, f"{tmp_path}/raw", "s", 0, max_deliveries=1, max_set_aside=2)
    assert landing.read_quarantine(spark, f"{tmp_path}/raw", MESSAGE_SCHEMA).count() == 0
