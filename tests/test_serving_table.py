"""The serving table's snapshots, compaction, corrections and loads of single files."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from tallystream.plans import serving
from tallystream.plans.landing import land_raw
from tallystream.sources import snapshots
from tallystream.sources.stores import scan_raw, scan_serving, serving_folders
from tallystream.streaming.landing import load_stream
from tests.test_layers import raw


def at(n: int, hour: int, day: int = 13, **changes):
    return {"event_id": str(n), "event_timestamp": f"2026-04-{day:02d}T{hour:02d}:{n % 60:02d}:00Z", **changes}


def ids(spark, root, *days):
    return sorted(int(r["event_id"]) for r in scan_serving(spark, root, *days).collect())


def load_all(spark, raw_root, root, checkpoint, sinks=()):
    load_stream(spark, raw_root, root, checkpoint, sinks=sinks).awaitTermination()


def test_compaction_bounds_folders_and_keeps_rows(spark, tmp_path):
    raw_root, root = f"{tmp_path}/raw", f"{tmp_path}/table"
    land_raw(raw(spark, *[at(n, n // 3 % 24, 12 + n % 3) for n in range(90)]), raw_root)
    for day in (12, 13, 14):
        for hour in range(0, 24, 6):
            serving.load_hour(spark, raw_root, root, datetime(2026, 4, day, hour))
    before = scan_serving(spark, root)
    rows = sorted(map(str, before.collect()))
    assert len(serving_folders(spark, root, "2026-04-13", "2026-04-13")) == 4
    assert serving.compact_serving(spark, root, "2026-04-14") == ["2026-04-12", "2026-04-13"]
    assert sorted(map(str, scan_serving(spark, root).collect())) == rows
    assert len(serving_folders(spark, root, "2026-04-12", "2026-04-13")) == 2
    assert len(serving_folders(spark, root)) == 6  # the open day as it was
    assert serving.compact_serving(spark, root, "2026-04-14") == []
    # A query that began before still reads its own folders; vacuum takes them away.
    assert sorted(map(str, before.collect())) == rows
    assert snapshots.vacuum(spark, root, keep=1)
    assert sorted(map(str, scan_serving(spark, root).collect())) == rows
    assert len(os.listdir(f"{root}/_snapshots")) == len([n for n in os.listdir(f"{root}/_snapshots") if n.endswith(".crc")]) + 1


def test_a_compacted_hour_is_corrected_without_its_neighbours(spark, tmp_path):
    raw_root, root = f"{tmp_path}/raw", f"{tmp_path}/table"
    land_raw(raw(spark, *[at(n, n % 3) for n in range(12)]), raw_root)
    serving.load_serving(scan_raw(spark, raw_root), root)
    serving.compact_serving(spark, root, "2026-05-01")
    land_raw(raw(spark, at(100, 1), at(101, 1)), f"{tmp_path}/fixed")
    assert serving.load_hour(spark, f"{tmp_path}/fixed", root, datetime(2026, 4, 13, 1))
    assert ids(spark, root) == [n for n in range(12) if n % 3 != 1] + [100, 101]
    assert not serving.load_hour(spark, f"{tmp_path}/fixed", root, datetime(2026, 4, 13, 2))
    assert ids(spark, root) == [0, 3, 6, 9, 100, 101]
    facts = list(snapshots.latest(spark, root).folders.values())
    assert sum(f["rows"] for f in facts) == 6 and {h for f in facts for h in f["hours"]} == {"2026-04-13-00", "2026-04-13-01"}


def test_a_late_file_adds_its_own_rows_only(spark, tmp_path):
    raw_root, root, odd = f"{tmp_path}/raw", f"{tmp_path}/table", "a/b c%"
    land_raw(raw(spark, *[at(n, 9, app_id=odd) for n in range(5)]), raw_root)
    load_all(spark, raw_root, root, f"{tmp_path}/c")
    first = snapshots.latest(spark, root).folders
    # A late file of the same hour: a copy of a row that is there, a new row twice.
    land_raw(raw(spark, at(2, 9, app_id=odd), at(7, 9, app_id=odd), at(7, 9, app_id=odd)), raw_root)
    added = []
    load_all(spark, raw_root, root, f"{tmp_path}/c", [lambda rows, n: added.append((n, [r["event_id"] for r in rows.collect()]))])
    assert added == [(1, ["7"])] and ids(spark, root) == [0, 1, 2, 3, 4, 7]
    after = snapshots.latest(spark, root).folders
    assert first.items() <= after.items() and len(after) == len(first) + 1
    # Compaction in between, a rerun of the last batch, and a stream that starts anew.
    serving.compact_serving(spark, root, "2026-05-01")
    for name in os.listdir(f"{tmp_path}/c/commits"):
        if "1" in name:
            os.remove(f"{tmp_path}/c/commits/{name}")
    version = snapshots.latest(spark, root).version
    load_all(spark, raw_root, root, f"{tmp_path}/c")
    load_all(spark, raw_root, root, f"{tmp_path}/other")
    assert ids(spark, root) == [0, 1, 2, 3, 4, 7] and snapshots.latest(spark, root).version == version
    # An hour that is replaced forgets its files: they may bring back what it lost.
    land_raw(raw(spark, at(3, 9, app_id=odd)), f"{tmp_path}/fixed")
    serving.load_hour(spark, f"{tmp_path}/fixed", root, datetime(2026, 4, 13, 9))
    assert ids(spark, root) == [3]
    load_all(spark, raw_root, root, f"{tmp_path}/third")
    assert ids(spark, root) == [0, 1, 2, 3, 4, 7]


def test_a_failed_sink_leaves_the_table_as_it_was(spark, tmp_path):
    raw_root, root, calls = f"{tmp_path}/raw", f"{tmp_path}/table", []
    land_raw(raw(spark, at(1, 9)), raw_root)

    def sink(rows, number):
        calls.append((number, rows.count()))
        if len(calls) == 1:
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        load_all(spark, raw_root, root, f"{tmp_path}/c", [sink])
    assert ids(spark, root) == []
    load_all(spark, raw_root, root, f"{tmp_path}/c", [sink])
    assert ids(spark, root) == [1] and calls == [(0, 1), (0, 1)]


def test_of_two_writers_one_tries_again(spark, tmp_path):
    root = f"{tmp_path}/table"
    base = snapshots.latest(spark, root)
    snapshots.commit(spark, root, base, {"a": {}})
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, root, base, {"b": {}})
    seen = []

    def change(now):
        seen.append(now.version)
        if len(seen) == 1:
            snapshots.commit(spark, root, now, now.folders | {"c": {}})
        return now.folders | {"b": {}}

    assert snapshots.update(spark, root, change).folders == {"a": {}, "b": {}, "c": {}} and seen == [1, 2]


def test_days_are_read_from_their_folders_only(spark, tmp_path):
    raw_root, root = f"{tmp_path}/raw", f"{tmp_path}/table"
    land_raw(raw(spark, *[at(n, 3, 10 + n) for n in range(6)]), raw_root)
    serving.load_serving(scan_raw(spark, raw_root), root)
    assert ids(spark, root, "2026-04-12", "2026-04-13") == [2, 3]
    files = scan_serving(spark, root, "2026-04-12", "2026-04-13").inputFiles()
    assert len(files) == 2 and all("event_date=2026-04-1" in f for f in files)
    assert ids(spark, f"{tmp_path}/none") == []
