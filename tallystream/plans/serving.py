"""Serving table: typed, free of exact copies, loaded hour by hour or as files come in.

Layout: seg=<load>/event_date=<day>/, folders that never change; the newest snapshot lists
those that count (see sources.snapshots), with the raw hours each holds. A load adds a
segment. Reloading an hour replaces its rows wherever they lie: a folder that holds nothing
else is left out, one that holds other hours too is written again without them. Small folders of
closed days are compacted into one folder a day, whose files hold ranges of the table's sort
order, so that row-group statistics skip other apps and names.

Rows keep load_hour, the raw hour they came from, and row_hash, a digest of their raw row, by
which a load of single files knows what the table holds already.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions.json_text import uint_or_zero
from tallystream.functions.times import event_date_of, parse_best_effort_ms
from tallystream.operators.dedupe import distinct_rows, distinct_wide_rows
from tallystream.schemas import JSON_COLUMNS, RAW_COLUMNS, SERVING_COLUMNS, SERVING_SORT
from tallystream.sources import folders, snapshots
from tallystream.sources.stores import day_of, scan_raw_hour, scan_serving_folders

FILE_BYTES = 128 << 20  # that a compacted file should fill

# --- fixed values: text columns that are never NULL in the serving table ----------
FILLED = ["app_id", "environment", "event_name", "user_pseudo_id"]
FILLED_STRICT = FILLED + JSON_COLUMNS + ["ingest_request_id", "nats_stream"]
# --- end of fixed values ------------------------------------------------------------


def typed_times(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "event_time": parse_best_effort_ms(F.col("event_timestamp")),
            "received_time": parse_best_effort_ms(F.col("received_at")),
        }
    )


def drop_unparseable_time(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("event_time").isNotNull())


def serving_projection(typed: DataFrame, *keep: str, filled: list[str] = FILLED) -> DataFrame:
    """The 26 columns in order; NULL becomes '' in the filled ones."""

    def column(name: str) -> Column:
        if name == "event_date":
            return event_date_of(F.col("event_time")).alias(name)
        if name in filled:
            return F.coalesce(F.col(name), F.lit("")).alias(name)
        return F.col(name)

    return typed.select(*[column(c) for c in SERVING_COLUMNS], *keep)


def serving_rows(raw: DataFrame) -> DataFrame:
    """Raw rows -> serving rows.

    The time filter comes before the distinct: it depends on the row alone, and
    rows it drops need no shuffle.
    """
    return serving_projection(distinct_rows(drop_unparseable_time(typed_times(raw))))


def stored_rows(raw: DataFrame, scratch: str | None = None) -> DataFrame:
    """Rows of the raw layer, with its partition columns -> rows as the table stores them.

    For much of the layer, `scratch` is a folder for digests of copied rows, needed as long as the rows are: then
    no whole row is shuffled to find copies, only to be written.
    """
    if scratch is None:
        unique = distinct_rows(drop_unparseable_time(typed_times(raw)))
    else:
        unique = drop_unparseable_time(typed_times(distinct_wide_rows(raw, scratch)))
    unique = unique.withColumns({"load_hour": load_hour_key(), "row_hash": row_hash()}).drop("event_date")
    return serving_projection(unique, "load_hour", "row_hash")


def row_hash() -> Column:
    """128 bits of a raw row; JSON text names the members, so a NULL shifts nothing."""
    return F.unhex(F.md5(F.to_json(F.struct(*RAW_COLUMNS))))


def strict_serving_rows(raw: DataFrame) -> DataFrame:
    """Variant with no NULL JSON text and an unsigned sequence."""
    unique = distinct_rows(drop_unparseable_time(typed_times(raw.select(*RAW_COLUMNS))))
    unsigned = unique.withColumn("nats_sequence", uint_or_zero(F.col("nats_sequence").cast("string")))
    return serving_projection(unsigned, filled=FILLED_STRICT)


def write_segment(rows: DataFrame, root: str, name: str, in_ranges: bool = False) -> dict[str, dict]:
    """Write stored rows as a new segment; facts about its folders, by their paths in the table.

    Rebalancing by the day gives a small day one file, and AQE splits a day that is too large
    for one task. `in_ranges` deals rows out by the sort order instead, so that each file of a day
    has a range of its own. Rows in a file are sorted either way.
    """
    spark, path = rows.sparkSession, f"{root}/seg={name}"
    order = ["event_date", *[c for c in SERVING_SORT if c != "event_date"]]
    dealt = rows.repartitionByRange(*order) if in_ranges else rows.hint("rebalance", "event_date")
    dealt.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("event_date").options(**folders.STAGED).parquet(path)
    files: dict[str, list[int]] = {}
    for file, size in folders.sizes(spark, path).items():
        files.setdefault(file.split("/")[0], []).append(size)
    written = scan_serving_folders(spark, root, [f"seg={name}/{folder}" for folder in sorted(files)])
    found = written.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(
        F.sort_array(F.collect_set("load_hour")).alias("hours"), F.count("*").alias("rows"))
    return {
        f"seg={name}/event_date={r.day}": {
            "hours": r.hours, "rows": r.rows, "files": len(files[f"event_date={r.day}"]), "bytes": sum(files[f"event_date={r.day}"])
        }
        for r in found.collect()
    }


def replace_hours(spark: SparkSession, root: str, rows: DataFrame | None, hours: Sequence[str]) -> None:
    """Put `rows` (stored rows; None: none) in place of all rows of the load hours `hours`. A load
    that fails leaves the table as it was, and is simply run again."""
    wanted = set(hours)

    def change(base: snapshots.Snapshot) -> dict[str, dict] | None:
        held = {n: f for n, f in base.folders.items() if wanted.intersection(f["hours"])}
        shared = [n for n, f in held.items() if not wanted.issuperset(f["hours"])]
        rest = scan_serving_folders(spark, root, shared).where(~F.col("load_hour").isin(sorted(wanted))) if shared else None
        parts = [p for p in (rows, rest) if p is not None]
        if not parts and not held:
            return None
        added = write_segment(reduce(DataFrame.unionByName, parts), root, uuid.uuid4().hex) if parts else {}
        return {n: f for n, f in base.folders.items() if n not in held} | added

    forget_files(spark, root, wanted)
    snapshots.update(spark, root, change)


def append_new_rows(
    rows: DataFrame, root: str, name: str, hours: Sequence[str], sinks: Sequence[Callable[[DataFrame], None]] = ()
) -> int:
    """Add the stored rows that the table does not hold yet as segment `name`; how many. rows: of
    the load hours `hours`. Sinks get the added rows before they count; if the load is run again, under the same
    name, so are they. A segment that counts already is not added again.

    Only the digests of folders with these hours are read, and no row of them is written again.
    """
    spark, wanted = rows.sparkSession, set(hours)
    added: dict[str, dict] = {}

    def change(base: snapshots.Snapshot) -> dict[str, dict] | None:
        added.clear()
        if any(n.startswith(f"seg={name}/") for n in base.folders):
            return None
        held = [n for n, f in base.folders.items() if wanted.intersection(f["hours"])]
        fresh = rows
        if held:
            known = scan_serving_folders(spark, root, held).select("load_hour", "row_hash")
            fresh = rows.join(known, ["load_hour", "row_hash"], "left_anti").select(*rows.columns)
        added.update(write_segment(fresh, root, name))
        if not added:
            return None
        for sink in sinks:
            sink(scan_serving_folders(spark, root, sorted(added)))
        return base.folders | added

    snapshots.update(spark, root, change)
    return sum(f["rows"] for f in added.values())


def compact_serving(spark: SparkSession, root: str, before: str | date, file_bytes: int = FILE_BYTES) -> list[str]:
    """Compact the days before `before` that lie in several folders, or in more files than their
    bytes fill; the days. Rows stay the same. Late rows of a compacted day add small folders to
    it, and the next run takes them in."""
    done: list[str] = []

    def change(base: snapshots.Snapshot) -> dict[str, dict] | None:
        days: dict[str, list[str]] = {}
        for name in base.folders:
            if day_of(name) < str(before):
                days.setdefault(day_of(name), []).append(name)
        facts = lambda names, fact: sum(base.folders[n][fact] for n in names)
        # Ranges need not end with a day, so a day has up to two files more than it fills.
        loose = {d: n for d, n in days.items() if len(n) > 1 or facts(n, "files") > facts(n, "bytes") // file_bytes + 3}
        done[:] = sorted(loose)
        if not loose:
            return None
        old = [n for names in loose.values() for n in names]
        added = write_segment(scan_serving_folders(spark, root, old), root, uuid.uuid4().hex, in_ranges=True)
        return {n: f for n, f in base.folders.items() if n not in old} | added

    snapshots.update(spark, root, change)
    return done


def load_hours_of(raw: DataFrame) -> list[str]:
    """Load hours of the raw rows, read off their partitions."""
    found = raw.select(load_hour_key().alias("h")).distinct().collect()
    return sorted(r.h for r in found)


def load_hour_key() -> Column:
    return F.concat_ws("-", "event_date", "hour")


def load_serving(raw: DataFrame, root: str) -> None:
    """Load everything in `raw`."""
    spark, scratch = raw.sparkSession, f"{root}/_copies-{uuid.uuid4().hex}"
    try:
        replace_hours(spark, root, stored_rows(raw, scratch), load_hours_of(raw))
    finally:
        folders.remove(spark, scratch)


def load_hour(spark: SparkSession, raw_root: str, serving_root: str, hour: datetime) -> bool:
    """Load one raw hour; False when it has no rows, and then has none in the table either."""
    raw = scan_raw_hour(spark, raw_root, hour)
    found = not raw.isEmpty()
    replace_hours(spark, serving_root, stored_rows(raw) if found else None, [f"{hour:%Y-%m-%d-%H}"])
    return found


# The ledger: which raw files an hour was loaded from, a list for each load. It only spares reading
# files again; what the table holds is told by its rows' digests.


def _ledger(root: str, hour: str) -> str:
    return f"{root}/_ledger/load_hour={hour}"


def known_files(spark: SparkSession, root: str, hours: Sequence[str]) -> set[str]:
    """Raw files of these hours that were loaded one by one."""

    def of(hour: str) -> list[str]:
        folder = _ledger(root, hour)
        return [f for n in folders.children(spark, folder) for f in json.loads(folders.read_text(spark, f"{folder}/{n}"))]

    with ThreadPoolExecutor(16) as pool:
        return {file for files in pool.map(of, hours) for file in files}


def note_files(spark: SparkSession, root: str, name: str, files: dict[str, list[str]]) -> None:
    """Note the files of each hour that the load `name` has brought into the table."""

    def note(hour: str) -> None:
        folders.make(spark, _ledger(root, hour))
        folders.put_new(spark, f"{_ledger(root, hour)}/{name}.json", json.dumps(sorted(files[hour])))

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(note, files))


def forget_files(spark: SparkSession, root: str, hours: Iterable[str]) -> None:
    """Hours that are replaced whole may lose rows that single files brought."""
    if folders.exists(spark, f"{root}/_ledger"):
        folders.remove(spark, *[_ledger(root, hour) for hour in hours])


def late_rows(raw: DataFrame) -> DataFrame:
    """Rows the load of their own hour, run within the hour after it, could not see."""
    hour = F.to_timestamp(F.concat_ws(" ", "event_date", "hour"), "yyyy-MM-dd HH")
    received = F.date_trunc("HOUR", parse_best_effort_ms(F.col("received_at")))
    return raw.where(received > hour + F.expr("INTERVAL 1 HOUR"))
