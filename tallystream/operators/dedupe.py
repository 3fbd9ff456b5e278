"""Three kinds of duplicate removal.

distinct_rows   exact copies of a whole row (distinct_wide_rows: the same for wide rows with few copies)
dedupe_latest   the latest version of an event
dedupe_window   resends within a time window (batch form; see streaming.dedupe)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.functions.json_text import safe_int
from tallystream.schemas import DEDUP_WINDOW_SECONDS


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Copies are combined map-side, so a row copied very often costs one row per task."""
    return rows.dropDuplicates()


def distinct_wide_rows(rows: DataFrame, path: str, most: int = 1_000_000) -> DataFrame:
    """The rows of `distinct_rows`, for wide rows of which few have copies.

    Only digests meet in a shuffle. A row whose digest no other row has is no copy and stays where it is; the
    others are compared whole. Digests found more than once are written to `path`; if they are more than `most`,
    too many for every task to hold, all rows are compared whole. `rows` is read three times and has no
    columns of floating numbers, whose zeros are equal with different digests.
    """
    spark, digest = rows.sparkSession, F.xxhash64(*rows.columns)
    found = rows.select(digest.alias("_digest")).groupBy("_digest").agg(F.count("*").alias("_n"))
    found.where("_n > 1").select("_digest").write.mode("overwrite").parquet(path)
    repeated = spark.read.schema("_digest bigint").parquet(path)
    if repeated.count() > most:
        return distinct_rows(rows)
    marked, repeated = rows.withColumn("_digest", digest), F.broadcast(repeated)
    alone = marked.join(repeated, "_digest", "left_anti").select(*rows.columns)
    return alone.unionByName(distinct_rows(marked.join(repeated, "_digest", "left_semi").select(*rows.columns)))


def dedupe_latest(rows: DataFrame) -> DataFrame:
    """One row per (app_id, event_id): latest received, then sequence, time, request.

    The rank filter becomes a group limit before the shuffle: each task sends one
    row per event at most, so a heavily resent event does not pile up in one task.
    """
    latest = Window.partitionBy("app_id", "event_id").orderBy(
        F.desc_nulls_last("received_at_ts"),
        F.desc_nulls_last(safe_int(F.col("nats_sequence").cast("string"))),
        F.desc_nulls_last("event_timestamp"),
        F.desc_nulls_last("ingest_request_id"),
    )
    return rows.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def walk_runs(later: DataFrame, keys: list[str], window: int) -> DataFrame:
    """Seconds kept in turn after the openers of long runs, as (keys, _second).

    Each run is read in order of time and held a batch of rows at a time, so its length does not
    matter; different runs of a key may be walked by different tasks.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last = None, 0
        for batch in batches:
            seconds, runs = batch.column("_second").to_numpy(), batch.column("_run").dictionary_encode()
            codes = runs.indices.to_numpy()
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            kept = []
            for start, end in zip(starts, [*starts[1:], len(codes)], strict=True):
                run = runs.dictionary[int(codes[start])].as_py()
                if run != current:
                    current, last = run, batch.column("_opener")[int(start)].as_py()
                at = start + np.searchsorted(seconds[start:end], last + window)
                while at < end:
                    kept.append(at)
                    last = int(seconds[at])
                    at = start + np.searchsorted(seconds[start:end], last + window)
            yield batch.select([*keys, "_second"]).take(pa.array(kept, pa.int64()))

    named = later.select(*keys, "_opener", "_second", F.to_json(F.struct(*keys, "_opener")).alias("_run"))
    ordered = named.repartition("_run").sortWithinPartitions("_run", "_second")
    return ordered.mapInArrow(walk, later.select(*keys, "_second").schema)


def dedupe_window(
    messages: DataFrame,
    window: int = DEDUP_WINDOW_SECONDS,
    keys: tuple[str, ...] = ("app_id", "event_id"),
    at: str = "published_at",
    order: tuple[str, ...] = ("sequence",),
    recent: DataFrame | None = None,
) -> DataFrame:
    """Keep a message unless its key was kept less than `window` seconds before.

    A dropped resend does not extend the window. The window is a whole number of
    seconds and so is the clock. That makes the first message of each (key,
    second) its only candidate, found by a group limit before the shuffle, and
    bounds one key at one row per second of the time covered.

    A candidate a full window after the one before it is kept whatever came
    earlier and opens a run; within a window of its opener everything else is
    dropped. Only candidates later than that, in runs of resends longer than the
    window, depend on each other and are walked in order.

    `recent` (keys, kept_at) holds the seconds at which keys were kept earlier, as many a key as there
    are: a message within the window of one, before or after it, is dropped. It may be large, so the join
    with it is left to the planner; it meets on windows of time, in each of which a key has few seconds.
    """
    keys = list(keys)
    first = Window.partitionBy(*keys, "_second").orderBy(at, *order)
    candidates = (
        messages.withColumn("_second", F.unix_timestamp(at))
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_rank")
    )
    if recent is not None:
        stretch = lambda second: F.floor(second / window)
        near = F.explode(F.sequence(stretch(F.col("kept_at")) - 1, stretch(F.col("kept_at")) + 1)).alias("_stretch")
        earlier = recent.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("kept_at").alias("_kept_at"), near)
        candidates = candidates.withColumn("_own", stretch(F.col("_second")))
        # Both sides deal out by key and stretch of time, so a key with a third of all rows is spread.
        same = [candidates[k].eqNullSafe(earlier[f"_{k}"]) for k in keys]
        close = F.abs(candidates["_second"] - earlier["_kept_at"]) < window
        candidates = candidates.join(earlier, [*same, candidates["_own"] == earlier["_stretch"], close], "left_anti").drop("_own")
    in_order = Window.partitionBy(*keys).orderBy("_second")
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(
        F.col("_second") - F.lag("_second").over(in_order) >= window, F.lit(True)
    )
    runs = (
        candidates.withColumn("_opener", F.when(opens, F.col("_second")))
        .withColumn("_opener", F.last("_opener", ignorenulls=True).over(up_to_here))
    )
    openers = runs.where("_second = _opener")
    later = runs.where(F.col("_second") >= F.col("_opener") + window)
    walked = walk_runs(later, keys, window)
    same = [later[c].eqNullSafe(walked[c]) for c in (*keys, "_second")]
    kept_later = later.join(walked, same, "left_semi")
    return openers.unionByName(kept_later).drop("_second", "_opener")
