"""Resend removal on a stream.

The rule needs the seconds at which a key was kept before. Rather than one call per key into a
stateful function, every micro-batch runs the batch operator against a table of kept seconds,
so all the work stays in joins and windows.

That table is cut into slots of time. A micro-batch reads the slots that its messages, or their window,
fall into, and adds a folder to the slots of what it kept: it writes nothing again, whatever was
kept before, and messages out of order or with times far ahead cost their own slots only.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystream.operators.dedupe import dedupe_window
from tallystream.schemas import DEDUP_WINDOW_SECONDS
from tallystream.sources import folders
from tallystream.streaming.landing import trigger

SLOT_SECONDS = 6 * 3600


def recent_seconds(spark: SparkSession, root: str, number: int, slots: list[int], keys: tuple[str, ...]) -> DataFrame | None:
    """Seconds (keys, kept_at) that micro-batches before `number` kept in these slots."""
    held = set(folders.children(spark, f"{root}/recent"))
    there = [f"{root}/recent/slot={s}" for s in slots if f"slot={s}" in held]
    if not there:
        return None
    schema = "".join(f"{k} string, " for k in keys) + "kept_at bigint, slot bigint, batch bigint"
    rows = spark.read.schema(schema).option("basePath", f"{root}/recent").parquet(*there)
    return rows.where(F.col("batch") < number).select(*keys, "kept_at")


def marked_rows(rows: DataFrame, kept: DataFrame, row: str, path: str, most: int = 2_000_000) -> DataFrame:
    """Those of `rows` whose number `row` is in `kept`, without a shuffle of whole rows.

    Kept numbers become one bit each, 64 in a word, and the words are written to `path`. Up to `most` words (numbers that run
    on give one for every 64 rows) go to all tasks; more than that are left to the planner.
    """
    spark, number = rows.sparkSession, F.col(row)
    bit = F.expr(f"shiftleft(1L, cast(`{row}` & 63 as int))")
    kept.groupBy(F.shiftright(number, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits")).write.mode("overwrite").parquet(path)
    words = spark.read.schema("_word bigint, _bits bigint").parquet(path)
    if words.count() <= most:
        words = F.broadcast(words)
    marked = (F.shiftright(rows[row], 6) == words["_word"]) & (F.getbit(words["_bits"], rows[row].bitwiseAND(F.lit(63)).cast("int")) == 1)
    return rows.join(words, marked, "left_semi")


def dedupe_batch(
    batch: DataFrame,
    number: int,
    root: str,
    window: int = DEDUP_WINDOW_SECONDS,
    keys: tuple[str, ...] = ("app_id", "event_id"),
    at: str = "published_at",
    order: tuple[str, ...] = ("sequence",),
    sink: Callable[[DataFrame, int], None] | None = None,
    row: str | None = None,
) -> None:
    """Micro-batch `number` of `dedupe_stream`. It reads `batch` twice.

    `row`, if given, is a column of whole numbers from 0 that no two rows share, the same whenever `batch` is read. Then kept/ holds
    only what resends are found by, and the sink gets whole rows from `batch`, which are not shuffled.
    """
    spark, second = batch.sparkSession, F.unix_timestamp(at)
    slot = lambda seconds: F.floor(seconds / SLOT_SECONDS)
    # One row per slot; the newest time is among them.
    near = F.explode(F.sequence(slot(second - window), slot(second + window))).alias("slot")
    span = batch.select(at, near).groupBy("slot").agg(F.max(at).alias("newest")).collect()
    newest = max((r.newest for r in span), default=None)
    timed = batch.withColumn(at, F.coalesce(F.col(at), F.lit(newest), F.timestamp_seconds(F.lit(0))))
    slots = sorted({r.slot for r in span} or {-1, 0})
    recent = recent_seconds(spark, root, number, slots, keys)
    kept_path = f"{root}/kept/batch={number}"
    told_by = timed if row is None else timed.select(*dict.fromkeys([*keys, at, *order, row]))
    dedupe_window(told_by, window, keys, at, order, recent).write.mode("overwrite").parquet(kept_path)
    kept = spark.read.schema(told_by.schema).parquet(kept_path)
    if sink is not None:
        sink(kept if row is None else marked_rows(timed, kept, row, f"{root}/marks"), number)
        folders.remove(spark, f"{root}/kept/batch={number - 1}")
    seen = kept.select(*keys, second.alias("kept_at"), slot(second).alias("slot"), F.lit(number).alias("batch"))
    (
        seen.hint("rebalance", "slot")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slot", "batch")
        .parquet(f"{root}/recent")
    )


def dedupe_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    window: int = DEDUP_WINDOW_SECONDS,
    keys: tuple[str, ...] = ("app_id", "event_id"),
    at: str = "published_at",
    order: tuple[str, ...] = ("sequence",),
    every_seconds: int | None = None,
    sink: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Write kept messages to root/kept/batch=<n>; kept seconds live in root/recent.

    A message is kept unless its key was kept less than `window` seconds before it or after it, by a
    micro-batch before or by its own, which is walked in order of time. So the result is the batch operator's
    if messages that lie within a window of each other come in order; others may come in any order. A
    message without a time counts as the newest of its batch.

    A micro-batch that fails half-way is simply run again: it does not read what it added itself, and adds the
    same. Kept seconds stay until `forget_before` removes their slots.

    `sink` gets what each batch kept, and its number; one that has landed needs no folder any
    more, so only the last stays. A batch that runs again calls it again.
    """
    return (
        messages.writeStream.foreachBatch(lambda batch, n: dedupe_batch(batch, n, root, window, keys, at, order, sink))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every_seconds))
        .start()
    )


def forget_before(spark: SparkSession, root: str, moment: datetime) -> int:
    """Forget what was kept in slots that end before `moment`; how many slots. Resends of older messages, should
    any still come, are kept then."""
    last = int(moment.timestamp()) // SLOT_SECONDS
    old = [n for n in folders.children(spark, f"{root}/recent") if n.startswith("slot=") and int(n[5:]) < last]
    folders.remove(spark, *[f"{root}/recent/{n}" for n in old])
    return len(old)


def read_kept(spark, root: str, schema) -> DataFrame:
    """What all batches kept, of a stream without a sink."""
    return spark.read.schema(schema).parquet(f"{root}/kept/batch=*")
