"""Raw layer: Snappy Parquet under app_id=/event_date=/hour=."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.operators.flatten import with_partition
from tallystream.schemas import RAW_COLUMNS, RAW_PARTITIONS


def partitioned_raw(rows: DataFrame) -> DataFrame:
    return with_partition(rows).select(*RAW_COLUMNS, "event_date", "hour")


def land_raw(rows: DataFrame, root: str, max_rows_per_file: int = 0, mode: str = "append", **options: str) -> None:
    """Write raw rows (25 columns, or with event_date and hour already added).

    The rebalance gathers each partition's rows so that small ones get one file,
    and lets AQE split a partition that is far above the advisory size: the hour of
    an app with a third of all traffic is written by many tasks.
    """
    if "hour" not in rows.columns:
        rows = partitioned_raw(rows)
    writer = (
        rows.hint("rebalance", *RAW_PARTITIONS)
        .write.mode(mode)
        .partitionBy(*RAW_PARTITIONS)
        .options(compression="snappy", **options)
    )
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(root)


TASK_BYTES = 32 << 20  # of messages, a task that numbers and writes files


def numbered_files(
    rows: DataFrame, max_rows: int, max_bytes: int, share_rows: int = 100_000, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Raw rows with `message_bytes` -> rows with `file`: rows of one folder and file number are at most
    `max_rows`, and their messages at most `max_bytes` and one message more (0: no such bound).

    Numbers come from running sums within a share of a folder's rows. A folder has one share for
    every `share_rows` rows, or as many bytes as that many files hold, so a hot one is numbered and written by many tasks, and a
    small one is one file. Shares are dealt out once, to as many tasks as `task_bytes` of messages each ask for, so
    a task's rows fit its memory whatever the batch holds, and all rows of a file are in one task, which can
    write them as they come. `rows` is read three times.
    """
    sizes = rows.groupBy(*RAW_PARTITIONS).agg(F.count("*").alias("_rows"), F.sum("message_bytes").alias("_bytes"))
    files = F.lit(share_rows // max(1, max_rows or share_rows) + 1)
    shares = F.greatest(F.col("_rows") / share_rows, F.col("_bytes") / (files * max_bytes) if max_bytes else F.lit(0.0))
    sizes = sizes.select(*[F.col(c).alias(f"_{c}") for c in RAW_PARTITIONS], F.ceil(shares).alias("_shares"))
    same = [rows[c].eqNullSafe(sizes[f"_{c}"]) for c in RAW_PARTITIONS]
    dealt = rows.join(sizes, same).withColumn("_share", F.pmod(F.xxhash64("nats_stream", "nats_sequence", "event_id"), F.col("_shares")))
    total = rows.agg(F.sum("message_bytes")).first()[0] or 0
    dealt = dealt.repartition(math.ceil(total / task_bytes) or 1, *RAW_PARTITIONS, "_share")
    share = Window.partitionBy(*RAW_PARTITIONS, "_share").orderBy("nats_sequence", "event_id")
    before = share.rowsBetween(Window.unboundedPreceding, -1)
    by_rows = F.floor((F.row_number().over(share) - 1) / max_rows) if max_rows else F.lit(0)
    by_bytes = F.floor(F.coalesce(F.sum("message_bytes").over(before), F.lit(0)) / max_bytes) if max_bytes else F.lit(0)
    number = F.concat_ws("-", F.col("_share").cast("string"), by_rows.cast("string"), by_bytes.cast("string"))
    return dealt.withColumn("file", number).select(*rows.columns, "file").drop("message_bytes")
