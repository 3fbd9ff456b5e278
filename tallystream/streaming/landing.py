"""Streams that land and load."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tallystream.operators.flatten import decodable, flatten_raw, with_partition
from tallystream.plans.landing import land_raw, numbered_files, partitioned_raw
from tallystream.plans.serving import append_new_rows, known_files, note_files, stored_rows
from tallystream.schemas import (
    FLUSH_INTERVAL_SECONDS,
    MAX_DELIVERIES,
    MAX_FILE_BYTES,
    MAX_FILE_ROWS,
    RAW_COLUMNS,
    RAW_PARTITIONS,
    RAW_STORE_SCHEMA,
)
from tallystream.sources import folders


def trigger(every_seconds: int | None) -> dict:
    """A trigger that drains and stops (None), or one that goes on."""
    return {"availableNow": True} if every_seconds is None else {"processingTime": f"{every_seconds} seconds"}


def stream_name(checkpoint: str) -> str:
    """Short name of the stream that has this checkpoint."""
    return f"s{zlib.crc32(checkpoint.encode()):08x}"


def land_batch(
    batch: DataFrame, root: str, stream: str, number: int, max_rows_per_file: int = 0, max_bytes_per_file: int = 0
) -> None:
    """Append a micro-batch's decodable messages to the raw layer, once however often it runs.

    It is written beside the layer as a batch landing writes it (small partitions one file, large
    ones as many as they fill, or as the bounds ask for) and then moved in under names that tell the
    stream and the batch. Once it is written whole, a batch that runs again after a failure only moves
    what is still to be moved, and a mark tells that all was. The layer keeps no log of the stream (one
    mark, the last batch's), and batch landings and other streams may write to it too.
    """
    spark, mark = batch.sparkSession, f"{stream}-{number:010d}"
    staged, landed = f"{root}/_landing-{mark}", f"{root}/_landed-{mark}"
    if folders.exists(spark, landed):
        return
    if not folders.exists(spark, f"{staged}/_SUCCESS"):
        messages = batch.where(decodable(F.col("value")))
        if max_rows_per_file or max_bytes_per_file:
            messages = messages.withColumn("message_bytes", F.octet_length("value"))
            flat = f"{root}/_flat-{mark}"
            # Parsed and written once; sizing the files reads it twice.
            with_partition(flatten_raw(messages, "message_bytes")).write.mode("overwrite").parquet(flat)
            rows = spark.read.parquet(flat)
            sizes = rows.groupBy(*RAW_PARTITIONS).agg(F.count("*").alias("n"), F.sum("message_bytes").alias("b"))
            beyond = F.lit(False)
            for size, bound in (("n", max_rows_per_file), ("b", max_bytes_per_file)):
                beyond = beyond | (F.col(size) > bound) if bound else beyond
            if sizes.where(beyond).isEmpty():
                land_raw(rows.drop("message_bytes"), staged, mode="overwrite", **folders.STAGED)
            else:
                keys = [*RAW_PARTITIONS, "file"]
                rows = numbered_files(rows, max_rows_per_file, max_bytes_per_file)
                writer = rows.write.mode("overwrite").partitionBy(*keys)
                writer.options(compression="snappy", **folders.STAGED).parquet(staged)
            folders.remove(spark, flat)
        else:
            land_raw(partitioned_raw(flatten_raw(messages)), staged, mode="overwrite", **folders.STAGED)
    moves = []
    for path in folders.leaf_files(spark, staged):
        folder, name = path.rsplit("/", 1)
        inside, _, file = folder.partition("/file=")
        moves.append((f"{staged}/{path}", f"{root}/{inside}/{mark}-{file + '-' if file else ''}{name}"))
    folders.move(spark, moves)
    folders.make(spark, landed)
    folders.remove(spark, staged, f"{root}/_landed-{stream}-{number - 1:010d}")


def land_or_set_aside(
    batch: DataFrame, root: str, stream: str, number: int, max_rows_per_file: int = 0, max_bytes_per_file: int = 0,
    max_deliveries: int = MAX_DELIVERIES, max_set_aside: int = 100,
) -> int:
    """Land a micro-batch; if it fails `max_deliveries` times, land all of it but the messages that fail.

    The batch is halved by a digest of its messages, and what fails is halved again, so one message costs
    as many rounds as the batch has doublings. Messages that fail alone go to root/_quarantine as they came;
    how many is returned. More than `max_set_aside` are no bad messages but a fault of the store or the cluster: then the
    failure is raised, nothing is set aside, and the batch comes again. What has landed by then does not land twice.
    """
    spark, bounds = batch.sparkSession, (max_rows_per_file, max_bytes_per_file)
    failure: Exception | None = None
    for _ in range(max_deliveries):
        try:
            land_batch(batch, root, stream, number, *bounds)
            return 0
        except Exception as error:  # whatever it is, the batch is delivered again
            failure = error
    digest = F.xxhash64("value", "stream", "sequence")
    bad, marks, parts = [], [], [(1, 0), (1, 1)]
    while parts:
        depth, rest = parts.pop()
        part = batch.where(F.pmod(digest, F.lit(1 << depth)) == rest)
        size = part.count()
        if not size:
            continue
        try:
            land_batch(part, root, f"{stream}-half{depth}.{rest}", number, *bounds)
            marks.append(f"{root}/_landed-{stream}-half{depth}.{rest}-{number:010d}")
        except Exception:
            if size == 1 or depth == 48:
                bad.append((depth, rest, size))
                if sum(b[2] for b in bad) > max_set_aside:
                    raise failure from None
            else:
                parts += [(depth + 1, rest), (depth + 1, rest + (1 << depth))]
    aside = reduce(Column.__or__, [F.pmod(digest, F.lit(1 << d)) == r for d, r, _ in bad], F.lit(False))
    batch.where(aside).withColumn("failure", F.lit(str(failure)[:1000])).write.mode("overwrite").parquet(
        f"{root}/_quarantine/{stream}-{number:010d}")
    folders.make(spark, f"{root}/_landed-{stream}-{number:010d}")
    leftover = [n for n in folders.children(spark, root) if n.endswith(f"-{number:010d}") and n.startswith((f"_landing-{stream}", f"_flat-{stream}"))]
    folders.remove(spark, *marks, *[f"{root}/{n}" for n in leftover])
    return sum(b[2] for b in bad)


def read_quarantine(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Messages that streams into this layer have set aside, with the failure of their batch."""
    schema = StructType([*schema.fields, StructField("failure", StringType())])
    if not folders.exists(spark, f"{root}/_quarantine"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/_quarantine/{n}" for n in folders.children(spark, f"{root}/_quarantine")])


def land_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    every_seconds: int | None = FLUSH_INTERVAL_SECONDS,
    max_rows_per_file: int = MAX_FILE_ROWS,
    max_bytes_per_file: int = MAX_FILE_BYTES,
    max_deliveries: int = MAX_DELIVERIES,
) -> StreamingQuery:
    """Append decodable messages to the raw layer, micro-batch by micro-batch.

    every_seconds=None drains what is there and stops. The bounds of a file are the published ones; a
    large layer is better off with larger ones, or none (0). A message that makes its micro-batch fail
    `max_deliveries` times is set aside, and the stream goes on.
    """
    stream = stream_name(checkpoint)
    bounds = (max_rows_per_file, max_bytes_per_file, max_deliveries)
    return (
        messages.writeStream.foreachBatch(lambda batch, n: land_or_set_aside(batch, root, stream, n, *bounds) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every_seconds))
        .start()
    )


def dead_letters_stream(
    messages: DataFrame, root: str, checkpoint: str, every_seconds: int | None = FLUSH_INTERVAL_SECONDS
) -> StreamingQuery:
    """Set aside, for good, the messages that cannot become rows."""
    return (
        messages.where(~decodable(F.col("value")))
        .writeStream.format("json")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every_seconds))
        .start()
    )


def load_files(
    batch: DataFrame, number: int, stream: str, raw_root: str, serving_root: str,
    sinks: Sequence[Callable[[DataFrame, int], None]] = (),
) -> int:
    """Add the rows of a micro-batch's raw files that the serving table does not hold; how many.

    batch: event_date, hour and file. Files that the ledger knows are not read again.
    """
    spark = batch.sparkSession
    hours: dict[str, list[str]] = {}
    for row in batch.distinct().collect():  # one row for each of at most max_files_per_trigger files
        hours.setdefault(f"{row.event_date}-{row.hour}", []).append(unquote(row.file))
    known = known_files(spark, serving_root, sorted(hours))
    hours = {h: new for h, files in hours.items() if (new := [f for f in files if f not in known])}
    if not hours:
        return 0
    raw = spark.read.schema(RAW_STORE_SCHEMA).option("basePath", raw_root).parquet(*sorted(f for x in hours.values() for f in x))
    rows = stored_rows(raw.select(*RAW_COLUMNS, "event_date", "hour"))
    name = f"{stream}-{number:010d}"
    numbered = [lambda rows, sink=sink: sink(rows, number) for sink in sinks]
    added = append_new_rows(rows, serving_root, name, sorted(hours), numbered)
    note_files(spark, serving_root, name, hours)
    return added


def load_stream(
    spark: SparkSession,
    raw_root: str,
    serving_root: str,
    checkpoint: str,
    every_seconds: int | None = None,
    max_files_per_trigger: int = 10_000,
    sinks: Sequence[Callable[[DataFrame, int], None]] = (),
) -> StreamingQuery:
    """Keep the serving table up to date with every new raw file, late ones included.

    Each micro-batch adds a segment with the rows of its files that the table does not hold, so a late
    file costs its own rows and the digests of its hours, and no hour is written again. A micro-batch
    that runs again adds nothing, and neither does a stream that starts anew over files that are loaded.
    Small folders are left to `compact_serving`.

    `sinks` get each micro-batch's new rows and its number before they count, and the same rows under the
    same number again if it fails: rollups that are kept per micro-batch follow the table exactly.
    """
    arrivals = (
        spark.readStream.schema(RAW_STORE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(raw_root)
        .select("event_date", "hour", F.col("_metadata.file_path").alias("file"))
    )
    stream = stream_name(checkpoint)
    return (
        arrivals.writeStream.foreachBatch(lambda batch, n: load_files(batch, n, stream, raw_root, serving_root, sinks) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every_seconds))
        .start()
    )
