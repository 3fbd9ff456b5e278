"""From request bodies to the raw layer in one stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystream.operators.geo import keep_networks
from tallystream.plans.collect import collect_messages
from tallystream.schemas import DEDUP_WINDOW_SECONDS, FLUSH_INTERVAL_SECONDS
from tallystream.session import freed_shuffles, scratch_path
from tallystream.streaming.dedupe import dedupe_batch
from tallystream.streaming.landing import land_or_set_aside, stream_name, trigger


def collect_stream(
    requests: DataFrame,
    keys: DataFrame,
    ranges: DataFrame | None,
    raw_root: str,
    state_root: str,
    checkpoint: str,
    window: int = DEDUP_WINDOW_SECONDS,
    every_seconds: int | None = FLUSH_INTERVAL_SECONDS,
    stream: str = "EVENTS",
    salt: str = "",
    **options,
) -> StreamingQuery:
    """Judge, enrich, remove resends and land requests as they arrive.

    A micro-batch's messages are written once to state_root/sent, since removing resends reads
    them twice; state_root also holds the recent keys. Resends are found from the keys and times alone, so
    whole messages are shuffled to be looked up and to be landed, and these shuffles go as their step ends. A micro-batch that fails half-way is run
    again and lands each message once; messages that keep failing are set aside in the raw layer. `options` go to `collect_messages`.
    """
    name = stream_name(checkpoint)
    # The country table is cut and written once, not in each micro-batch.
    networks = None if ranges is None else keep_networks(ranges, scratch_path(ranges.sparkSession, "networks"))

    def run(batch: DataFrame, number: int) -> None:
        sent = collect_messages(batch, keys, networks, salt, **options).withColumns(
            {"stream": F.lit(stream), "sequence": F.col("position").cast("string"), "row": F.monotonically_increasing_id()}
        )
        path = f"{state_root}/sent"
        with freed_shuffles(batch.sparkSession):
            sent.write.mode("overwrite").option("compression", "zstd").parquet(path)
            dedupe_batch(
                batch.sparkSession.read.schema(sent.schema).parquet(path), number, state_root, window,
                order=("request_id", "position"),
                sink=lambda kept, n: land_or_set_aside(kept, raw_root, name, n),
                row="row",
            )

    return (
        requests.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every_seconds))
        .start()
    )
