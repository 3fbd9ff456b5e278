"""Base model: latest version of every event, chosen JSON fields as columns.

Layout: received_hour=/event_date=. The model is refreshed by received time in
whole hours, so a refresh replaces whole received_hour folders and never rewrites
a day of older rows; event_date filters still skip folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystream.functions.json_text import safe_cast, variant_value
from tallystream.operators.dedupe import dedupe_latest
from tallystream.operators.filters import filter_received_range, instant_lit
from tallystream.schemas import MODEL_LOOKBACK_HOURS, PROMOTED_FIELDS, RAW_COLUMNS
from tallystream.session import scratch_path
from tallystream.sources import folders, snapshots
from tallystream.sources.stores import model_schema, scan_raw_days

MODEL_PARTITIONS = ["received_hour", "event_date"]
Field = tuple[str, str, str, str | None]


def enabled_fields(names: Sequence[str] | None = None) -> list[Field]:
    """The fields promoted by default, or the named ones; an empty list is fine."""
    if names is None:
        return [f[:4] for f in PROMOTED_FIELDS if f[4]]
    known = {f[0]: f[:4] for f in PROMOTED_FIELDS}
    return [known[n] for n in names]


def promote_fields(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Add one column per field. Each JSON column is parsed once for all its fields."""
    sources = sorted({f[1] for f in fields})
    parsed = rows.withColumns({f"_{s}": F.try_parse_json(s) for s in sources}) if sources else rows
    return parsed.select(
        *rows.columns,
        *[
            safe_cast(variant_value(F.col(f"_{source}"), path), type_name).alias(name)
            for name, source, path, type_name in fields
        ],
    )


def base_model(
    raw: DataFrame, start: datetime, end: datetime, fields: Sequence[Field] | None = None
) -> DataFrame:
    """27 raw fields, the promoted ones, received_at_ts; rows received in [start, end)."""
    fields = enabled_fields() if fields is None else fields
    latest = dedupe_latest(filter_received_range(raw, start, end))
    return promote_fields(latest, fields).select(
        *RAW_COLUMNS, "event_date", "hour", *[f[0] for f in fields], "received_at_ts"
    )


def scan_model(spark: SparkSession, root: str, fields: Sequence[Field] | None = None) -> DataFrame:
    fields = enabled_fields() if fields is None else fields
    schema = model_schema([(f[0], f[3]) for f in fields])
    return spark.read.schema(schema).parquet(root)


def _hour_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd-HH")


def refresh_model(
    spark: SparkSession,
    raw_root: str,
    model_root: str,
    start: datetime,
    end: datetime,
    lookback_hours: int = MODEL_LOOKBACK_HOURS,
    fields: Sequence[Field] | None = None,
) -> None:
    """Recompute [start - lookback, end) by received time and replace those rows.

    Rows of a boundary hour outside an unaligned range are carried over. The
    folders written are observed during the write; a folder of the range that got
    no rows this time, because its events now have later versions, is emptied.
    Running the same refresh again gives the same table.
    """
    fields = enabled_fields() if fields is None else fields
    first = start - timedelta(hours=lookback_hours)
    raw = scan_raw_days(spark, raw_root, first.date(), end.date())
    rows = base_model(raw, first, end, fields)
    rows = rows.withColumn("received_hour", _hour_key(F.col("received_at_ts")))
    schema = model_schema([(f[0], f[3]) for f in fields])
    lo, hi = f"{first:%Y-%m-%d-%H}", f"{end - timedelta(microseconds=1):%Y-%m-%d-%H}"
    # Only the folders of the range are listed, of the raw layer and of the model.
    hours = [n for n in folders.children(spark, model_root) if lo <= n.removeprefix("received_hour=") <= hi]
    old = snapshots.scan(spark, model_root, schema, hours)
    old_folders = _folders(old)
    carries = not (_whole_hour(first) and _whole_hour(end))
    if carries:
        outside = (F.col("received_at_ts") < instant_lit(first)) | (
            F.col("received_at_ts") >= instant_lit(end)
        )
        boundary = F.col("received_hour").isin(lo, hi)
        # Kept apart, since their own folders are about to be replaced.
        carried = scratch_path(spark, "carried-rows")
        old.where(boundary & outside).write.parquet(carried)
        rows = rows.unionByName(spark.read.schema(old.schema).parquet(carried))
    written: set[tuple[str, ...]] = set()
    if not (old_folders or raw.inputFiles()):
        # Nothing there and nothing to add: an empty table, should there be none.
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*MODEL_PARTITIONS).parquet(model_root)
    elif raw.inputFiles() or carries:
        seen = Observation()
        observed = rows.observe(
            seen, F.collect_set(F.struct(*[F.col(c) for c in MODEL_PARTITIONS])).alias("folders")
        )
        (
            observed.hint("rebalance", *MODEL_PARTITIONS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MODEL_PARTITIONS)
            .parquet(model_root)
        )
        written = {tuple(f) for f in seen.get["folders"]}
    nothing = spark.createDataFrame([], schema).drop(*MODEL_PARTITIONS)
    for received_hour, event_date in sorted(set(old_folders) - written):
        nothing.write.mode("overwrite").parquet(
            f"{model_root}/received_hour={received_hour}/event_date={event_date}"
        )


def _whole_hour(moment: datetime) -> bool:
    return moment == moment.replace(minute=0, second=0, microsecond=0)


def _folders(rows: DataFrame) -> list[tuple[str, str]]:
    """Folder names of the refreshed range: hours of the range times its few days."""
    return [tuple(r) for r in rows.select(*MODEL_PARTITIONS).distinct().collect()]
