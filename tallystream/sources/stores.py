"""Reading the raw layer and the serving table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampType

from tallystream.schemas import RAW_COLUMNS, RAW_STORE_SCHEMA, SERVING_COLUMNS, SERVING_STORE_SCHEMA
from tallystream.sources import folders, snapshots


def scan_raw(spark: SparkSession, root: str) -> DataFrame:
    """25 raw columns plus event_date and hour, both text, from the path."""
    return spark.read.schema(RAW_STORE_SCHEMA).parquet(root).select(
        *RAW_COLUMNS, "event_date", "hour"
    )


def scan_raw_hour(spark: SparkSession, root: str, hour: datetime) -> DataFrame:
    """Every app's files for one UTC hour; no other hour's folder is listed or opened."""
    return scan_raw_hours(spark, root, [(f"{hour:%Y-%m-%d}", f"{hour:%H}")])


def scan_raw_hours(spark: SparkSession, root: str, hours: Sequence[tuple[str, str]]) -> DataFrame:
    """The folders of some (event_date, hour) pairs; pairs without a folder add no rows."""
    days: dict[str, list[str]] = {}
    for day, hour in hours:
        days.setdefault(day, []).append(hour)
    wanted = [f"{root}/app_id=*/event_date={day}/hour={{{','.join(own)}}}" for day, own in days.items()]
    there = [p for p in wanted if folders.matches(spark, p)]
    if not there:
        return spark.createDataFrame([], RAW_STORE_SCHEMA)
    rows = spark.read.schema(RAW_STORE_SCHEMA).option("basePath", root).parquet(*there)
    return rows.select(*RAW_COLUMNS, "event_date", "hour")


def scan_raw_days(spark: SparkSession, root: str, first: date, last: date) -> DataFrame:
    """The folders of the days from first to last, both included; no other day's are listed."""
    days = [f"{first + timedelta(days=n):%Y-%m-%d}" for n in range((last - first).days + 1)]
    there = [p for day in days if folders.matches(spark, p := f"{root}/app_id=*/event_date={day}")]
    if not there:
        return spark.createDataFrame([], RAW_STORE_SCHEMA)
    rows = spark.read.schema(RAW_STORE_SCHEMA).option("basePath", root).parquet(*there)
    return rows.select(*RAW_COLUMNS, "event_date", "hour")


def hour_file_count(raw: DataFrame) -> DataFrame:
    """Files and rows per (event_date, hour). Reads no data columns."""
    return (
        raw.groupBy("event_date", "hour", F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("rows"))
        .groupBy("event_date", "hour")
        .agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
    )


def raw_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count("*").alias("rows"))


def scan_serving(spark: SparkSession, root: str, first_day: str | date | None = None, last_day: str | date | None = None) -> DataFrame:
    """The serving table's 26 columns, as its newest version lists them.

    Only folders of days from first_day to last_day are given to Spark; event_date filters skip
    other days' folders too.
    """
    return scan_serving_folders(spark, root, serving_folders(spark, root, first_day, last_day)).select(*SERVING_COLUMNS)


def serving_folders(spark: SparkSession, root: str, first_day: str | date | None = None, last_day: str | date | None = None) -> dict[str, dict]:
    """Folders that hold rows of these days, both included, with facts about each."""
    low, high = str(first_day or ""), str(last_day or "~")
    return {n: f for n, f in snapshots.latest(spark, root).folders.items() if low <= day_of(n) <= high}


def scan_serving_folders(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """Rows of some folders with load_hour and row_hash."""
    return snapshots.scan(spark, root, SERVING_STORE_SCHEMA, names)


def day_of(folder: str) -> str:
    """Day of the rows in a folder of the serving table."""
    return folder.rsplit("event_date=", 1)[1]


def model_schema(promoted: list[tuple[str, str]]) -> StructType:
    return StructType(
        RAW_STORE_SCHEMA.fields
        + [StructField(name, _type(type_name)) for name, type_name in promoted]
        + [StructField("received_at_ts", TimestampType()), StructField("received_hour", StringType())]
    )


def _type(type_name: str | None) -> DataType:
    return StringType() if type_name is None else DataType.fromDDL(type_name)
