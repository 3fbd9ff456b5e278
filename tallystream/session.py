"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results, not just speed.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key is legal; the last value wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that let one plan serve a laptop and a large cluster: AQE sizes the
# partitions from the shuffle itself and splits the ones a hot key makes too big.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Noting the call site of every column costs a third of the time to build a plan, and a
    # stream builds its plan for each micro-batch.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Shuffle files go when their query ends, rather than when the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def build_session(name: str = "tallystream", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_SETTINGS, **SCALE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session somebody else built the settings that results depend on."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files behind. For steps that run one after another, each of which
    shuffles whole messages: without it the disk holds the shuffles of all of them."""
    was = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if was is None else spark.conf.set(FREE_SHUFFLES, was)


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a local master, where driver and executors share one machine, may fall
    back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tallystream-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
