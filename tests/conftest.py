from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallystream.session import build_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            # The tables are so small that one task would write them all.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare(session)
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of an expression over a list of texts."""

    def run(values, expression):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
        return [r[1] for r in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]

    return run
