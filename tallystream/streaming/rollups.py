"""Rollups that follow the serving table: what each micro-batch's new rows add up to, kept apart.

A rollup has a fold, from serving rows to small rows that can be merged, and a merge, by which the
small rows of any micro-batches become those of all their rows. A micro-batch adds a folder with its own
fold and writes nothing else again, so late rows cost what they are; reading merges what is there.
Small folders are merged into larger ones now and then; a large one is left alone.

As sinks of `load_stream` rollups get exactly the rows that the table gains. A micro-batch that runs
again finds its folder listed and writes it again; when its folder was merged already, the batch's number tells.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallystream.operators import retention, sessions, values
from tallystream.sources import folders, snapshots

MERGED_BYTES = 256 << 20


@dataclass(frozen=True)
class Rollup:
    root: str
    schema: str
    fold: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]

    def sink(self, stream: str) -> Callable[[DataFrame, int], None]:
        """What `load_stream` calls with the new rows of each micro-batch. stream: a name that no
        other stream into this rollup has."""

        def add(rows: DataFrame, number: int) -> None:
            spark, name = rows.sparkSession, f"part={stream}-{number:010d}"
            held = snapshots.latest(spark, self.root).folders
            if any(f["through"].get(stream, -1) >= number for n, f in held.items() if n != name):
                return
            self.fold(rows).write.mode("overwrite").parquet(f"{self.root}/{name}")
            facts = {"through": {stream: number}, "bytes": sum(folders.sizes(spark, f"{self.root}/{name}").values())}
            snapshots.update(spark, self.root, lambda base: base.folders | {name: facts})

        return add

    def read(self, spark: SparkSession) -> DataFrame:
        """The small rows of everything folded so far, merged."""
        names = snapshots.latest(spark, self.root).folders
        return self.merge(snapshots.scan(spark, self.root, StructType.fromDDL(self.schema), sorted(names)))

    def compact(self, spark: SparkSession, merged_bytes: int = MERGED_BYTES) -> int:
        """Merge folders of less than `merged_bytes` into one; how many. The last folder of each stream stays as
        it is, since its micro-batch may run again."""
        done: list[str] = []

        def change(base: snapshots.Snapshot) -> dict[str, dict] | None:
            newest: dict[str, int] = {}
            for facts in base.folders.values():
                for stream, number in facts["through"].items():
                    newest[stream] = max(number, newest.get(stream, -1))
            last = {f"part={stream}-{number:010d}" for stream, number in newest.items()}
            done[:] = sorted(n for n, f in base.folders.items() if n not in last and f["bytes"] < merged_bytes)
            if len(done) < 2:
                done.clear()
                return None
            name = f"part=merged-{uuid.uuid4().hex}"
            rows = snapshots.scan(spark, self.root, StructType.fromDDL(self.schema), done)
            self.merge(rows).write.parquet(f"{self.root}/{name}")
            through: dict[str, int] = {}
            for facts in (base.folders[n] for n in done):
                for stream, number in facts["through"].items():
                    through[stream] = max(number, through.get(stream, -1))
            facts = {"through": through, "bytes": sum(folders.sizes(spark, f"{self.root}/{name}").values())}
            return {n: f for n, f in base.folders.items() if n not in done} | {name: facts}

        snapshots.update(spark, self.root, change)
        return len(done)


def sessions_rollup(root: str, gap_seconds: int = sessions.SESSION_GAP_SECONDS) -> Rollup:
    """Parts of sessions; `sessions.sessions_of` makes sessions of what it reads."""
    return Rollup(root, sessions.PARTS, lambda rows: sessions.session_parts(rows, gap_seconds),
                  lambda parts: sessions.merge_parts(parts, gap_seconds))


def retention_rollup(root: str) -> Rollup:
    """Active days of actors; `retention.retention_table` makes a table of what it reads."""
    return Rollup(root, retention.BITS, retention.active_days, retention.merge_days)


def values_rollup(root: str, path: str, json_column: str = "event_params_json") -> Rollup:
    """Daily values of a number in the events' JSON."""
    return Rollup(root, values.VALUES, lambda rows: values.daily_values(rows, path, json_column), values.merge_values)
