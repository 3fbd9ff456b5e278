"""Folders of a table: which exist, and putting staged ones in their place.

Everything goes through Hadoop's file system calls, so it works where Spark's readers do.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), made


def matches(spark: SparkSession, pattern: str) -> bool:
    system, path = _path(spark, pattern)
    found = system.globStatus(path)
    return found is not None and len(found) > 0


def exists(spark: SparkSession, path: str) -> bool:
    system, made = _path(spark, path)
    return system.exists(made)


def make(spark: SparkSession, path: str) -> None:
    system, made = _path(spark, path)
    system.mkdirs(made)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, made = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(made)) if system.exists(made) else []


def remove(spark: SparkSession, *paths: str) -> None:
    if paths:
        system = _path(spark, paths[0])[0]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda p: system.delete(_path_only(spark, p), True), paths))


def _path_only(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def move(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Rename (source, target) pairs, several at a time; folders of the targets are made if
    need be, and no target may exist."""
    moves = list(moves)
    if not moves:
        return
    system = _path(spark, moves[0][1])[0]
    parents = {target.rsplit("/", 1)[0] for _, target in moves}
    def rename(pair: tuple[str, str]) -> None:
        source, target = pair
        if not system.rename(_path_only(spark, source), _path_only(spark, target)):
            raise OSError(f"could not move {source} to {target}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda folder: system.mkdirs(_path_only(spark, folder)), parents))
        list(pool.map(rename, moves))


# Tasks put their files in place themselves, for folders that nobody reads before they are whole.
STAGED = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def leaf_files(spark: SparkSession, path: str) -> list[str]:
    """Data files in `path` and its key=value folders, as paths from there. One listing for each depth."""
    system, made = _path(spark, path)
    if not system.exists(made):
        return []
    base, found, inner = system.resolvePath(made).toUri().getPath().rstrip("/"), [], ""
    while inner is not None:
        listed = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(system.globStatus(_path_only(spark, f"{path}/{inner}*")))
        names = [p.toString() for p in listed or ()]
        names = [n[n.index(base) + len(base):].strip("/") for n in names]
        last = [n.rsplit("/", 1)[-1] for n in names]
        found += [n for n, own in zip(names, last) if "=" not in own and not own.startswith(("_", "."))]
        inner = f"{inner}*=*/" if any("=" in own for own in last) else None
    return sorted(found)


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the data files in all folders below `path`, by their paths from there."""
    system, made = _path(spark, path)
    if not system.exists(made):
        return {}
    base, found = system.resolvePath(made).toUri().getPath(), {}
    files = system.listFiles(made, True)
    while files.hasNext():
        file = files.next()
        name = file.getPath().toUri().getPath()[len(base):].strip("/")
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            found[name] = file.getLen()
    return found


def read_text(spark: SparkSession, path: str) -> str:
    system, made = _path(spark, path)
    stream = system.open(made)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole; False if there is one of this name already."""
    system, target = _path(spark, path)
    beside = _path_only(spark, f"{path.rsplit('/', 1)[0]}/_new-{uuid.uuid4().hex}")
    stream = system.create(beside)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if not system.exists(target) and system.rename(beside, target):
        return True
    system.delete(beside, False)
    return False
