"""Files that tasks write to and read from the folder all executors share."""

from __future__ import annotations

from pyarrow import fs


def open_root(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path in it; Spark's scheme names are understood."""
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    return fs.FileSystem.from_uri(uri)


def join(uri: str, name: str) -> str:
    return f"{uri.rstrip('/')}/{name}"
