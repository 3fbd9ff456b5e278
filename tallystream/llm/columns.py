"""Arrow batches as numpy arrays, so that text work runs over whole batches at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of text that one numpy pass works on: its arrays then stay in a few dozen MB.
RANGE_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Let the Python workers import this package wherever the driver was started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)


def with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """Schema of df plus one column; a column that already has the name is replaced."""
    fields = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*fields, T.StructField(name, kind)])


def plain_text(df: DataFrame, column: str) -> DataFrame:
    """NULL texts become empty ones."""
    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit("")))


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, and its n + 1 offsets into them."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    held = array.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(data: np.ndarray, offsets: np.ndarray, limit: int = RANGE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut the bytes into ranges of about `limit`, between rows, or in a longer row between
    an ASCII letter and a blank; a row without such a place stays whole."""
    begin, end = 0, int(offsets[-1])
    while begin < end:
        to = int(offsets[np.searchsorted(offsets, begin + limit, "right") - 1])
        if to <= begin:
            to = int(offsets[np.searchsorted(offsets, begin, "right")])
            for at in range(begin + limit // 2, to - 1, limit):
                near = data[at : min(at + limit, to)]
                letter = (near[:-1] | 0x20) - np.uint8(97) < 26
                if (found := np.flatnonzero(letter & (near[1:] == 0x20))).size:
                    to = at + int(found[-1]) + 1
                    break
        yield begin, to
        begin = to


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from its values laid end to end."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    if offsets[-1] >= 2**31:
        raise ValueError("a batch holds more than 2^31 values; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices begin[i], begin[i] + 1, .. of count[i] each, laid end to end."""
    before = np.cumsum(count) - count
    return np.repeat(begin - before, count) + np.arange(int(count.sum()))


def replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """The batch without a column of this name, and with the new one at the end."""
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], names=[*names, name])


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = RANGE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about a MB of text each, without copying; a longer row makes a slice of its own."""
    for batch in batches:
        _, offsets = text_buffer(batch.column(column))
        first = 0
        while first < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            to = min(max(to, first + 1), batch.num_rows)
            yield batch.slice(first, to - first)
            first = to
