"""Token ids as Arrow stream files of equal-length sequences, with random access.

A file holds one run of the token stream, cut into sequences of `length` ids. Its record
batches have `per_batch` rows of two fixed-size-list columns: `tokens` (unsigned integers as
narrow as the vocabulary allows) and `mask` (one bit each, false where the last sequence is
filled up). All batches but the last take the same number of bytes, so the place of any
sequence follows from its number, and a memory-mapped file serves it without copying.

`write_tokens` sorts documents by id over range partitions (equal ids by a hash of the text,
so that even one id with a third of all rows is spread), encodes them, and writes one file a
partition. It returns the index of documents; `read_tokens` adds what the files hold.

Cases: NULL and empty texts are documents of one id, the end id; the string of an added token
becomes its id wherever it stands in a text; a NULL doc_id sorts first;
repeated rows each get their own span; an empty table gives an empty index; other columns
are not carried. A lost task writes its file anew under another name, and the index names the
files of the tasks that counted.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.columns import map_arrow, plain_text, small_batches, text_buffer
from tallystream.llm.pieces import PieceIds
from tallystream.llm.shared_files import join, open_root

INDEX = "shard int, file string, doc_id long, offset long, n_tokens long"


def id_type(size: int) -> pa.DataType:
    return pa.uint16() if size <= 1 << 16 else pa.uint32()


class TokenWriter:
    """Appends ids to one file; sequences are filled up at close only."""

    def __init__(self, sink, kind: pa.DataType, length: int, per_batch: int):
        self.kind, self.length, self.per_batch = kind, length, per_batch
        self.schema = pa.schema([("tokens", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = sink
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def append(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind.to_pandas_dtype()))
        self.n_held += len(ids)
        if self.n_held >= (most := self.length * self.per_batch):
            ids = np.concatenate(self.held)
            whole = len(ids) // most * most
            for at in range(0, whole, most):
                self.write(ids[at : at + most], most)
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (ids, mask)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            ids = np.concatenate(self.held)
            filled = np.zeros(-(-len(ids) // self.length) * self.length, ids.dtype)
            filled[: len(ids)] = ids
            self.write(filled, len(ids))
        self.stream.close()
        self.sink.close()


class TokenFile:
    """Random access to the sequences of one file; local files are mapped, not read."""

    def __init__(self, uri: str):
        system, path = open_root(uri)
        local = system.type_name == "local"
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.length = self.schema.field("tokens").type.list_size
        self.first = self.source.tell()
        self.size = self.source.size()
        self.stride, self.per_batch, self.kept = 0, 0, (-1, None)
        if (batch := self.batch(0)) is not None:
            self.stride, self.per_batch = self.source.tell() - self.first, batch.num_rows

    def batch(self, k: int) -> pa.RecordBatch | None:
        if self.kept[0] != k:
            self.source.seek(self.first + k * self.stride)
            message = pa.ipc.read_message(self.source) if self.source.tell() + 8 < self.size else None
            batch = pa.ipc.read_record_batch(message, self.schema) if message else None
            self.kept = (k, batch)
        return self.kept[1]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """The ids of sequence i as a view of the file, and its mask."""
        row = self.batch(i // self.per_batch).slice(i % self.per_batch, 1)
        return row.column("tokens").flatten().to_numpy(), row.column("mask").flatten()

    def span(self, start: int, count: int) -> np.ndarray:
        """Ids from place `start` of the file's run; one view if they lie in one batch."""
        most, parts = self.length * max(self.per_batch, 1), []
        while count > 0:
            ids = self.batch(start // most).column("tokens").flatten().to_numpy()
            part = ids[start % most : start % most + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint16), *parts])


@lru_cache(2)
def tokenizer_of(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(2)
def added_tokens(path: str) -> tuple[dict[bytes, int], re.Pattern | None, re.Pattern | None]:
    """Ids of the added tokens that stand wherever their string does, and patterns of these and of
    all others (those that take blanks with them, ask for whole words or for normalized text)."""
    plain, other = {}, []
    for id_, token in tokenizer_of(path).get_added_tokens_decoder().items():
        if text := token.content.encode():
            if token.lstrip or token.rstrip or token.single_word or token.normalized:
                other.append(text)
            else:
                plain[text] = id_
    either = lambda texts: re.compile(b"|".join(map(re.escape, sorted(texts, key=len, reverse=True)))) if texts else None
    return plain, either(plain), either(other)


@lru_cache(2)
def library_ids(path: str) -> PieceIds:
    """Ids by the tokenizers library, which gets each distinct pre-token once."""

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode() for p in pieces]
        found = [e.ids for e in tokenizer_of(path).encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((x for ids in found for x in ids), np.int32, int(count.sum())), count

    return PieceIds(encode, limit=1 << 21)


def text_ids(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows end to end, and how many each row has, as the library encodes whole texts:
    texts are cut at added tokens first, and what lies between is text of its own. A text with
    an added token that is more than its string goes to the library whole."""
    ids_of, plain, other = added_tokens(path)
    text = memoryview(data)
    rows = [(r, a, b) for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist()))]
    found = [m for _, a, b in rows for m in plain.finditer(text, a, b)] if plain and plain.search(text) else []
    begin, end = (np.array([f(m) for m in found], np.int64) for f in (re.Match.start, re.Match.end))
    cuts = np.unique(np.concatenate([offsets, begin, end]))
    ids, counts = library_ids(path).of_rows(data, cuts)
    if found:
        part = np.searchsorted(cuts, begin)
        between = np.ones(len(counts), bool)
        between[part] = False
        ids = ids[np.repeat(between, counts)]
        counts[part] = 0
        ids = np.insert(ids, np.cumsum(counts)[part], [ids_of[m[0]] for m in found])
        counts[part] = 1
    total = np.append(0, np.cumsum(counts))[np.searchsorted(cuts, offsets)]
    if other and other.search(text):
        parts = np.split(ids, total[1:-1])
        for r, a, b in rows:
            if other.search(text, a, b):
                parts[r] = np.array(tokenizer_of(path).encode(bytes(text[a:b]).decode(), add_special_tokens=False).ids, np.int32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    return ids, np.diff(total)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every row's ids with one more at its end."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def write_tokens(docs: DataFrame, root: str, tokenizer_path: str, end_id: int,
                 length: int = 2048, per_batch: int = 256) -> DataFrame:
    """Encode `text` in ascending doc_id order into files under `root`, a folder all executors
    share; a row for each document tells its shard, file, place in the file and count."""

    def run(batches):
        task = TaskContext.get()
        shard, name = task.partitionId(), f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.arrows"
        system, folder = open_root(root)
        writer, offset = None, 0
        most = max([end_id, *tokenizer_of(tokenizer_path).get_added_tokens_decoder()])
        kind = id_type(max(tokenizer_of(tokenizer_path).get_vocab_size(), most + 1))
        for batch in small_batches(batches, "text"):
            ids, counts = text_ids(tokenizer_path, *text_buffer(batch.column("text")))
            ids, counts = with_end(ids, counts, end_id)
            if writer is None:
                system.create_dir(folder, recursive=True)
                writer = TokenWriter(system.open_output_stream(f"{folder}/{name}"), kind, length, per_batch)
            writer.append(ids)
            places = offset + np.cumsum(counts) - counts
            offset += int(counts.sum())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard, np.int32)), pa.array([join(root, name)] * n, pa.string()),
                 batch.column("doc_id"), pa.array(places), pa.array(counts)],
                names=["shard", "file", "doc_id", "offset", "n_tokens"])
        if writer is not None:
            writer.close()

    tie = F.xxhash64("text")
    ordered = plain_text(docs.select(F.col("doc_id").cast("long"), "text"), "text")
    ordered = ordered.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    index = join(root, "index")
    map_arrow(ordered, run, INDEX).write.parquet(index)
    return docs.sparkSession.read.parquet(index)


def read_tokens(index: DataFrame, function, schema: str) -> DataFrame:
    """Read every document's ids back. function: takes the index batch and a generator of the
    ids of its rows (views of the files where they can be), and returns a batch of `schema`."""

    def run(batches):
        name, file = None, None
        for batch in batches:
            def each(batch=batch):
                nonlocal name, file
                columns = (batch.column(c).to_pylist() for c in ("file", "offset", "n_tokens"))
                for path, offset, count in zip(*columns):
                    if path != name:
                        name, file = path, TokenFile(path)
                    yield file.span(offset, count)

            yield function(batch, each())

    return map_arrow(index, run, schema)


def shard_starts(index: DataFrame) -> DataFrame:
    """Ids before each shard; one row per file of the run."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("in_shard"))
    before = F.sum("in_shard").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("shard", F.coalesce(before, F.lit(0)).alias("before"))


def load_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(join(root, "index"))
