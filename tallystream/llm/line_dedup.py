"""Line dedup over a sharded minimal perfect hash of the lines that repeat.

1. Every line of at least `MIN_CHARS` characters is hashed to 128 bits, and the hashes are
   written once, without the lines.
2. One aggregate finds the hashes held by two documents or more, with the smallest of those
   documents and the number of lines.
3. These hashes are cut into shards of about `SHARD_KEYS`. Each gets a minimal perfect hash
   (levels of bits: a key rests at the first level at which it meets no other) and, in its
   order, three compact arrays: 64-bit fingerprints, counts, and keepers (the document whose
   lines stay). A shard is one file in the shared folder.
4. Line hashes are dealt out by range of (shard, document), so that a line in a third of all
   documents is spread over as many tasks as its rows fill. Each task maps the shards of its
   range one after the other and probes the arrays; a stranger passes the fingerprint with a
   chance of 2^-64.
5. The places to drop, one list a document, meet the texts again.

Cases: NULL and empty texts are one empty line; a line repeated inside one document only
stays; a NULL doc_id counts as the smallest id; rows that repeat a doc_id count as one
document, and each loses its own lines; an empty table gives an empty table; other columns are
kept, those with the names of the outputs are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.columns import importable, map_arrow, plain_text, small_batches, text_buffer
from tallystream.llm.pieces import mixed
from tallystream.llm.shared_files import join, open_root

MIN_CHARS = 10
SHARD_KEYS = 1 << 16
NULL_ID = -(1 << 63)
# Fixed value: the blanks of the contract.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line: stripped of blanks, A-Z in lower case."""
    return [line.strip(BLANKS) for line in text.lower().split(b"\n")]


def long_enough(key: bytes) -> bool:
    return len(key) >= 4 * MIN_CHARS or len(key) >= MIN_CHARS and len(key.decode()) >= MIN_CHARS


def hashed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, place in the document, and both halves of the line's hash."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            data, offsets = text_buffer(batch.column("text"))
            raw, digests, rows, places = data.tobytes(), [], [], []
            for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                for place, key in enumerate(line_keys(raw[a:b])):
                    if long_enough(key):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        places.append(place)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(np.array(rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(np.array(places, np.int32)),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                names=["doc_id", "text_hash", "place", "h1", "h2"])

    return map_arrow(docs, run, "doc_id long, text_hash long, place int, h1 long, h2 long")


class PerfectHash:
    """A minimal perfect hash of distinct pairs of 64-bit halves, as one array of bits a level."""

    GAMMA, MOST = 2, 64

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [0]
        for bits in levels:
            self.before.append(self.before[-1] + int(bits.sum()))
        self.ranks = [np.cumsum(bits) - bits for bits in levels]

    @staticmethod
    def slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
        both = mixed(h1.view(np.uint64) ^ salt) + mixed(h2.view(np.uint64) + salt)
        return (mixed(both) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels = []
        while len(h1):
            if len(levels) == cls.MOST:
                raise ValueError("the keys of a perfect hash must be distinct")
            size = cls.GAMMA * len(h1)
            slot = cls.slots(h1, h2, len(levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            levels.append(alone)
            left = ~alone[slot]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The index of each key; of a stranger any index, or -1."""
        out, todo = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, bits in enumerate(self.levels):
            slot = self.slots(h1[todo], h2[todo], level, len(bits))
            here = bits[slot]
            out[todo[here]] = self.before[level] + self.ranks[level][slot[here]]
            todo = todo[~here]
        return out


class Shard:
    """Perfect hash of the line hashes; fingerprints (their second halves), counts, keepers."""

    def __init__(self, perfect: PerfectHash, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.perfect, self.prints, self.counts, self.keepers = perfect, prints, counts, keepers

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> Shard:
        perfect = PerfectHash.build(h1, h2)
        order = np.argsort(perfect.find(h1, h2))
        return cls(perfect, h2[order], np.minimum(counts[order], 2**32 - 1).astype(np.uint32), keepers[order])

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in the shard, and the keepers of those."""
        at = self.perfect.find(h1, h2)
        found = at >= 0
        found[found] = self.prints[at[found]] == h2[found]
        return found, self.keepers[at[found]]

    def save(self, uri: str, name: str, attempt: int) -> None:
        system, folder = open_root(uri)
        system.create_dir(folder, recursive=True)
        arrays = [*self.perfect.levels, self.prints, self.counts, self.keepers]
        parts = [np.packbits(a) if a.dtype == bool else a for a in arrays]
        head = pa.array([len(a) for a in arrays], pa.int64())
        temporary = f"{folder}/.{name}-{attempt}"
        with system.open_output_stream(temporary) as out:
            out.write(np.array([len(head), *head.to_pylist()], np.int64).tobytes())
            for part in parts:
                out.write(np.ascontiguousarray(part).tobytes())
        system.move(temporary, f"{folder}/{name}")  # a second attempt puts the same bytes there

    @classmethod
    def load(cls, uri: str, name: str) -> Shard:
        system, folder = open_root(uri)
        with system.open_input_file(f"{folder}/{name}") as file:
            raw = file.readall()
        sizes = np.frombuffer(raw, np.int64, int(np.frombuffer(raw, np.int64, 1)[0]), 8)
        at, arrays = 8 + sizes.nbytes, []
        for i, n in enumerate(sizes.tolist()):
            last = i - len(sizes)
            kind = {-3: np.int64, -2: np.uint32, -1: np.int64}.get(last, np.uint8)
            stored = np.frombuffer(raw, kind, n if last >= -3 else -(-n // 8), at)
            at += stored.nbytes
            arrays.append(stored if last >= -3 else np.unpackbits(stored, count=n).astype(bool))
        return cls(PerfectHash(arrays[:-3]), *arrays[-3:])


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}"


def build_index(repeated: DataFrame, root: str, shards: int) -> None:
    """Write one file for each shard of the repeated hashes (h1, h2, lines, keeper)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                column = lambda c, b=batch: b.column(c).to_numpy(zero_copy_only=False)
                made = Shard.build(column("h1"), column("h2"), column("lines"), column("keeper"))
                made.save(root, shard_name(int(batch.column("shard")[0].as_py())), TaskContext.get().taskAttemptId())
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["keys"])

    def whole(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()
        return pa.Table.from_batches(run(batch), pa.schema([("keys", pa.int64())]))

    keyed = repeated.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    importable(repeated.sparkSession)
    keyed.groupBy("shard").applyInArrow(whole, "keys long").write.format("noop").mode("overwrite").save()


def dropped_lines(lines: DataFrame, root: str, shards: int) -> DataFrame:
    """The places of lines that go: doc_id, hash of the text, place."""

    def run(batches):
        held, shard = -1, None
        for batch in batches:
            column = lambda c, b=batch: b.column(c).to_numpy(zero_copy_only=False)
            ids, h1, h2 = column("shard"), column("h1"), column("h2")
            own = column("owner")
            for part in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(ids)) + 1):
                if not part.size:
                    continue
                if held != ids[part[0]]:
                    held = int(ids[part[0]])
                    shard = Shard.load(root, shard_name(held))
                found, keepers = shard.probe(h1[part], h2[part])
                part = part[found]
                part = part[own[part] != keepers]
                yield batch.take(pa.array(part)).select(["doc_id", "text_hash", "place"])

    keyed = lines.withColumns({
        "shard": F.pmod("h1", F.lit(shards)).cast("int"), "owner": F.coalesce("doc_id", F.lit(NULL_ID))})
    dealt = keyed.repartitionByRange("shard", F.xxhash64("h1", "doc_id", "text_hash"))
    dealt = dealt.sortWithinPartitions("shard").select("shard", "h1", "h2", "owner", "doc_id", "text_hash", "place")
    return map_arrow(dealt, run, "doc_id long, text_hash long, place int")


def removed(docs: DataFrame) -> DataFrame:
    """Texts without the lines at the places in `gone`."""
    schema = T.StructType([f for f in docs.schema.fields if f.name not in ("gone", "text_hash")]
                          + [T.StructField(n, T.LongType()) for n in ("n_lines", "n_dropped")])

    def run(batches):
        names = [f.name for f in schema.fields]
        for batch in small_batches(batches, "text"):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                lines = text.split("\n")
                n_lines.append(len(lines))
                n_dropped.append(len(gone or ()))
                if gone:
                    out = set(gone)
                    text = "\n".join(line for place, line in enumerate(lines) if place not in out)
                texts.append(text)
            made = {"text": pa.array(texts, pa.string()), "n_lines": pa.array(n_lines, pa.int64()),
                    "n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(n) if n in made else batch.column(n) for n in names], names=names)

    return map_arrow(docs, run, schema)


def drop_repeated_lines(docs: DataFrame, scratch: str) -> DataFrame:
    """`text` without the lines that an earlier document holds, plus n_lines and n_dropped.
    scratch: a folder all executors share, not used before."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped", "text_hash", "gone")])
    docs = plain_text(docs, "text").withColumns({"doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64("text")})
    hashed_lines(docs.select("doc_id", "text", "text_hash")).write.parquet(join(scratch, "lines"))
    lines = spark.read.parquet(join(scratch, "lines"))

    owner = F.coalesce("doc_id", F.lit(NULL_ID))
    repeated = lines.groupBy("h1", "h2").agg(
        F.min(owner).alias("keeper"), F.max(owner).alias("last"), F.count("*").alias("lines"))
    repeated.where("keeper < last").drop("last").write.parquet(join(scratch, "repeated"))
    repeated = spark.read.parquet(join(scratch, "repeated"))
    count = repeated.count()  # from the footers
    if count == 0:
        return removed(docs.withColumn("gone", F.lit(None).cast("array<int>")))
    shards = -(-count // SHARD_KEYS)
    index = join(scratch, "index")
    build_index(repeated, index, shards)
    gone = dropped_lines(lines, index, shards).groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("gone"))
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (docs["text_hash"] == gone["text_hash"])
    joined = docs.join(gone, same, "left").select(docs["*"], gone["gone"])
    return removed(joined)

