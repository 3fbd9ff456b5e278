"""N-gram Jaccard join: linked groups of documents over a token-group matrix.

Documents link when their sets of word shingles have a Jaccard similarity of `PERCENT` or
more. Equal sets are one class from the start; classes are numbered in the order of their
smallest ids, and these numbers, not the ids, are what is linked. Then:

1. Partition. Documents that agree on a band of `ROWS` min-hashes fall together, and the
   first of those leads. A document belongs to the groups of its leaders, a few. A pair
   at the threshold agrees on none of the `BANDS` bands, and is lost, with a chance of
   (1 - 0.75^4)^56 = 6e-10, of a pair above it with less.
2. Every member is compared with its leaders, exactly: a number of comparisons that grows with
   the members, not with their square. The links give components.
3. Groups whose members are still in several components go on. Members outside the leader's
   component (strays) meet the other members of the group in cells of bounded size. A cell
   keeps a sparse token-group matrix: which shingles occur in which component's documents.
   For a document, the sum of its columns bounds its overlap with every document of a
   component; only components that reach the bound are opened and compared, size-compatible
   documents only, and those linked by then are passed over.
4. All links give the final components.

A hot leader is split over as many tasks as its members fill; sets, links and components stay
in tables of the shared folder. Texts are hashed again where two are compared, so sets are
never shuffled.

Cases: texts without words have no set and link with nothing; every row with a NULL id is a
document of its own, and its component has the smallest id of the others in it, NULL if there
is none; rows that repeat a doc_id are one document with several texts in the component_id,
linked to whatever one of them links, but texts of their own in `row_groups`; an empty table
gives an empty table; shingles are compared by 64-bit hashes, rows known by 128 bits of their
id and text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.columns import lists, map_arrow, plain_text, small_batches, spread
from tallystream.llm.components import components, written
from tallystream.llm.pieces import mixed
from tallystream.llm.shared_files import join
from tallystream.llm.shingles import shingle_sets

PERCENT = 75
BANDS, ROWS = 56, 4
LEAD_CHUNK = 512  # members that one task-local run compares with a leader
CELL_CHUNK = 256  # documents of one side of a cell

SALTS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
FACTORS = mixed(np.arange(1001, 1001 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)


def band_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Keys of the bands, a row for each set that is not empty."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    keys = np.zeros((len(starts), BANDS), np.uint64)
    for i in range(BANDS * ROWS if len(starts) else 0):
        least = np.minimum.reduceat((values ^ SALTS[i]) * FACTORS[i], starts)
        keys[:, i // ROWS] = mixed(keys[:, i // ROWS] + least + np.uint64(i // ROWS))
    return keys


def row_key() -> Column:
    """128 bits of doc_id and text, NULL texts as empty ones; rows that are equal in both share it."""
    doc = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("NULL"))
    return F.unhex(F.md5(F.concat(doc, F.lit(" "), F.coalesce(F.col("text").cast("string"), F.lit("")))))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, size and 128-bit hash of the set, and the keys of its bands."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            values, sizes = shingle_sets(batch.column("text"))
            some = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[some]
            halves = np.zeros((2, len(sizes)), np.uint64)
            for i, salt in enumerate(SALTS[:2]):
                if len(some):
                    halves[i, some] = np.add.reduceat(mixed(values ^ salt), starts)
            count = np.where(sizes > 0, BANDS, 0)
            keys = band_keys(values, sizes).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(sizes), *(pa.array(h.view(np.int64)) for h in halves), lists(keys, count)],
                names=["doc_id", "row_key", "n", "h1", "h2", "keys"])

    return map_arrow(docs, run, "doc_id long, row_key binary, n long, h1 long, h2 long, keys array<long>")


def linked(common: int | np.ndarray, one: int | np.ndarray, other: int | np.ndarray):
    return 100 * common >= PERCENT * (one + other - common)


def texts_of(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """node and text of all members and leaders. The whole corpus is dealt out for this once, equal
    rows as one, by a merge join whatever the sizes, and only what is compared goes on."""
    wanted = members.select("doc").unionByName(members.select(F.col("leader").alias("doc"))).distinct()
    wanted = classes.select("doc", "row_key").join(wanted, "doc")
    once = docs.groupBy("row_key").agg(F.first("text").alias("text"))
    return once.join(wanted.hint("merge"), "row_key").select(F.col("doc").alias("node"), "text")


def with_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the documents in `wanted` (doc, ..), a row for each of its rows."""
    return texts.join(wanted, texts["node"] == wanted["doc"]).drop("node")


def star_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between leaders and members (leader, doc)."""
    chunks = F.ceil(F.count("*") / LEAD_CHUNK).cast("int")
    sizes = members.groupBy("leader").agg(chunks.alias("chunks"))
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int")
    rows = members.join(sizes, "leader").select("leader", chunk.alias("chunk"), "doc")
    leads = sizes.select("leader", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("leader").alias("doc"))
    rows = with_texts(docs, rows.unionByName(leads)).withColumn("is_member", F.col("doc") != F.col("leader"))

    def run(batches):
        now, leading = None, []
        for batch in small_batches(batches, "text"):
            values, sizes = shingle_sets(batch.column("text"))
            ends, found = np.cumsum(sizes), ([], [])
            columns = (batch.column(c).to_pylist() for c in ("leader", "chunk", "doc"))
            for i, (leader, chunk, doc) in enumerate(zip(*columns)):
                own = values[ends[i] - sizes[i] : ends[i]]
                if (leader, chunk) != now:
                    now, leading = (leader, chunk), []
                if doc == leader:
                    leading.append(own.copy())
                elif any(len(own) and linked(common(own, lead), len(own), len(lead)) for lead in leading):
                    found[0].append(leader)
                    found[1].append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    dealt = rows.repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "is_member")
    return map_arrow(dealt.select("leader", "chunk", "doc", "text"), run, "a long, b long")


def common(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) > len(other):
        one, other = other, one
    if not len(one):
        return 0
    place = np.searchsorted(other, one)
    place[place == len(other)] = 0
    return int((other[place] == one).sum())


def cell_links(sets: list[np.ndarray], doc: np.ndarray, group: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links between documents of different groups (components) in one cell. side: 0 strays of
    the first chunk, 1 the second chunk; -1 where both chunks are the same."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    names, number = np.unique(group, return_inverse=True)
    tokens, token = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    # The matrix, one entry for each shingle and group.
    entry = np.unique(token.astype(np.int64) * len(names) + np.repeat(number, sizes))
    at, column = entry // len(names), entry % len(names)
    begin = np.searchsorted(at, np.arange(len(tokens) + 1))
    of_group = [np.flatnonzero(number == g) for g in range(len(names))]
    least = np.array([sizes[m].min() for m in of_group])
    parent = list(range(len(names)))

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = g = parent[parent[g]]
        return g

    found = []
    for x in np.flatnonzero(side <= 0).tolist():
        own = token[ends[x] - sizes[x] : ends[x]]
        overlap = np.bincount(column[spread(begin[own], begin[own + 1] - begin[own])], minlength=len(names))
        # Of a document y in the group: 100 c >= 75 (|x| + |y| - c), and c is at most the overlap.
        open_ = np.flatnonzero((100 + PERCENT) * overlap >= PERCENT * (sizes[x] + np.maximum(least, overlap)))
        for g in open_.tolist():
            for y in of_group[g].tolist():
                if root(g) == root(number[x]):
                    break
                if side[x] == side[y] == 0 or y == x or not linked(min(sizes[x], sizes[y]), sizes[x], sizes[y]):
                    continue
                if linked(common(sets[x], sets[y]), sizes[x], sizes[y]):
                    found.append((int(doc[x]), int(doc[y])))
                    parent[root(g)] = root(number[x])
    return found


def stray_links(docs: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) between members of one leader that the leader's own links leave apart."""
    of = lambda c, name: labels.select(F.col("node").alias(c), F.col("component").alias(name))
    rows = members.join(of("doc", "own"), "doc", "left").join(of("leader", "home"), "leader", "left")
    rows = rows.select("leader", "doc", F.coalesce("own", "doc").alias("own"), F.coalesce("home", "leader").alias("home"))
    rows = rows.withColumn("stray", F.col("own") != F.col("home"))
    apart = rows.groupBy("leader").agg(
        F.min("own").alias("low"), F.max("own").alias("high"), F.count_if("stray").alias("strays"),
        F.count_if(~F.col("stray")).alias("homes")).where("low < high")
    chunks = lambda c: F.ceil(F.col(c) / CELL_CHUNK).cast("int")
    apart = apart.select("leader", chunks("strays").alias("strays"), chunks("homes").alias("homes"))
    rows = rows.join(apart, "leader")
    # Chunks 0 .. strays - 1 hold strays, those after hold the others; a cell is (i, j), i a chunk of strays.
    place = F.pmod(F.xxhash64("doc"), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("homes"))).cast("int")
    rows = rows.withColumn("chunk", F.when(F.col("stray"), place).otherwise(F.col("strays") + place))
    every = F.sequence(F.lit(0), F.col("strays") + F.col("homes") - 1)
    ordered = lambda j: F.struct(F.least("chunk", j).alias("i"), F.greatest("chunk", j).alias("j"))
    cells = F.when(F.col("stray"), F.transform(every, ordered)).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("strays") - 1), ordered))
    rows = rows.select("leader", "doc", "own", "chunk", F.explode(cells).alias("cell"))
    side = F.when(F.col("cell.i") == F.col("cell.j"), -1).when(F.col("chunk") == F.col("cell.i"), 0).otherwise(1)
    rows = rows.select("leader", "cell.i", "cell.j", side.alias("side"), "doc", "own")
    dealt = with_texts(docs, rows).repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j")

    def run(batches):
        now, held = None, []

        def links():
            sets, doc, own, side = zip(*held)
            found = cell_links(list(sets), np.array(doc), np.array(own), np.array(side))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in small_batches(batches, "text"):
            values, sizes = shingle_sets(batch.column("text"))
            ends = np.cumsum(sizes)
            columns = (batch.column(c).to_pylist() for c in ("leader", "i", "j", "doc", "own", "side"))
            for n, (leader, i, j, doc, own, side) in enumerate(zip(*columns)):
                if (leader, i, j) != now:
                    if held:
                        yield links()
                    now, held = (leader, i, j), []
                if sizes[n]:
                    held.append((values[ends[n] - sizes[n] : ends[n]].copy(), doc, own, side))
        if held:
            yield links()

    return map_arrow(dealt.select("leader", "i", "j", "doc", "own", "side", "text"), run, "a long, b long")


def row_groups(docs: DataFrame, scratch: str) -> DataFrame:
    """doc_id, row_key, n_shingles and component (a number, NULL for a text without words) of every
    row of docs (doc_id, text), each a document of its own whatever its id.
    scratch: a folder all executors share, not used before."""
    docs = plain_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    docs = docs.select("doc_id", row_key().alias("row_key"), "text")
    sketched = written(sketches(docs), join(scratch, "sketches"))
    # One document for each set; equal sets have equal keys. Numbers are given as the table is written.
    classes = sketched.where("n > 0").groupBy("h1", "h2", "n").agg(
        F.min(F.struct("doc_id", "row_key")).alias("least"), F.first("keys").alias("keys"))
    classes = classes.select("h1", "h2", "n", "least.doc_id", "least.row_key", "keys")
    classes = classes.repartitionByRange("doc_id", "row_key").sortWithinPartitions("doc_id", "row_key")
    classes = written(classes.withColumn("doc", F.monotonically_increasing_id()), join(scratch, "classes"))
    bands = classes.select("doc", F.explode("keys").alias("key"))
    leaders = bands.groupBy("key").agg(F.min("doc").alias("leader"))
    members = bands.join(leaders, "key").where("doc <> leader").select("leader", "doc").distinct()
    members = written(members, join(scratch, "members"))

    texts = written(texts_of(docs, classes, members), join(scratch, "texts"))
    stars = written(star_links(texts, members), join(scratch, "star-links"))
    labels = components(stars, join(scratch, "star-components"))
    strays = written(stray_links(texts, members, labels), join(scratch, "stray-links"))
    labels = components(stars.unionByName(strays), join(scratch, "components"))

    of = classes.select("h1", "h2", "n", "doc").join(labels, F.col("doc") == F.col("node"), "left")
    of = of.select("h1", "h2", "n", F.coalesce("component", "doc").alias("component"))
    rows = sketched.drop("keys").join(of, ["h1", "h2", "n"], "left")
    rows = rows.select("doc_id", "row_key", F.col("n").alias("n_shingles"), "component")
    return written(rows, join(scratch, "rows"))


def similar_groups(docs: DataFrame, scratch: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text).
    scratch: a folder all executors share, not used before."""
    rows = row_groups(docs, scratch).drop("row_key")
    some = rows.where("component is not null")
    # Components that hold texts of one id are one.
    spans = some.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
    bridges = some.join(spans.where("low < high"), "doc_id").select(F.col("component").alias("a"), F.col("low").alias("b"))
    folded = components(bridges, join(scratch, "folds")).withColumnRenamed("component", "root")
    least = some.groupBy("component").agg(F.min("doc_id").alias("least"))
    least = least.join(folded, F.col("component") == F.col("node"), "left")
    least = least.select("component", F.coalesce("root", "component").alias("root"), "least")
    names = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("component", "component_id")
    # A text without words goes where the other texts of its id are.
    bare = rows.where("component is null").drop("component").join(spans.select("doc_id", F.col("low").alias("component")), "doc_id", "left")
    return some.unionByName(bare).join(names, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
