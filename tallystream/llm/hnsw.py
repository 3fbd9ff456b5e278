"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

1. Copies of a vector are one node, which holds the smallest ids of its rows, as many as a
   search can return; so thousands of copies neither crowd a neighbour list nor lose a tie.
2. Nodes are dealt by hash to shards of about `SHARD` nodes, whatever the table's size. A task
   builds a shard's graph: a node draws its level from a hash of its place (each level keeps
   one node of `DEGREE`), and is linked on each of its levels to earlier nodes that are nearer to
   it than to each other; links go both ways, at most `DEGREE` a node above the ground and twice
   as many on it. The nodes that stood before it are compared exactly, block by block, instead of
   being searched for: a shard is small, and that gives the candidates that an endless search
   would. Nearness is the inner product for links as it is for queries; with unequal norms
   that finds more than distances would.
3. The index is a table with a row per node: its neighbours lie in one flat array, level after level,
   with a fixed stride (-1 where there are fewer).
4. Queries meet every shard, in blocks of `ASKED`. A task lays the shard's arrays side by side
   and moves all queries of a block in step: greedily down the levels, then on the ground
   with `effort` open candidates each. What they meet is scored on the original vectors in double
   precision, and the best of all shards meet in one window per query.

A query compares itself with a few thousand nodes a shard, not with all. Recall is measured in
the tests; `effort` raises it.

Cases: vectors that are NULL, empty, all zero, or hold NULL or non-finite components take no
part; vectors of another length than a query's are no candidates of it; a query is no candidate of its own id; equal scores go to
the smaller id, NULL ids first; repeated rows count each, repeated queries once; fewer
candidates than asked for are all returned if the graph meets them (always, where a shard has
fewer nodes than `effort`); empty tables give an empty table; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.columns import importable
from tallystream.llm.components import written
from tallystream.llm.pieces import mixed
from tallystream.llm.shared_files import join

SHARD = 1 << 14
ASKED = 1 << 12
DEGREE = 16
CANDIDATES = 64  # earlier nodes that one node may choose its links from
EFFORT = 160
STRIDE = 4  # candidates that a query opens in one step
LOCKSTEP = 256  # queries moved together
BLOCK = 512  # nodes linked together
NULL_ID = -(1 << 63)
INDEX = "length int, shard int, node int, level int, ids array<long>, vector array<double>, neighbours array<int>"
FOUND = "query_id long, query_hash long, vec_id long, score double"


def plain_vector(vector: Column) -> Column:
    """The vector in double precision; NULL for one that takes no part."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(~F.exists(whole, bad) & F.exists(whole, lambda x: x != 0), whole)


def rows_of(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def draw_levels(count: int) -> np.ndarray:
    """Levels of nodes 0, 1, ..; the first node has the highest."""
    drawn = (mixed(np.arange(1, count + 1, dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2.0**53
    level = np.floor(-np.log1p(-drawn) / np.log(DEGREE)).astype(np.int32)
    level[0] = level.max()
    return level


def diverse(points: np.ndarray, candidates: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """For each node, at most `most` of its candidates (places in points, -1 where none; nearest
    first): those that are nearer to the node than to one chosen before, then the nearest
    of the others."""
    count, width = candidates.shape
    held = points[np.maximum(candidates, 0)]
    between = held @ held.transpose(0, 2, 1)
    chosen = np.zeros((count, width), bool)
    for c in range(width):
        worst = np.where(chosen[:, :c], between[:, c, :c], -np.inf).max(1, initial=-np.inf)
        chosen[:, c] = (candidates[:, c] >= 0) & (near[:, c] > worst) & (chosen[:, :c].sum(1) < most)
    rank = np.where(chosen, 0, 1) * width + np.arange(width) + np.where(candidates < 0, 2 * width, 0)
    order = np.argsort(rank, 1, kind="stable")[:, :most]
    picked = np.take_along_axis(candidates, order, 1)
    if picked.shape[1] < most:
        picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)
    return picked


def link(points: np.ndarray, most: int) -> np.ndarray:
    """Neighbours of every point in one level of the graph: count x most, -1 where fewer."""
    count = len(points)
    own = max(1, most // 2)
    chosen = np.full((count, own), -1, np.int64)
    for first in range(0, count, BLOCK):
        to = min(first + BLOCK, count)
        near = points[first:to] @ points[:to].T
        near[np.arange(first, to)[:, None] <= np.arange(to)] = -np.inf
        width = min(CANDIDATES, to)
        best = np.argpartition(-near, width - 1, 1)[:, :width]
        values = np.take_along_axis(near, best, 1)
        order = np.argsort(-values, 1, kind="stable")
        best, values = np.take_along_axis(best, order, 1), np.take_along_axis(values, order, 1)
        best[np.isneginf(values)] = -1
        chosen[first:to] = diverse(points, best, values, own)
    # Links go both ways; a node that is given more than it may hold chooses among them again.
    out = np.repeat(np.arange(count), (chosen >= 0).sum(1))
    to = chosen[chosen >= 0]
    one, other = np.concatenate([out, to]), np.concatenate([to, out])
    near = np.einsum("ij,ij->i", points[one], points[other]) if len(one) else np.zeros(0)
    order = np.lexsort((other, -near, one))
    one, other, near = one[order], other[order], near[order]
    degree = np.bincount(one, minlength=count)
    place = np.arange(len(one)) - np.repeat(np.cumsum(degree) - degree, degree)
    links = np.full((count, most), -1, np.int64)
    few = degree[one] <= most
    links[one[few], place[few]] = other[few]
    many = np.flatnonzero(degree > most)
    for first in range(0, len(many), BLOCK):
        nodes = many[first : first + BLOCK]
        width = min(int(degree[nodes].max()), 4 * most)
        held, values = np.full((len(nodes), width), -1, np.int64), np.full((len(nodes), width), -np.inf)
        row = np.full(count, -1)
        row[nodes] = np.arange(len(nodes))
        use = (row[one] >= 0) & (place < width)
        held[row[one[use]], place[use]], values[row[one[use]], place[use]] = other[use], near[use]
        links[nodes] = diverse(points, held, values, most)
    return links


def build(vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Levels of all nodes; for each level its nodes and their neighbours (as nodes)."""
    points = (vectors / np.abs(vectors).max()).astype(np.float32)
    level = draw_levels(len(vectors))
    members, graphs = [], []
    for at in range(int(level.max()) + 1):
        nodes = np.flatnonzero(level >= at)
        found = link(points[nodes], 2 * DEGREE if at == 0 else DEGREE)
        members.append(nodes)
        graphs.append(np.where(found >= 0, nodes[found], -1))
    return level, members, graphs


def descend(vectors: np.ndarray, queries: np.ndarray, level: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """Node from which each query starts on the ground. graph: neighbours above the ground, by
    level and node."""
    at = np.zeros(len(queries), np.int64)
    score = queries @ vectors[0]
    for rung in range(len(graph) - 1, -1, -1):
        moving = np.arange(len(queries))
        while len(moving):
            near = graph[rung][at[moving]]
            values = np.einsum("qd,qmd->qm", queries[moving], vectors[np.maximum(near, 0)])
            values[near < 0] = -np.inf
            best = values.argmax(1)
            value = values[np.arange(len(moving)), best]
            better = value > score[moving]
            moving, best, value, near = moving[better], best[better], value[better], near[better]
            at[moving], score[moving] = near[np.arange(len(moving)), best], value
    return at


def explore(vectors: np.ndarray, queries: np.ndarray, start: np.ndarray, graph: np.ndarray, effort: int) -> np.ndarray:
    """The `effort` best nodes that each query meets on the ground, -1 where fewer."""
    count, degree = len(queries), graph.shape[1]
    met = np.zeros((count, len(vectors)), np.int32)  # 0: not met; else a mark of who met it
    met[np.arange(count), start] = -1
    nodes = np.full((count, effort), -1, np.int64)
    values = np.full((count, effort), -np.inf, np.float32)
    opened = np.ones((count, effort), bool)
    nodes[:, 0], values[:, 0], opened[:, 0] = start, np.einsum("qd,qd->q", queries, vectors[start]), False
    active = np.arange(count)
    while len(active):
        closed = opened[active]
        turn = ~closed & (np.cumsum(~closed, 1) <= STRIDE)
        row, column = np.nonzero(turn)
        opened[active[row], column] = True
        query = np.repeat(active[row], degree)
        near = graph[nodes[active[row], column]].ravel()
        new = (near >= 0) & (met[query, np.maximum(near, 0)] == 0)
        query, near = query[new], near[new]
        # Of several mentions of a node in one step, the last one counts.
        mark = np.arange(1, len(near) + 1, dtype=np.int32)
        met[query, near] = mark
        once = met[query, near] == mark
        query, near = query[once], near[once]
        value = np.einsum("pd,pd->p", queries[query], vectors[near])
        # A query's new nodes side by side, then the best of old and new.
        asked, counts = np.unique(query, return_counts=True)
        if len(asked):
            place = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
            line = np.repeat(np.arange(len(asked)), counts)
            wide = int(counts.max())
            more, score = np.full((len(asked), wide), -1, np.int64), np.full((len(asked), wide), -np.inf, np.float32)
            more[line, place], score[line, place] = near, value
            more, score = np.concatenate([nodes[asked], more], 1), np.concatenate([values[asked], score], 1)
            done = np.concatenate([opened[asked], more[:, effort:] < 0], 1)
            order = np.argsort(-score, 1, kind="stable")[:, :effort]
            nodes[asked] = np.take_along_axis(more, order, 1)
            values[asked] = np.take_along_axis(score, order, 1)
            opened[asked] = np.take_along_axis(done, order, 1)
        active = active[~opened[active].all(1)]
    return nodes


def make_index(rows: DataFrame, scratch: str, k: int = 20) -> DataFrame:
    """The index over rows (vec_id, vector: array<double>), for searches of up to k rows. scratch: a
    folder all executors share, not used before."""
    importable(rows.sparkSession)
    rows = rows.where("vector is not null and size(vector) > 0").select(
        F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), "vector", F.xxhash64("vector").alias("hash"))
    # A search that leaves out its own id returns none but the first k + 1 copies.
    copies = Window.partitionBy("hash", "vector").orderBy("vec_id")
    first = rows.withColumn("place", F.row_number().over(copies)).where(F.col("place") <= k + 1)
    nodes = first.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = written(nodes.withColumn("length", F.size("vector")), join(scratch, "nodes"))
    shards = max(1, -(-nodes.count() // SHARD))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("hash"), F.lit(shards)).cast("int"))

    def shard(table: pa.Table) -> pa.Table:
        table = table.sort_by("hash")
        level, members, graphs = build(rows_of(table.column("vector")))
        flat = [list(x) for x in graphs[0].astype(np.int32)]
        for nodes, found in zip(members[1:], graphs[1:]):
            for node, near in zip(nodes.tolist(), found.astype(np.int32)):
                flat[node].extend(near)
        count = table.num_rows
        return pa.table({"length": table.column("length"), "shard": table.column("shard"), "node": pa.array(np.arange(count, dtype=np.int32)),
                         "level": pa.array(level), "ids": table.column("ids"), "vector": table.column("vector"),
                         "neighbours": pa.array(flat, pa.list_(pa.int32()))})

    index = nodes.groupBy("length", "shard").applyInArrow(shard, INDEX)
    return written(index, join(scratch, "index"))


def search(index: DataFrame, queries: DataFrame, k: int = 20, effort: int = EFFORT) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows found for each query (query_id, vector:
    array<double>). k is at most the one that the index was made for."""
    queries = queries.where("vector is not null and size(vector) > 0").select(
        F.coalesce("query_id", F.lit(NULL_ID)).alias("query_id"), "vector", F.xxhash64("vector").alias("query_hash"))
    queries = queries.dropDuplicates(["query_id", "query_hash"]).withColumn("length", F.size("vector"))
    blocks = max(1, -(-queries.count() // ASKED))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "query_hash"), F.lit(blocks)).cast("int"))
    last = index.agg(F.max("shard")).first()[0] or 0
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cell(asked: pa.Table, stored: pa.Table) -> pa.Table:
        found = {"query_id": [], "query_hash": [], "vec_id": [], "score": []}
        if asked.num_rows and stored.num_rows:
            stored = stored.sort_by("node")
            vectors, want = rows_of(stored.column("vector")), rows_of(asked.column("vector"))
            take = lambda t, c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            own, hashes, level = take(asked, "query_id"), take(asked, "query_hash"), take(stored, "level")
            ids = stored.column("ids").combine_chunks()
            start_of_ids, ids = ids.offsets.to_numpy(), ids.values.to_numpy()
            near = stored.column("neighbours").combine_chunks()
            begin, flat = near.offsets.to_numpy(), near.values.to_numpy()
            ground = flat[begin[:-1, None] + np.arange(2 * DEGREE)]
            upper = np.full((int(level.max()), len(level), DEGREE), -1, np.int64)
            for rung in range(len(upper)):
                tall = np.flatnonzero(level > rung)
                upper[rung, tall] = flat[begin[tall, None] + 2 * DEGREE + rung * DEGREE + np.arange(DEGREE)]
            small = (vectors / np.abs(vectors).max()).astype(np.float32)
            for first in range(0, len(want), LOCKSTEP):
                part = want[first : first + LOCKSTEP]
                moved = (part / np.abs(part).max(1, keepdims=True)).astype(np.float32)
                nodes = explore(small, moved, descend(small, moved, level, upper), ground, max(effort, k + 1))
                for q, met in enumerate(nodes):
                    met = met[met >= 0]
                    scores = (vectors[met] * part[q]).sum(1)
                    counts = (start_of_ids[1:] - start_of_ids[:-1])[met]
                    begins = np.repeat(start_of_ids[met] - (np.cumsum(counts) - counts), counts)
                    names, scores = ids[begins + np.arange(counts.sum())], np.repeat(scores, counts)
                    other = names != own[first + q]
                    names, scores = names[other], scores[other]
                    best = np.lexsort((names, -scores))[:k]
                    found["query_id"].append(np.full(len(best), own[first + q]))
                    found["query_hash"].append(np.full(len(best), hashes[first + q]))
                    found["vec_id"].append(names[best])
                    found["score"].append(scores[best])
        return pa.table({n: pa.array(np.concatenate(v) if v else [], pa.float64() if n == "score" else pa.int64())
                         for n, v in found.items()})

    keys = ("length", "shard", "block")
    best = queries.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(cell, FOUND)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    back = lambda c: F.nullif(F.col(c), F.lit(NULL_ID)).alias(c)
    return best.select(back("query_id"), "rank", back("vec_id"), "score")
