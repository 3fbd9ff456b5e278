"""Exact top-k search by inner product over vertical blocks of dimensions.

Rows and queries are dealt out over a grid of cells, a block of rows by a block of queries
each, so that no side is broadcast and no cell grows with the data. In a cell the rows lie
dimension by dimension. A query adds up its products block of dimensions by block; after each
block the rows left are those whose sum so far, plus the largest product that the norms of the
remaining dimensions allow, can still reach the k-th best score met, and they are compacted.
The best k of every cell meet in one window per query.

Vectors are integers, and scores are exact: 64-bit where no sum can exceed it, Python integers
(cut to the range of a long) otherwise.

Cases: vectors that are NULL, or hold NULL or non-finite components, take no part; vectors of
another length than the query's are no candidates; a query is no candidate of its own id;
equal scores go to the smaller id, NULL ids first; repeated candidate rows count each, repeated
queries once; a query without candidates has no rows; empty tables give an empty table; other
columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.columns import importable

ROW_BLOCK, QUERY_BLOCK = 1 << 14, 1 << 10
DIMENSIONS, CHUNK = 8, 4096
NULL_ID = LEAST = -(1 << 63)
MOST = (1 << 63) - 1
FOUND = "query_id long, query_hash long, vec_id long, score long"


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as double; NULL for a vector that takes no part."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(~F.exists(vector, bad), whole)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def search_cell(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list:
    """Per query the best k (ids, scores) among rows of its length, ordered."""
    if not rows.shape[1]:
        best = np.argsort(ids, kind="stable")
        return [(b := best[ids[best] != o][:k], np.zeros(len(b), np.int64)) for o in own]
    top = int(np.abs(queries.astype(object)).max()) * int(np.abs(rows.astype(object)).max()) * rows.shape[1]
    wide = top >= 1 << 62
    if wide:
        queries, rows = queries.astype(object), rows.astype(object)
    # Dimensions of much query mass first, so that little mass remains early.
    real_queries, real_rows = queries.astype(float), rows.astype(float)
    order = np.argsort(-(real_queries**2).sum(0), kind="stable")
    blocks = [order[i : i + DIMENSIONS] for i in range(0, len(order), DIMENSIONS)]
    vertical = [np.ascontiguousarray(rows[:, b].T) for b in blocks]

    def remaining(real):
        mass = np.stack([(real[:, b] ** 2).sum(1) for b in blocks])
        return np.sqrt(np.append(np.cumsum(mass[::-1], 0)[::-1][1:], np.zeros((1, len(real))), 0))

    query_rest, row_rest = remaining(real_queries), remaining(real_rows)
    parts = [queries[:, b] for b in blocks]
    out = []
    for q in range(len(queries)):
        best_at, best_score = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
        for first in range(0, len(rows), CHUNK):
            at = np.arange(first, min(first + CHUNK, len(rows)))
            at = at[ids[at] != own[q]]
            score = np.zeros(len(at), rows.dtype)
            for b, columns in enumerate(vertical):
                score = score + parts[b][q] @ columns[:, at]
                if len(best_at) == k and not wide:
                    bound = score.astype(float) + query_rest[b, q] * row_rest[b, at]
                    slack = 1 + 1e-9 * (np.abs(score.astype(float)) + query_rest[b, q] * row_rest[b, at])
                    alive = bound + slack >= float(best_score[-1])
                    at, score = at[alive], score[alive]
            if wide:
                score = np.array([min(max(int(s), LEAST), MOST) for s in score], object)
            at, score = np.concatenate([best_at, at]), np.concatenate([best_score, score])
            keep = np.lexsort((ids[at], -score))[:k] if not wide else np.array(
                sorted(range(len(at)), key=lambda i: (-score[i], ids[at[i]]))[:k], np.int64)
            best_at, best_score = at[keep], score[keep]
        out.append((best_at, best_score))
    return out


def search(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """rows: vec_id, vector (array<long>); queries: query_id, vector. Gives query_id, rank,
    vec_id and score of each query's best k."""
    importable(rows.sparkSession)
    rows = rows.where("vector is not null").select(F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), "vector")
    queries = queries.where("vector is not null").select(
        F.coalesce("query_id", F.lit(NULL_ID)).alias("query_id"), "vector", F.xxhash64("vector").alias("query_hash")).distinct()
    row_blocks = max(1, -(-rows.count() // ROW_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumns({"c": F.pmod(F.xxhash64("vec_id", "vector"), F.lit(row_blocks)).cast("int"), "length": F.size("vector")})
    rows = rows.withColumn("q", every(query_blocks))
    queries = queries.withColumns({"q": F.pmod(F.xxhash64("query_id", "query_hash"), F.lit(query_blocks)).cast("int"), "length": F.size("vector")})
    queries = queries.withColumn("c", every(row_blocks))

    def cell(asked: pa.Table, stored: pa.Table) -> pa.Table:
        asked, stored = asked.combine_chunks(), stored.combine_chunks()
        found = {"query_id": [], "query_hash": [], "vec_id": [], "score": []}
        if asked.num_rows and stored.num_rows:
            take = lambda t, c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            whole = lambda t: matrix(t.column("vector").combine_chunks())
            own, hashes, ids = take(asked, "query_id"), take(asked, "query_hash"), take(stored, "vec_id")
            for q, (at, score) in enumerate(search_cell(whole(asked), own, whole(stored), ids, k)):
                found["query_id"] += [own[q]] * len(at)
                found["query_hash"] += [hashes[q]] * len(at)
                found["vec_id"] += ids[at].tolist()
                found["score"] += [int(s) for s in score]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    keys = ("q", "c", "length")
    best = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(cell, FOUND)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    back = lambda c: F.nullif(F.col(c), F.lit(NULL_ID)).alias(c)
    return best.select(back("query_id"), "rank", back("vec_id"), "score")
