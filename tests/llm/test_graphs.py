"""Graph search against brute force: recall on the given vectors, exact results where shards are small."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tallystream.llm import hnsw
from tallystream.llm.queries import QUERIES
from tallystream.session import scratch_path


def best(rows, queries, k):
    out = []
    for own, q in {(o, tuple(q)) for o, q in queries}:
        scored = [(-sum(a * b for a, b in zip(q, v)), -(2**63) if i is None else i)
                  for i, v in rows if i != own and len(v) == len(q) and any(v)]
        out += [(own, rank + 1, None if i == -(2**63) else i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, rows, queries, k):
    make = lambda r, name: spark.createDataFrame(r, f"{name} long, v array<double>").select(
        name, hnsw.plain_vector(F.col("v")).alias("vector"), F.lit(1).alias("shard"), F.lit("x").alias("hash"))
    index = hnsw.make_index(make(rows, "vec_id"), scratch_path(spark, "graphs"), k)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in hnsw.search(index, make(queries, "query_id"), k).collect()), key=repr)


def test_small_shards_are_exact(spark, monkeypatch):
    draw = random.Random(5)
    vector = lambda n: [float(draw.randint(-60, 60)) for _ in range(n)]
    rows = [(i, vector(12)) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(90)]  # many copies: ties
    rows += [(2000, vector(3)), (2001, vector(3)), (5, rows[5][1]), (None, rows[7][1])]
    queries = [rows[7], rows[7], rows[0], rows[120], (2000, rows[-4][1]), (1003, rows[7][1]), (9999, vector(4))]
    want = best(rows, queries, 5)
    assert found(spark, rows, queries, 5) == want
    monkeypatch.setattr(hnsw, "SHARD", 60)
    monkeypatch.setattr(hnsw, "ASKED", 2)
    assert found(spark, rows, queries, 5) == want


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (2, None), (3, [0.5, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [0.0, 0.0]), (7, []), (8, [1e200, 1.0])]
    assert found(spark, rows, rows[:2] + rows[5:7], 3) == [(1, 1, 8, 5e199)]
    assert found(spark, [], rows[:1], 3) == [] and found(spark, rows, [], 3) == []
    assert found(spark, rows[:1], rows[:1], 3) == []


def recall(vectors, asked, got, k=20):
    hits = 0
    for q in asked:
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score, kind="stable")[:k].tolist()) & set(got[q])) / k
    return hits / len(asked)


def test_recall_of_the_query(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in table] == list(range(len(table)))
    vectors = np.array([r.embedding for r in table], float)
    for shard in (1 << 14, 600):
        monkeypatch.setattr(hnsw, "SHARD", shard)
        got = {}
        for r in QUERIES["op13_nearest_neighbours"](spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
            assert abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12
        assert sorted(got) == list(range(0, len(table), 20)) and all(len(g) == 20 for g in got.values())
        assert recall(vectors, sorted(got), got) > 0.97


def test_graph_reaches_copies_and_crowds():
    """A crowd of near copies, unequal norms: a shard's graph finds what brute force finds."""
    draw = np.random.default_rng(2)
    crowd = draw.normal(size=32) + 0.01 * draw.normal(size=(1500, 32))
    vectors = np.concatenate([crowd, draw.normal(size=(2500, 32)) * draw.uniform(0.2, 3, (2500, 1))])
    draw.shuffle(vectors)
    level, members, graphs = hnsw.build(vectors)
    assert graphs[0].shape == (4000, 2 * hnsw.DEGREE) and (np.diff([len(m) for m in members]) <= 0).all()
    upper = np.full((len(members) - 1, 4000, hnsw.DEGREE), -1)
    for rung, nodes in enumerate(members[1:]):
        assert np.isin(graphs[rung + 1][graphs[rung + 1] >= 0], nodes).all()
        upper[rung, nodes] = graphs[rung + 1]
    queries = vectors[:200].astype(np.float32)
    small = vectors.astype(np.float32)
    met = hnsw.explore(small, queries, hnsw.descend(small, queries, level, upper), graphs[0], hnsw.EFFORT)
    exact = np.argsort(-(queries @ small.T), 1)[:, :20]
    assert np.mean([np.isin(e, m).mean() for e, m in zip(exact, met)]) > 0.95
