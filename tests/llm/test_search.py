"""Top-k search against brute force."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tallystream.llm import topk_search

SCHEMA = "vec_id long, embedding array<double>"


def best(rows, queries, k):
    out = []
    for own, q in set((o, tuple(q)) for o, q in queries):
        cut = lambda s: min(max(s, -(2**63)), 2**63 - 1)
        scored = [(-cut(sum(a * b for a, b in zip(q, v))), -(2**63) if i is None else i) for i, v in rows if i != own and len(v) == len(q)]
        for rank, (score, i) in enumerate(sorted(scored)[:k]):
            out.append((own, rank + 1, None if i == -(2**63) else i, -score))
    return sorted(out, key=repr)


def found(spark, rows, queries, k):
    make = lambda r, name: spark.createDataFrame(r, f"{name} long, vector array<long>").withColumn("q", F.lit(1))
    got = topk_search.search(make(rows, "vec_id"), make(queries, "query_id"), k)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()), key=repr)


def test_search_by_brute_force(spark, monkeypatch):
    draw = random.Random(1)
    vector = lambda n: [draw.randint(-60, 60) for _ in range(n)]
    rows = [(i, vector(20)) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # one common vector: ties
    rows += [(2000, vector(3)), (2001, vector(3)), (2002, []), (2003, []), (5, rows[5][1]), (None, rows[7][1])]
    queries = [rows[7], rows[7], rows[0], rows[120], (2000, rows[340][1]), (2002, []), (9999, vector(4))]
    want = best(rows, queries, 5)
    assert found(spark, rows, queries, 5) == want
    monkeypatch.setattr(topk_search, "ROW_BLOCK", 40)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
    assert found(spark, rows, queries, 5) == want


def test_numbers_beyond_a_long(spark):
    rows = [(1, [2**62, 5]), (2, [-(2**62), 3]), (3, [2**61, 7]), (4, [0, 1])]
    assert found(spark, rows, rows[:2], 3) == best(rows, rows[:2], 3)


def test_pruning_keeps_the_best():
    draw = np.random.default_rng(3)
    rows, queries = draw.integers(-99, 99, (9000, 24)), draw.integers(-99, 99, (5, 24))
    ids = np.arange(9000)
    for q, (at, score) in enumerate(topk_search.search_cell(queries, np.array([3, 4, 5, 6, 7]), rows, ids, 5)):
        all_scores = rows @ queries[q]
        all_scores[q + 3] = -(10**9)
        want = np.lexsort((ids, -all_scores))[:5]
        assert at.tolist() == want.tolist() and score.tolist() == all_scores[want].tolist()


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001]), (2, None), (3, [0.1, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [-inf, 0.0]), (7, [])]
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", topk_search.whole_numbers(F.col("embedding"), 256).alias("v"))
    assert {r.vec_id: r.v for r in df.collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: None, 7: []}


def test_empty_tables(spark):
    assert found(spark, [], [(1, [1, 2])], 5) == [] and found(spark, [(1, [1, 2])], [], 5) == []
    assert found(spark, [(1, [1, 2])], [(1, [1, 2])], 5) == []
