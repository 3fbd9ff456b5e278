"""Hard negatives against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallystream.llm import negatives
from tallystream.session import scratch_path

SCHEMA = "vec_id long, label int, vector array<long>"
LEAST, MOST = -(2**63), 2**63 - 1


def brute(rows, anchors, positives=5, count=5, low=80, high=100):
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    known = lambda i: LEAST if i is None else i
    out = []
    for own, label, q in {(a, l, tuple(v)) for a, l, v in anchors if l is not None and v is not None}:
        scored = [(-min(max(sum(a * b for a, b in zip(q, v)), LEAST), MOST), known(i), l) for i, l, v in rows if len(v) == len(q)]
        near = sorted(s for s in scored if s[2] == label and s[1] != known(own))[:positives]
        for top, positive, _ in near:
            fit = sorted(s for s in scored if s[2] != label and low * -top <= 100 * -s[0] <= high * -top)[:count]
            out += [(own, None if positive == LEAST else positive, n + 1, None if i == LEAST else i, -top, -s) for n, (s, i, _) in enumerate(fit)]
    return sorted(out, key=repr)


def mined(spark, rows, anchors, **options):
    make = lambda x: spark.createDataFrame(x, SCHEMA).withColumnsRenamed({}).selectExpr("*", "1 as cluster", "2 as slice", "'x' as anchor_id")
    found = negatives.mine(make(rows), make(anchors), scratch_path(spark, "negatives"), **options)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted([tuple(r[n] for n in names) for r in found.collect()], key=repr)


def table(seed: int, count: int, size: int = 8):
    """A hot label, crowds of near copies, many equal vectors, and the odd rows."""
    draw = random.Random(seed)
    middle = [[draw.randint(-60, 60) for _ in range(size)] for _ in range(6)]
    near = lambda c: [x + draw.randint(-9, 9) for x in middle[c]]
    rows = [(i, draw.choice([1, 1, 1, 2, 3]), near(draw.randrange(6))) for i in range(count)]
    rows += [(5000 + i, 1 + i % 2, middle[0]) for i in range(60)]
    rows += [(6000, None, near(0)), (6001, 2, None), (6002, 2, [1, 2]), (6003, 1, [2, 1]), (6004, 2, []), (6005, 1, [0] * size),
             (None, 2, near(1)), (3, 2, near(2)), rows[4]]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_mining_by_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in {"PER_CENTRE": 4, "CHUNK": 6, "SLICE": 150, "BLOCK": 16}.items():
            monkeypatch.setattr(negatives, name, value)
    rows = table(3, 500)
    anchors = rows[::25] + rows[:2] + rows[-10:]
    assert mined(spark, rows, anchors) == brute(rows, anchors)


def test_other_counts_and_shares(spark):
    rows = table(4, 200)
    options = {"positives": 2, "negatives": 3, "low": 50, "high": 95}
    assert mined(spark, rows, rows[:10], **options) == brute(rows, rows[:10], 2, 3, 50, 95)


def test_scores_beyond_a_long(spark):
    rows = [(1, 1, [2**62, 5]), (2, 1, [2**61, 3]), (3, 2, [2**61, 7]), (4, 2, [3, 1]), (5, 1, [1, 0]), (6, 2, [0, 1]), (7, 1, [-(2**62), 0])]
    assert mined(spark, rows, rows[:2] + rows[4:]) == brute(rows, rows[:2] + rows[4:])


def test_empty_tables(spark):
    rows = [(1, 1, [1, 2]), (2, 1, [2, 1]), (3, 2, [1, 2])]
    assert mined(spark, [], []) == [] and mined(spark, rows, []) == [] and mined(spark, [], rows) == []


def test_walks_end_early():
    """In a list ordered by its bounds, anchors stop where no row can matter any more."""
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(4000, 6)) * 40
    near = np.argsort(-(rows @ rows[0]))
    bounds = np.sqrt((rows**2).sum(1)) * np.cos(np.arccos(np.clip(rows @ rows[0] / np.sqrt((rows**2).sum(1) * (rows[0] ** 2).sum()), -1, 1)))
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            read.append(at)
            return super().__getitem__(at)

    found = negatives.walk_cell(rows[:1], np.array([-1]), np.array([1]), np.sqrt((rows[:1] ** 2).sum(1)), None, np.array([[np.nan]]),
                                rows.view(Watched), np.arange(4000), np.ones(4000, int), bounds, 5, 80, 100)
    assert found[2].tolist() == near[:5].tolist()
    assert sum(isinstance(at, slice) for at in read) <= 2
