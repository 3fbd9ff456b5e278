"""Character n-grams of the words of a batch, as hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallystream.llm.columns import text_buffer
from tallystream.llm.pieces import LETTER, classes, code_points, mixed

PRIME = np.uint64(0x9E3779B97F4A7C15)


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts end to end, with one 0 around and between words, and
    the row of each."""
    data, offsets = text_buffer(pc.utf8_lower(texts))
    at, points = code_points(data)
    points = np.where(classes()[points] == LETTER, points, 0).astype(np.uint64)
    first = np.searchsorted(at, offsets[:-1])
    rows = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(at))) + 1)
    points = np.append(np.insert(points, first, 0), np.uint64(0))
    rows = np.append(rows, len(texts) - 1)
    keep = np.append(True, (points[1:] != 0) | (points[:-1] != 0))
    return points[keep], rows[keep]


def grams(points: np.ndarray, rows: np.ndarray, n: int, solid: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The row and 64-bit hash of every n characters that lie in one text; solid: those that
    are or touch one word only."""
    size = len(points) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(size, np.uint64(n))
    whole = np.ones(size, bool)
    for k in range(n):
        h = h * PRIME + points[k : k + size]
        if solid and (0 < k < n - 1 or n == 1):
            whole &= points[k : k + size] != 0
    if n > 1:  # a 0 at either end belongs to the text of the letter beside it
        first = np.where(points[:size] == 0, rows[1 : 1 + size], rows[:size])
        last = np.where(points[n - 1 :] == 0, rows[n - 2 : n - 2 + size], rows[n - 1 :])
        whole &= first == last
        rows = last
    return rows[:size][whole], mixed(h[whole])
