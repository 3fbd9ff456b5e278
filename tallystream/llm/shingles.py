"""Sets of word shingles of a batch, as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallystream.llm.columns import text_buffer
from tallystream.llm.pieces import mixed, span_hashes

SIZE = 5
FACTOR = np.uint64(0xD6E8FEB86659FD93)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word: bytes but blanks, A-Z in lower case."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    blank = (data == 0x20) | (data >= 0x09) & (data <= 0x0D)
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~blank
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.append(False, inside[:-1])
    begin = np.flatnonzero(inside & (~before | fresh))
    end = np.flatnonzero(before & (~inside | fresh))
    return span_hashes(data, begin, end), np.searchsorted(offsets, begin, "right") - 1


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all rows end to end, each sorted, and the size of each. A text of fewer
    words has its whole sequence as the one element, one without words has none."""
    data, offsets = text_buffer(texts)
    word, row = words(data, offsets)
    n_words = np.bincount(row, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    h = np.full(max(len(word) - SIZE + 1, 0), np.uint64(SIZE))
    for k in range(SIZE):
        h = h * FACTOR + word[k : k + len(h)]
    h = mixed(h)
    sets = []
    for at, n in zip(first.tolist(), n_words.tolist()):
        if n >= SIZE:
            sets.append(np.unique(h[at : at + n - SIZE + 1]))
        elif n:
            one = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in word[at : at + n]:
                    one = one * FACTOR + w
            sets.append(mixed(np.array([one])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.fromiter(map(len, sets), np.int64, len(sets))
