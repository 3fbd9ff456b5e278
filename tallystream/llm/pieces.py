"""Byte-level pre-tokens of a whole batch at once, and the ids of those already met.

The split equals the matches of `public_tokenizers.PATTERN`. Runs of one character class
(letter, number, other, blank) are found with numpy; a single blank goes with the run after
it, the last of several blanks too, and the English contractions end a piece early.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

from tallystream.llm.columns import RANGE_BYTES, ranges, spread

BLANK, LETTER, NUMBER, OTHER = 0, 1, 2, 3
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((BLANK, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(pattern, text):
            first, last = ord(run[0][0]), ord(run[0][-1])
            table[first : last + 1] = kind
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which characters start, and their code points."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[at]
    points = first.astype(np.int32)
    wide = np.flatnonzero(first >= 0xC0)
    if wide.size:
        for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
            part = wide[(first[wide] >= low) & (first[wide] < high)]
            point = first[part].astype(np.int32) & (0x3F >> more)
            for k in range(1, more + 1):
                point = point << 6 | data[at[part] + k] & 0x3F
            points[part] = point
    return at, points


def starts_of(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Byte positions at which pieces start; rows: those at which a text starts."""
    if not data.size:
        return np.zeros(0, np.int64)
    at, point = code_points(data)
    n = len(at)
    kind = classes()[point]
    fresh = np.zeros(n + 4, bool)  # a text starts here; the end counts as one
    fresh[np.searchsorted(at, rows)] = True
    fresh[n:] = True
    blank = kind == BLANK
    start = np.empty(n, bool)
    start[0] = True
    start[1:] = kind[1:] != kind[:-1]
    after = np.flatnonzero(blank[:-1] & ~blank[1:] & ~fresh[1:n]) + 1
    start[after - 1] = True
    start[after] = point[after - 1] != 0x20
    start |= fresh[:n]
    # Contractions: an apostrophe that starts a piece, with its letters in the same text.
    mark = np.flatnonzero((point == 0x27) & start)
    if mark.size:
        follow = np.zeros(n + 4, np.int32)
        follow[:n] = point
        one, two = follow[mark + 1], follow[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        short &= ~fresh[mark + 1]
        long &= ~fresh[mark + 1] & ~fresh[mark + 2]
        start[mark[short | long] + 1] = False
        ends = np.concatenate([mark[short] + 2, mark[long] + 3])
        start[ends[ends < n]] = True
    return at[start]


@lru_cache(1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    up, down = np.full(size, BASE), np.full(size, INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers_for(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least `size` powers: a table that stays for usual ranges, one of its own for a longer one."""
    usual = RANGE_BYTES + 1
    return powers(usual) if size <= usual else powers.__wrapped__(size)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, from one running sum over the data."""
    up, down = powers_for(data.size + 1)
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: data.size], out=total[1:])
    return mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


class PieceIds:
    """Ids by piece. encode: takes pieces as bytes, gives all ids end to end and the count of
    each. Pieces are known by a 64-bit hash; beyond `limit` of them the memory starts afresh."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = 1 << 20):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.values = np.zeros(0, np.int32)

    def learn(self, keys: np.ndarray, found: list[bytes]) -> None:
        values, count = self.encode(found)
        begin = len(self.values) + np.cumsum(count) - count
        self.values = np.concatenate([self.values, values.astype(np.int32)])
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.begin, self.count = np.insert(self.begin, place, begin), np.insert(self.count, place, count)

    def of_range(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of one range end to end, where its pieces start, and how many ids each has."""
        begin = starts_of(data, rows)
        end = np.append(begin[1:], data.size)
        keys, first, inverse = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        if len(self.keys) > self.limit:
            self.forget()
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[place] != keys) if len(self.keys) else np.arange(len(keys))
        if new.size:
            raw = data.tobytes()
            self.learn(keys[new], [raw[a:b] for a, b in zip(begin[first[new]].tolist(), end[first[new]].tolist())])
            place = np.searchsorted(self.keys, keys)
        place = place[inverse]
        count = self.count[place]
        return self.values[spread(self.begin[place], count)], begin, count

    def of_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and how many each row has."""
        values, counts = [np.zeros(0, np.int32)], np.zeros(len(offsets) - 1, np.int64)
        for a, b in ranges(data, offsets):
            rows = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
            ids, begin, count = self.of_range(data[a:b], rows)
            row = np.searchsorted(offsets, begin + a, "right") - 1
            counts += np.bincount(row, count, len(counts)).astype(np.int64)
            values.append(ids)
        return np.concatenate(values), counts
