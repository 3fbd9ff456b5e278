"""Byte-level BPE encoding and decoding from a rank file.

A piece is merged over a segment tree: the leaf of byte position i holds the rank of the pair
that starts there, inner nodes hold the minimum, and the position in the low bits makes the
leftmost of equal ranks win. A merge reads the root, joins two live neighbours, and updates
the three leaves it touches, a logarithmic number of nodes each. Short pieces of one width
are merged in step, one numpy row each; long ones run alone.

Cases: NULL and empty texts have no ids and decode to no bytes; texts of any length are split
at piece borders and need memory for one range at a time; repeated rows give repeated rows;
an empty table gives an empty table; other columns are kept, and a column that has the name
of the output is replaced. Decoding a NULL list gives no bytes; an unknown id raises KeyError.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.columns import (
    lists,
    map_arrow,
    plain_text,
    replaced,
    small_batches,
    spread,
    text_buffer,
    with_column,
)
from tallystream.llm.pieces import PieceIds

NONE = np.int64(1) << 62
WIDEST = 64  # bytes of a piece that is merged in step with others
STEP = 4096  # pieces merged in step


class Ranks:
    """Ranks of a file of lines `base64(token) rank`; a token's rank is its id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        size = max(self.rank.values()) + 1
        self.length, self.begin = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        tokens = sorted(self.rank, key=self.rank.get)
        ids = np.array([self.rank[t] for t in tokens])
        self.length[ids] = [len(t) for t in tokens]
        self.begin[ids] = np.cumsum(self.length[ids]) - self.length[ids]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == key, self.pair_ranks[place], NONE)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and how many each has."""
        out: list = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (whole := self.rank.get(piece)) is not None:
                out[i] = (whole,)
            elif len(piece) > WIDEST:
                out[i] = self.merge_alone(piece)
            else:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            for at in range(0, len(members), STEP):
                part = members[at : at + STEP]
                ids, count = self.merge_in_step([pieces[i] for i in part], width)
                ids, begin = ids.tolist(), 0
                for i, c in zip(part, count.tolist()):
                    out[i] = ids[begin : begin + c]
                    begin += c
        count = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for ids in out for x in ids), np.int32, int(count.sum())), count

    def merge_in_step(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of 2 to `width` bytes, a row of one segment tree each."""
        m, size = len(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        place = np.arange(width)
        live = place < size[:, None]
        token = np.zeros((m, width), np.int64)
        token[live] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.tile(place + 1, (m, 1)), np.tile(place - 1, (m, 1))
        tree = np.full((m, 2 * width), NONE)
        leaves = tree[:, width:]
        paired = place < size[:, None] - 1
        left, right = np.nonzero(paired)
        rank = self.of_pairs(token[left, right], token[left, right + 1])
        leaves[paired] = np.where(rank < NONE, rank * width + right, NONE)
        node = width
        while node > 1:
            level = tree[:, node : 2 * node]
            node //= 2
            np.minimum(level[:, ::2], level[:, 1::2], out=tree[:, node : 2 * node])
        row = np.arange(m)
        while (row := row[tree[row, 1] < NONE]).size:
            root = tree[row, 1]
            i = root % width
            j = after[row, i]
            token[row, i] = root // width
            live[row, j] = False
            k = after[row, j]
            after[row, i] = k
            has = k < size[row]
            before[row[has], k[has]] = i[has]
            tree[row, width + j] = NONE
            self.set_leaves(tree, width, row[has], i[has], token[row[has], i[has]], token[row[has], k[has]])
            tree[row[~has], width + i[~has]] = NONE
            h = before[row, i]
            has = h >= 0
            self.set_leaves(tree, width, row[has], h[has], token[row[has], h[has]], token[row[has], i[has]])
            rows = np.concatenate([row, row, row[has]])
            nodes = np.concatenate([i, j, h[has]]) + width
            while nodes[0] > 1:
                nodes >>= 1
                tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
        return token[live], live.sum(1)

    def set_leaves(self, tree, width, row, at, left, right) -> None:
        rank = self.of_pairs(left, right)
        tree[row, width + at] = np.where(rank < NONE, rank * width + at, NONE)

    def merge_alone(self, piece: bytes) -> list[int]:
        """Merge one piece of any length."""
        n, none = len(piece), int(NONE)
        width = 1 << (n - 1).bit_length()
        token = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree, get = [none] * (2 * width), self.pairs.get
        for i in range(n - 1):
            rank = get(token[i] << 32 | token[i + 1])
            tree[width + i] = none if rank is None else rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while (root := tree[1]) < none:
            i = root % width
            j = after[i]
            token[i], token[j] = root // width, -1
            k = after[i] = after[j]
            put(j, none)
            rank = None
            if k < n:
                before[k] = i
                rank = get(token[i] << 32 | token[k])
            put(i, none if rank is None else rank * width + i)
            if (h := before[i]) >= 0:
                rank = get(token[h] << 32 | token[i])
                put(h, none if rank is None else rank * width + h)
        return [t for t in token if t >= 0]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows end to end, and how many each row has."""
        known = (ids >= 0) & (ids < len(self.length))
        if not known.all() or (self.length[ids] < 0).any():
            raise KeyError("an id is not in the vocabulary")
        size = self.length[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(counts)
        return self.bytes[spread(self.begin[ids], size)], total[ends] - total[ends - counts]


@lru_cache(2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(ranks_of(path).encode)


def encode(df: DataFrame, ranks_path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add the ids of `text`, an array<int> in column `out`."""

    def run(batches):
        for batch in small_batches(batches, text):
            ids, counts = piece_ids(ranks_path).of_rows(*text_buffer(batch.column(text)))
            yield replaced(batch, out, lists(ids, counts))

    df = plain_text(df, text)
    return map_arrow(df, run, with_column(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ranks_path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for, in column `out`."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                column = part.column(ids)
                counts = np.diff(column.offsets.to_numpy())
                data, sizes = ranks_of(ranks_path).decode(column.flatten().to_numpy().astype(np.int64), counts)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
                )
                yield replaced(part, out, raw.cast(pa.binary()))

    df = df.withColumn(ids, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")))
    return map_arrow(df, run, with_column(df, out, T.BinaryType()))
