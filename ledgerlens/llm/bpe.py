"""Byte-level BPE with rank files: encoding by a two-tier lookup, and decoding.

A minimal perfect hash over the vocabulary resolves all pre-tokens that are entries themselves, by
array operations; the entry it points to is compared byte by byte.  The rest is merged one by one: a
heap gives the pair with the lowest rank, the leftmost first, over a linked list of byte runs.
"""

from __future__ import annotations

import base64
import heapq
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHashes, flat, mixed, ragged, slices
from .pretokens import WORDS_BYTES, distinct, split

REMEMBERED = 250_000  # merged pre-tokens that a worker keeps


class PerfectHash:
    """Numbers n different 64-bit hashes 0..n-1.

    Each level gives a bit to every hash that falls alone into a table; the others go on to the next.
    A hash that is not in the set gets any number, or -1.
    """

    def __init__(self, hashes: np.ndarray, room: float = 1.5):
        self.levels, base = [], 0
        left = hashes
        while len(left):
            size = max(64, int(room * len(left)))
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            number = np.where(alone, base + np.cumsum(alone) - 1, -1)
            self.levels.append((size, number))
            base += int(alone.sum())
            left = left[~alone[place]]

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(hashes ^ mixed(np.array([level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1)
        left = np.arange(len(hashes))
        for level, (size, number) in enumerate(self.levels):
            got = number[self._place(hashes[left], level, size)]
            out[left] = got
            left = left[got < 0]
            if not len(left):
                break
        return out


def _hashes(words: pa.Array) -> np.ndarray:
    raw, starts = flat(words)
    return SpanHashes(np.frombuffer(raw, np.uint8)).of(starts[:-1], starts[1:])


class Ranks:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(word): int(rank) for word, rank in pairs}
        words = pa.array(list(self.ranks), pa.binary())
        hashes = _hashes(words)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two entries of the vocabulary have one hash")
        self.hash = PerfectHash(hashes)
        place = self.hash.numbers(hashes)
        order = np.argsort(place)
        self.words = words.take(pa.array(order))
        self.ids = np.array(list(self.ranks.values()), np.int64)[order]
        raw, starts = flat(self.words)
        by_id = np.argsort(self.ids)
        self.bytes = np.frombuffer(raw, np.uint8)
        size = int(self.ids.max()) + 1
        self.begin, self.length = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.begin[self.ids[by_id]] = starts[:-1][by_id]
        self.length[self.ids[by_id]] = np.diff(starts)[by_id]
        self.known: dict[bytes, np.ndarray] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token that is no entry."""
        ranks, n = self.ranks, len(word)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or after[j] != end:
                continue  # one of the two runs has grown since
            alive[j] = False
            after[i] = end
            before[end] = i
            if end < n and (r := ranks.get(word[i:after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
            k = before[i]
            if k >= 0 and (r := ranks.get(word[k:end])) is not None:
                heapq.heappush(heap, (r, k, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i:after[i]]])
            i = after[i]
        return out

    def _merged(self, word: bytes) -> np.ndarray:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            got = self.known[word] = np.array(self.merge(word), np.int64)
        return got

    def words_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in a row, and how many each has."""
        number = self.hash.numbers(_hashes(words))
        found = number >= 0
        same = pc.equal(words, self.words.take(pa.array(np.maximum(number, 0)))).to_numpy(zero_copy_only=False)
        found &= same
        rest = np.flatnonzero(~found)
        merged = [self._merged(w) for w in words.take(pa.array(rest)).to_pylist()]
        size = np.ones(len(words), np.int64)
        size[rest] = np.fromiter(map(len, merged), np.int64, len(merged))
        at = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.int64)
        out[at[found]] = self.ids[number[found]]
        if len(rest):
            out[ragged(at[rest], size[rest])] = np.concatenate(merged)
        return out, size

    def encode(self, raw: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text begin."""
        begin, _, first = split(raw, starts)
        if not len(begin):
            return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
        words, which = distinct(raw, begin)
        ids, size = self.words_ids(words)
        at = np.cumsum(size) - size
        ends = np.concatenate([[0], np.cumsum(size[which])])
        return ids[ragged(at[which], size[which])], ends[first]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in a row, and where those of each text begin."""
        n = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.bytes[ragged(self.begin[ids], n)], ends[first]


@cache
def ranks(path: str) -> Ranks:
    return Ranks(path)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded (the bytes the ids stand for) for every row.

    Null and empty texts have no ids; a null doc_id is kept; repeated rows are encoded each; other
    columns are not looked at.
    """

    def rows(batches):
        model = ranks(path)
        for part in slices(batches, limit=WORDS_BYTES):
            ids, first = model.encode(*flat(part.column("text")))
            data, cuts = model.decode(ids, first)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))),
                 pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])],
                ["doc_id", "ids", "decoded"])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(rows, "doc_id long, ids array<int>, decoded binary")
