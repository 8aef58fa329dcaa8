"""Token ids in wavelet matrices, one per shard.

A wavelet matrix keeps a sequence of numbers as bit-planes, from the top bit down; below each plane
the numbers are dealt stably into zeros and ones.  With running counts of ones (one per block of the
plane) it answers access, rank (how often a value occurs before a place) and select (where it occurs
the k-th time) without unpacking.  A shard is one row of one Parquet file that Spark writes, with the
planes compressed and a directory of its documents, so a lost executor costs a rerun of its task only
and any store that Spark writes to will do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import flat, slices
from .encoding import binaries, ended, encoder
from .pretokens import WORDS_BYTES

BLOCK = 512  # bits between two running counts
SHARD_TOKENS = 1 << 20  # a shard is closed once it has as many; one document never spans two
SHARDS = ("part long, number long, n long, zeros array<long>, planes array<binary>, ranks array<binary>, "
          "doc_ids binary, no_id binary, starts binary, counts binary")


class WaveletMatrix:
    """planes[k]: packed bits of plane k; zeros[k]: its zeros; ranks[k]: ones before each block."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        kind = np.uint16 if bits <= 16 else np.uint32
        v, zeros, planes, ranks = values.astype(kind), [], [], []
        below = np.empty_like(v)
        words = np.zeros(-(-len(v) // BLOCK) * (BLOCK // 64), np.uint64)  # a plane, filled up to whole blocks
        for k in range(bits - 1, -1, -1):
            bit = (v & kind(1 << k)) != 0
            plane = np.packbits(bit)
            words.view(np.uint8)[:len(plane)] = plane
            ones = np.bitwise_count(words).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)]))
            planes.append(plane)
            zeros.append(len(v) - int(ranks[-1][-1]))
            np.compress(bit, v, out=below[zeros[-1]:])
            np.compress(np.logical_not(bit, out=bit), v, out=below[:zeros[-1]])
            v, below = below, v
        return cls(len(values), zeros, planes, ranks)

    def _bit(self, k: int, i: np.ndarray) -> np.ndarray:
        return (self.planes[k][i >> 3] >> (7 - (i & 7))) & 1

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        """Ones before place i of plane k: the block's count and the bits between."""
        block = i // BLOCK
        out = self.ranks[k][block].astype(np.int64)
        whole = np.append(self.planes[k], np.zeros(1, np.uint8))
        first = block * (BLOCK // 8)
        for step in range(BLOCK // 8):
            at = first + step
            left = i - at * 8
            use = left > 0
            if not use.any():
                break
            byte = whole[np.minimum(at, len(whole) - 1)]
            keep = np.where(left >= 8, 0xFF, (0xFF00 >> np.clip(left, 0, 8)) & 0xFF).astype(np.uint8)
            out += np.where(use, np.bitwise_count(byte & keep), 0)
        return out

    def access(self, places) -> np.ndarray:
        i = np.asarray(places, np.int64)
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.planes)):
            bit = self._bit(k, i).astype(np.int64)
            ones = self._ones(k, i)
            i = np.where(bit == 1, self.zeros[k] + ones, i - ones)
            out = (out << 1) | bit
        return out

    def _descend(self, value: int, places: np.ndarray) -> np.ndarray:
        i = np.asarray(places, np.int64)
        for k in range(len(self.planes)):
            ones = self._ones(k, i)
            i = self.zeros[k] + ones if (value >> (len(self.planes) - 1 - k)) & 1 else i - ones
        return i

    def rank(self, value: int, places) -> np.ndarray:
        """Occurrences of `value` before each place (0..n)."""
        if value >> len(self.planes):
            return np.zeros(len(np.atleast_1d(places)), np.int64)
        return self._descend(value, places) - self._descend(value, [0])[0]

    def count(self, value: int) -> int:
        return int(self.rank(value, [self.n])[0])

    def select(self, value: int, which) -> np.ndarray:
        """Places of the occurrences numbered `which` (from 0) of `value`."""
        which = np.asarray(which, np.int64)
        if len(which) and (which.min() < 0 or which.max() >= self.count(value)):
            raise IndexError("no such occurrence")
        i = which + (self._descend(value, [0])[0] if len(which) else 0)
        for k in range(len(self.planes) - 1, -1, -1):
            one = (value >> (len(self.planes) - 1 - k)) & 1
            i = self._place(k, i - self.zeros[k] if one else i, one)
        return i

    def _place(self, k: int, which: np.ndarray, one: int) -> np.ndarray:
        """Where plane k has its ones (or zeros) numbered `which`: by the block's count, then the byte's, then the bit."""
        before = self.ranks[k].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        out = np.empty(len(which), np.int64)
        whole = np.append(self.planes[k], np.full(BLOCK // 8, 0 if one else 0xFF, np.uint8))
        for part in range(0, len(which), 1 << 14):  # so many blocks at once
            asked = which[part:part + (1 << 14)]
            block = np.searchsorted(before, asked, side="right") - 1
            left = asked - before[block]
            held = whole[np.minimum(block[:, None] * (BLOCK // 8) + np.arange(BLOCK // 8), len(whole) - 1)]
            held = held if one else ~held
            counts = np.cumsum(np.bitwise_count(held), axis=1, dtype=np.int64)
            byte = (counts <= left[:, None]).sum(axis=1)
            rows = np.arange(len(asked))
            left -= np.where(byte > 0, counts[rows, byte - 1], 0)
            bits = np.cumsum(np.unpackbits(held[rows, byte][:, None], axis=1), axis=1)
            out[part:part + len(asked)] = block * BLOCK + byte * 8 + (bits <= left[:, None]).sum(axis=1)
        return out

    def all(self) -> np.ndarray:
        """The whole sequence, by dealing back from the lowest plane up."""
        v = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n).astype(bool)
            up = np.empty_like(v)
            up[~bit] = v[:self.zeros[k]]
            up[bit] = v[self.zeros[k]:] | v.dtype.type(1 << (len(self.planes) - 1 - k))
            v = up
        return v.astype(np.uint32)


def pack_shard(matrix: WaveletMatrix) -> dict:
    squeeze = zstandard.ZstdCompressor(level=1)
    return {"n": matrix.n, "zeros": matrix.zeros, "planes": [squeeze.compress(p.tobytes()) for p in matrix.planes],
            "ranks": [squeeze.compress(r.astype("<u4").tobytes()) for r in matrix.ranks]}


def open_shard(row: dict) -> WaveletMatrix:
    plain = zstandard.ZstdDecompressor()
    return WaveletMatrix(row["n"], list(row["zeros"]), [np.frombuffer(plain.decompress(p), np.uint8) for p in row["planes"]],
                         [np.frombuffer(plain.decompress(r), "<u4") for r in row["ranks"]])


def _shards(path: str, end: int, shard_tokens: int):
    def rows(batches):
        part, number, start = TaskContext.get().partitionId(), 0, 0
        bits = max(1, int(encoder(path).size - 1).bit_length())
        held, docs, size = [], [], 0

        def close():
            nonlocal number, start, held, docs, size
            ids = np.concatenate(held)
            doc_ids = np.concatenate([d[0] for d in docs])
            counts = np.concatenate([d[2] for d in docs])
            begins = start + np.cumsum(counts) - counts
            row = {"part": part, "number": number} | pack_shard(WaveletMatrix.build(ids, bits)) | {
                "doc_ids": doc_ids.astype("<i8").tobytes(), "no_id": np.concatenate([d[1] for d in docs]).tobytes(),
                "starts": begins.astype("<i8").tobytes(), "counts": counts.astype("<i8").tobytes()}
            number, start, held, docs, size = number + 1, start + len(ids), [], [], 0
            return pa.RecordBatch.from_pylist([row], SCHEMA)

        for piece in slices(batches, limit=WORDS_BYTES):
            ids, begin = ended(path, *flat(piece.column("text")), end)
            column = piece.column("doc_id")
            docs.append((column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False), np.diff(begin)))
            held.append(ids)
            size += len(ids)
            if size >= shard_tokens:
                yield close()
        if docs:
            yield close()

    return rows


SCHEMA = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("n", pa.int64()), ("zeros", pa.list_(pa.int64())),
                    ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())), ("doc_ids", pa.binary()),
                    ("no_id", pa.binary()), ("starts", pa.binary()), ("counts", pa.binary())])


def write(documents: DataFrame, path: str, folder: str, end: int = 0, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all rows, in ascending doc_id order, as shards under `folder`.

    Rows without doc_id come first, rows with the same doc_id in the order of their texts; null and
    empty texts are the end id alone.  Other columns are not looked at.
    """
    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_shards(path, end, shard_tokens), SHARDS).write.option("compression", "none").parquet(folder)


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = open_shard(row).all()
            counts = np.frombuffer(row["counts"], "<i8")
            cuts = np.concatenate([[0], np.cumsum(counts)])
            missing = np.frombuffer(row["no_id"], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(counts), row["part"])), pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=missing),
                 pa.array(np.frombuffer(row["starts"], "<i8")), pa.array(counts), binaries(ids, cuts)],
                ["part", "doc_id", "start", "n_tokens", "ids"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (binary) from the files.

    Only the totals of the parts, one row for each task that wrote, are summed in order; documents
    carry their place inside the part.
    """
    shards = spark.read.schema(SHARDS).parquet(folder)
    totals = shards.groupBy("part").agg(F.sum("n").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    docs = shards.mapInArrow(_read, "part long, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")
