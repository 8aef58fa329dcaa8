"""What the operators share: bounded slices of Arrow batches, flat text buffers, stage tables."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.workspace import fresh_folder

SLICE_BYTES = 1 << 20  # text handled at once inside a task; one longer text is handled alone
#: Rows and bytes that Spark hands to a Python worker at once, so that a batch of long texts stays small.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, and bound their batches."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(df: DataFrame, keep: tuple[str, ...]) -> tuple[list, str]:
    """Columns `keep` under names that clash with nothing, and their part of a schema."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ([F.col(f"`{c}`").alias(f"keep_{k}") for k, c in enumerate(keep)],
            "".join(f", keep_{k} {types[c]}" for k, c in enumerate(keep)))


def renamed(keep: tuple[str, ...]) -> list:
    return [F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds at most `limit` bytes of `column`, or one row."""
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
            ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < len(ends):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
                yield batch.slice(first, last - first)
                first = last
    finally:
        trim()


def trim() -> None:
    """Give memory that a task has freed back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def flat(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a column as one run of UTF-8 bytes, and where each begins; null is empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)
    starts = starts[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = b"" if data is None else data.slice(starts[0], starts[-1] - starts[0]).to_pybytes()
    return raw, starts - starts[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start..start+length-1 of every piece, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[start:end] for each pair, empty pieces included."""
    running = np.concatenate([[0], np.cumsum(values)])
    return running[ends] - running[starts]


_FACTOR = 0x9E3779B97F4A7C15
_UNFACTOR = pow(_FACTOR, -1, 2**64)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(which: int, factor: int, size: int) -> np.ndarray:
    if len(_powers[which]) < size:
        grown = np.full(max(size, (4 << 20) + (1 << 16)), factor, np.uint64)
        grown[0] = 1
        _powers[which] = np.cumprod(grown)
    return _powers[which]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the usual finaliser)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class SpanHashes:
    """64-bit hashes of any spans of one byte array, by one running sum.

    Equal spans hash equally wherever they lie, in every slice and on every executor.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _grown(0, _FACTOR, n + 1)[:n], out=self.sums[1:])
        self.undo = _grown(1, _UNFACTOR, n + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.undo[begin])

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:-width]) * self.undo[:n])


BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, starts: np.ndarray, separators: np.ndarray = BLANKS):
    """Begin and end of the words of all texts, and for text i its range first[i]:first[i + 1]."""
    solid = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(solid & np.append(True, ~solid[:-1] | edge[1:-1])[:len(data)])
    end = np.flatnonzero(solid & np.append(~solid[1:] | edge[1:-1], True)[-len(data):]) + 1 if len(data) else begin
    return begin, end, np.searchsorted(begin, starts)
