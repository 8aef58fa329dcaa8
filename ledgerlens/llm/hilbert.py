"""Packing along a space-filling curve.

Each document's hashed word vector is projected to `DIMENSIONS` numbers: every word adds plus or minus
one to each, by bits of its hash, and the sum is divided by the square root of the words.  The numbers
are put on a grid and the Hilbert curve through the grid gives one key.  Spark sorts the documents by
ranges of that key, cut where about equally many bytes lie between two cuts; inside a range their ids are one stream that is cut every `WIDTH` ids, so that
neighbours on the curve share sequences.  What is left at the end of a range is cut at powers of two,
which need no padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHashes, flat, slices, stage, words
from .encoding import binaries, ended
from .pretokens import WORDS_BYTES

DIMENSIONS, BITS = 4, 12
WIDTH = 1024


def projections(raw: bytes, starts: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row of numbers of about unit spread per text; zeros for a text without words."""
    data = np.frombuffer(raw, np.uint8)
    n = len(starts) - 1
    out = np.zeros((n, dimensions))
    if not len(data):
        return out
    begin, end, first = words(data, starts)
    hashes = SpanHashes(data).of(begin, end)
    count = np.diff(first)
    for d in range(dimensions):
        sign = ((hashes >> np.uint64(d)) & np.uint64(1)).astype(np.int64) * 2 - 1
        running = np.concatenate([[0], np.cumsum(sign)])
        out[:, d] = (running[first[1:]] - running[first[:-1]]) / np.sqrt(np.maximum(count, 1))
    return out


def grid(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells 0..2^bits - 1; the logistic curve spreads about normal numbers evenly."""
    return np.minimum((1 / (1 + np.exp(-1.702 * np.clip(points, -12, 12))) * 2**bits).astype(np.int64), 2**bits - 1)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each cell (row) on the Hilbert curve: Gray-code reflections from the top bit down,
    then the interleaved bits, as in Skilling's published transform."""
    x = [cells[:, k].astype(np.int64).copy() for k in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        side = 1 << level
        for k in range(len(x)):
            up = (x[k] & side) != 0
            swap = np.where(up, 0, (x[0] ^ x[k]) & (side - 1))
            x[0] = np.where(up, x[0] ^ (side - 1), x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[-1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    x = [v ^ turn for v in x]
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> level) & 1)
    return key


GRAIN = 1 << 16  # bytes of text per entry of the sample that ranges are cut by
RANGE_BYTES = 128 << 20  # most text a range should hold
SMALL_BYTES = 4 << 20  # no more ranges than one per so many bytes
SAMPLE_ROWS = 1_000_000  # entries of the sample that reach the driver, 16 bytes each


def _keys(part: pa.RecordBatch) -> np.ndarray:
    return hilbert_keys(grid(projections(*flat(part.column("text")))))


def _ids(part: pa.RecordBatch) -> np.ndarray:
    """doc_ids, null as the smallest: Spark sorts it first as well."""
    return part.column("doc_id").fill_null(-2**63).to_numpy(zero_copy_only=False)


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def range_cuts(documents: DataFrame, grain: int = GRAIN, range_bytes: int = RANGE_BYTES,
               small_bytes: int = SMALL_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Places (key, doc_id) on the curve that cut it into ranges of about equally many bytes.

    A task enters a document into the sample once for every `grain` bytes it has passed, so a long text
    weighs as much as many short ones.  Cuts decide only which task packs a document.
    """

    def rows(batches):
        passed = (TaskContext.get().partitionId() * 40503) % grain
        for part in slices(batches):
            size = np.diff(flat(part.column("text"))[1])
            ends = passed + np.cumsum(size)
            times = ends // grain - (ends - size) // grain
            passed = int(ends[-1])
            chosen = np.flatnonzero(times)
            if len(chosen):
                some = part.take(pa.array(chosen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(x, times[chosen])) for x in (_keys(some), _ids(some))], ["key", "id"])

    spark = documents.sparkSession
    sample = stage(spark, _plain(documents).mapInArrow(rows, "key long, id long"), "curve-sample")
    entries = sample.count()
    known = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-entries * grain // range_bytes), min(known, entries * grain // small_bytes))
    wanted = min(SAMPLE_ROWS, 100 * parts)
    if entries > wanted:
        sample = sample.where(F.rand(11) < wanted / entries)
    found = sample.toArrow()
    key, doc = (found.column(c).to_numpy() for c in ("key", "id"))
    order = np.lexsort((doc, key))
    at = np.unique(np.arange(1, parts) * len(order) // parts) if len(order) else np.zeros(0, np.int64)
    pairs = np.unique(np.column_stack([key[order[at]], doc[order[at]]]), axis=0)
    return pairs[:, 0], pairs[:, 1]


def range_of(key: np.ndarray, doc: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of cuts at or before each (key, doc_id)."""
    low, high = (np.searchsorted(cuts[0], key, side=s) for s in ("left", "right"))
    out = low.copy()
    tied = high > low
    for begin in np.unique(low[tied]):  # cuts inside one key: many copies of a text
        here = tied & (low == begin)
        end = high[np.argmax(here)]
        out[here] = begin + np.searchsorted(cuts[1][begin:end], doc[here], side="right")
    return out


def keyed(documents: DataFrame, cuts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, text, the curve key and the range of every row."""

    def rows(batches):
        for part in slices(batches):
            key = _keys(part)
            number = range_of(key, _ids(part), cuts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(key), pa.array(number)],
                                             ["doc_id", "text", "key", "part"])

    return _plain(documents).mapInArrow(rows, "doc_id long, text string, key long, part int")


def _cut(total: int, width: int) -> np.ndarray:
    """Ends of the sequences of a stream of `total` ids: full ones, then powers of two."""
    ends = list(range(width, total + 1, width))
    at = total // width * width
    for size in (1 << k for k in range(width.bit_length() - 1, -1, -1)):
        if (total - at) & size and size < width:
            at += size
            ends.append(at)
    return np.array(ends, np.int64)


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pieces(path: str, width: int, end: int):
    def emit(docs, lengths, first_start, ids, ends, number):
        """Pieces of documents that lie side by side in `ids`, cut at `ends` as well."""
        stops = np.cumsum(lengths)
        begins = stops - lengths
        cuts = np.unique(np.concatenate([[0], stops, ends]))
        cuts = cuts[cuts <= ends[-1]]
        a, b = cuts[:-1], cuts[1:]
        which = np.searchsorted(stops, a, side="right")
        sequence = np.searchsorted(ends, a, side="right")
        base = np.concatenate([[0], ends])[sequence]
        yield pa.RecordBatch.from_arrays(
            [docs["id"].take(pa.array(which)), pa.array(a - begins[which] + first_start[which]), pa.array(b - a),
             binaries(ids[:ends[-1]], cuts), pa.array(docs["tokens"][which]), pa.array(number + sequence), pa.array(a - base)],
            [f.split()[0] for f in PIECES.split(", ")])

    def rows(batches):
        number = TaskContext.get().partitionId() << 36
        # The open sequence: documents with ids that no emitted sequence holds yet.
        kept = {"id": pa.array([], pa.int64()), "tokens": np.zeros(0, np.int64)}
        lengths, first_start, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        for part in slices(batches, limit=WORDS_BYTES):
            new, begin = ended(path, *flat(part.column("text")), end)
            n = np.diff(begin)
            docs = {"id": pa.concat_arrays([kept["id"], part.column("doc_id")]), "tokens": np.concatenate([kept["tokens"], n])}
            lengths, first_start = np.concatenate([lengths, n]), np.concatenate([first_start, np.zeros(len(n), np.int64)])
            ids = np.concatenate([ids, new])
            full = len(ids) // width
            if full:
                ends = np.arange(1, full + 1) * width
                yield from emit(docs, lengths, first_start, ids, ends, number)
                number += full
                stops = np.cumsum(lengths)
                open_ = stops > ends[-1]
                done = np.maximum(0, ends[-1] - (stops - lengths))[open_]
                docs = {"id": docs["id"].filter(pa.array(open_)), "tokens": docs["tokens"][open_]}
                lengths, first_start, ids = lengths[open_] - done, first_start[open_] + done, ids[ends[-1]:]
            kept = docs
        if len(ids):
            yield from emit(kept, lengths, first_start, ids, _cut(len(ids), width), number)

    return rows


def pack(documents: DataFrame, path: str, width: int = WIDTH, end: int = 0, **sizes) -> DataFrame:
    """Pieces (PIECES) of every row's ids in sequences of `width` at most.

    `path` is a tokenizers file that executors can open; `sizes` go to `range_cuts`.  Null and empty texts
    are the end id alone; texts longer than a sequence go on in the next; repeated rows are packed each; a
    null doc_id is kept.  Other columns are not looked at.  Rows of one key and doc_id share a range.
    """
    cuts = range_cuts(documents, **sizes)
    along = keyed(documents, cuts).repartitionById(len(cuts[0]) + 1, "part").sortWithinPartitions("key", "doc_id", "text")
    return along.select("doc_id", "text").mapInArrow(_pieces(path, width, end), PIECES)
