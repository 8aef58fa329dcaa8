"""Removal of repeated byte strings by suffix arrays over shards.

1. Every `length`-byte window of a text belongs to the smallest k-gram hash inside it (its anchor), so
   equal windows belong to equal anchors, wherever they stand.  Consecutive windows with one anchor
   occurrence form a chunk; chunks with equal bytes around equal anchors are pre-aggregated: a later
   one repeats the first as a whole.  Anchors whose chunks are all equal need nothing more.
2. Of each remaining anchor the first chunk of every kind goes, with its bytes (once for each different
   text under its doc_id), to the shard that anchors are hashed to (windows of a very busy anchor are
   dealt by the bytes around it).  A shard's
   chunks are one text, whose suffixes external induced sorting puts in order with their common prefixes; windows in one run of common prefixes of `length` or more are
   equal, and all but the earliest are repeats.
3. Repeats are merged into removed spans, document by document.

All windows are covered, and equal windows always meet: nothing is sampled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SpanHashes, carried, flat, mixed, ragged, slices, stage, trim
from .inducedsort import END_OF_CHUNK, Scratch, sorted_suffixes

LENGTH = 100
GRAM = 24
SHARD_BYTES = 4 << 20
SEGMENT = 32 << 20  # longer texts are cut into overlapping segments of as many windows
_LOW = 26
HOT_CHUNKS = 512  # an anchor with more different chunks is dealt over shards by content
PARTS = 4
CHUNKS = "whole boolean, anchor long, chunk long, doc_id long, variant int, at long, windows long, ahead int"


def chunks(data: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """Of every chunk: anchor hash, chunk hash, text number, first window (in the text), windows, and
    how far ahead of the first window the anchor lies."""
    none = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4))]
    if len(data) < length:
        return none
    hashes = SpanHashes(data)
    grams = hashes.windows(gram)
    low = np.uint64(_LOW)
    # The place breaks ties, to the left; it fits because slices and segments are shorter than 2^26.
    least = ((grams >> low) << low) | np.arange(len(grams), dtype=np.uint64)
    span, width = length - gram + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:width - span], least[span - width:])
    sizes = np.diff(starts)
    inside = ragged(starts[:-1], np.maximum(sizes - length + 1, 0))  # windows that lie in one text
    if not len(inside):
        return none
    anchor = (least[inside] & np.uint64((1 << _LOW) - 1)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1))
    begin = np.flatnonzero(new)
    windows = np.diff(np.append(begin, len(inside)))
    first, anchor = inside[begin], anchor[begin]
    whole = hashes.of(first, first + windows - 1 + length) ^ mixed((anchor - first).astype(np.uint64))
    text = np.searchsorted(starts, first, side="right") - 1
    return [grams[anchor], whole, text, first - starts[text], windows, anchor - first]


def _chunk_rows(length: int, gram: int):
    def segments(batches):
        for part in slices(batches, limit=1 << 20):
            raw, starts = flat(part.column("text"))
            docs = part.column("doc_id").to_numpy(zero_copy_only=False), part.column("variant").to_numpy(zero_copy_only=False)
            if len(raw) <= SEGMENT:
                yield np.frombuffer(raw, np.uint8), starts, docs, 0
            else:  # a single long text
                for at in range(0, len(raw) - length + 1, SEGMENT):
                    piece = np.frombuffer(raw, np.uint8)[at:at + SEGMENT + length - 1]
                    yield piece, np.array([0, len(piece)]), docs, at

    def rows(batches):
        for data, starts, (ids, variants), base in segments(batches):
            anchor, chunk, text, at, windows, ahead = chunks(data, starts, length, gram)
            if not len(anchor):
                continue
            at = at + base
            # Repeats inside the slice need not travel to their anchor: the first of them speaks for all.
            order = np.lexsort((at, ids[text], chunk, anchor))
            a, c = anchor[order], chunk[order]
            # Rows with one doc_id and place are one place: the run's head decides for its equals.
            head = np.maximum.accumulate(np.where(np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])), np.arange(len(order)), 0))
            again = (ids[text[order]] != ids[text[order[head]]]) | (at[order] != at[order[head]])
            repeat = np.zeros(len(order), bool)
            repeat[order] = again
            r = np.flatnonzero(repeat)
            if len(r):  # side by side they are one
                new = np.append(True, (text[r][1:] != text[r][:-1]) | (at[r][1:] != (at + windows)[r][:-1]))
                head = r[new]
                total = np.add.reduceat(windows[r], np.flatnonzero(new))
                yield _batch(True, mixed(ids[text[head]].astype(np.uint64) * np.uint64(31) + at[head].astype(np.uint64)),
                             np.zeros(len(head), np.uint64), ids[text[head]], variants[text[head]], at[head], total, np.zeros(len(head), np.int64))
            k = np.flatnonzero(~repeat)
            yield _batch(False, anchor[k], chunk[k], ids[text[k]], variants[text[k]], at[k], windows[k], ahead[k])

    return rows


def _batch(whole, anchor, chunk, ids, variants, at, windows, ahead):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(at), whole)), pa.array(anchor.view(np.int64)), pa.array(chunk.view(np.int64)), pa.array(ids),
         pa.array(variants), pa.array(at), pa.array(windows), pa.array(ahead.astype(np.int32))], [f.split()[0] for f in CHUNKS.split(", ")])


def _shard_rows(length: int, memory: int):
    def rows(batches):
        with Scratch(memory) as scratch:
            path = scratch.path()
            ids, variants, at, windows, size = [], [], [], [], []
            with open(path, "wb") as f:
                for batch in batches:
                    raw, starts = flat(batch.column("bytes"))
                    n = np.diff(starts)
                    out = np.full(len(raw) + len(n), END_OF_CHUNK, np.uint8)
                    out[ragged(starts[:-1] + np.arange(len(n)), n)] = np.frombuffer(raw, np.uint8)
                    f.write(out.tobytes())
                    size.append(n + 1)
                    for kept, name in ((ids, "doc_id"), (variants, "variant"), (at, "at"), (windows, "windows")):
                        kept.append(batch.column(name).to_numpy())
            if not size:
                return
            ids, variants, at, windows, size = map(np.concatenate, (ids, variants, at, windows, size))
            begin = np.cumsum(size) - size
            text = np.memmap(path, np.uint8, "r")
            if len(text) <= scratch.memory * 8:
                text = np.array(text)
            flagged = []  # (chunk, window) that occurs earlier

            def settle(where, cut):
                """Suffixes in order, and where a run of equal windows begins."""
                chunk = np.searchsorted(begin, where, side="right") - 1
                offset = where - begin[chunk]
                run = np.cumsum(cut)
                use = offset < windows[chunk]
                chunk, offset, run = chunk[use], offset[use], run[use]
                many = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
                chunk, offset, run = chunk[many], offset[many], run[many]
                if not len(run):
                    return
                place = at[chunk] + offset
                order = np.lexsort((place, ids[chunk], run))
                chunk, offset, run, place = chunk[order], offset[order], run[order], place[order]
                new = np.append(True, run[1:] != run[:-1])
                head = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
                late = (ids[chunk] != ids[chunk[head]]) | (place != place[head])
                flagged.append((chunk[late], offset[late]))

            pending, cuts = [], []
            held = 0
            for where, shared in sorted_suffixes(scratch, text, length):
                cut = shared < length
                pending.append(where)
                cuts.append(cut)
                held += len(where)
                if held >= 1 << 18:
                    where, cut = np.concatenate(pending), np.concatenate(cuts)
                    last = np.flatnonzero(cut)
                    last = int(last[-1]) if len(last) else 0
                    if last:
                        settle(where[:last], cut[:last])
                    pending, cuts, held = [where[last:]], [cut[last:]], len(where) - last
            if pending:
                settle(np.concatenate(pending), np.concatenate(cuts))
            if not flagged:
                return
            chunk, offset = (np.concatenate(x) for x in zip(*flagged))
            order = np.lexsort((offset, chunk))
            chunk, offset = chunk[order], offset[order]
            new = np.append(True, (chunk[1:] != chunk[:-1]) | (offset[1:] != offset[:-1] + 1))
            head = np.flatnonzero(new)
            count = np.diff(np.append(head, len(chunk)))
            c = chunk[head]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[c]), pa.array(variants[c]), pa.array(at[c] + offset[head]), pa.array(count)],
                ["doc_id", "variant", "at", "windows"])

    def trimmed(batches):
        try:
            yield from rows(batches)
        finally:
            trim()

    return trimmed


def _shard(wanted: dict, raw: bytes) -> int:
    if wanted["core_from"] is None:
        return wanted["shard"]
    key = xxhash.xxh64_intdigest(raw[wanted["core_from"]:wanted["core_to"]], wanted["shard"] % 2**64)
    return key - 2**64 if key >= 2**63 else key


def _take_bytes(length: int):
    def rows(batches):
        for batch in slices(batches, "raw"):
            asked = batch.filter(pc.is_valid(batch.column("wanted")))
            for doc, variant, raw, wanted in zip(*(asked.column(c).to_pylist() for c in ("doc_id", "variant", "raw", "wanted"))):
                n = len(wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_shard(w, raw) for w in wanted]), pa.array(np.full(n, doc)), pa.array(np.full(n, variant, np.int32)),
                     pa.array([w["at"] for w in wanted]), pa.array([w["windows"] for w in wanted]),
                     pa.array([raw[w["at"]:w["at"] + w["windows"] - 1 + length] for w in wanted], pa.binary())],
                    ["shard", "doc_id", "variant", "at", "windows", "bytes"])

    return rows


def _remove(length: int, as_text: bool):
    def rows(batches):
        for batch in slices(batches, "raw"):
            out = []
            for raw, found in zip(batch.column("raw").to_pylist(), batch.column("found").to_pylist()):
                raw = raw or b""
                spans, kept = [], []
                if found:
                    found = np.sort(np.array(found, np.int64))
                    begin = found >> 31
                    reach = np.maximum.accumulate(begin + (found & (2**31 - 1)) - 1 + length)
                    new = np.append(True, begin[1:] > reach[:-1])
                    first = begin[new]
                    last = reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
                    spans = [{"begin": int(a), "end": int(b)} for a, b in zip(first, last)]
                    at = 0
                    for s in spans:
                        kept.append(raw[at:s["begin"]])
                        at = s["end"]
                    kept.append(raw[at:])
                out.append((len(raw), spans, b"".join(kept) if spans else raw))
            spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], spans_type),
                 pa.array([x[2].decode("utf-8", "ignore") for x in out]) if as_text else pa.array([x[2] for x in out], pa.binary()), *(batch.column(c) for c in batch.schema.names[4:])],
                ["doc_id", "n_bytes", "spans", "kept", *batch.schema.names[4:]])

    return rows


def _numbered(documents: DataFrame) -> tuple[DataFrame, bool]:
    """Adds variant: 0, or the number of the text among different texts under one doc_id; and whether a doc_id repeats."""
    repeated = documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if not repeated.limit(1).count():
        return documents.withColumn("variant", F.lit(0)), False
    kinds = (documents.join(repeated.select("doc_id"), "doc_id", "left_semi").select("doc_id", F.sha2("raw", 256).alias("hash")).distinct()
             .withColumn("variant", F.row_number().over(Window.partitionBy("doc_id").orderBy("hash"))))
    return (documents.withColumn("hash", F.sha2("raw", 256)).join(kinds, ["doc_id", "hash"], "left")
            .withColumn("variant", F.coalesce("variant", F.lit(0))).drop("hash")), True


def _sharded(wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Adds the shard of every chunk: its anchor's, or several for an anchor with very many chunks.

    Equal windows lie equally far before their anchor.  The windows of a busy anchor are cut into
    PARTS ranges of that distance; all windows of a range hold the same stretch around the anchor, so
    that stretch's bytes (core_from to core_to) decide the shard as well.
    """
    span = length - gram + 1
    parts = F.when(F.col("kinds") > HOT_CHUNKS, PARTS).otherwise(1)
    cut = wanted.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    near = F.ceil(F.col("part") * span / F.col("parts"))
    far = F.ceil((F.col("part") + 1) * span / F.col("parts")) - 1
    anchor_at, busy = F.col("at") + F.col("ahead"), F.col("parts") > 1
    cut = cut.withColumns({
        "first": F.greatest(F.lit(0), F.col("ahead") - far).cast("long"),
        "last": F.least(F.col("windows") - 1, F.col("ahead") - near).cast("long"),
        "core_from": F.when(busy, anchor_at - near), "core_to": F.when(busy, anchor_at - far + length)})
    return cut.where("first <= last").select(
        F.xxhash64("anchor", "part").alias("shard"), "doc_id", "variant", (F.col("at") + F.col("first")).alias("at"),
        (F.col("last") - F.col("first") + 1).alias("windows"), "core_from", "core_to")


def remove_repeats(spark: SparkSession, documents: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, memory: int = 1 << 21, keep: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, spans (removed, begin to end) and kept (binary) for every row, and the columns `keep`.

    A byte goes if a string of `length` bytes over it also begins earlier: in a smaller doc_id, or
    earlier in the same one.  Null is empty.  A row without doc_id is neither cut nor a reason to cut.
    Rows with one doc_id and the same text come back as often as they came, cut alike; different texts
    under one doc_id count as one document, by their begins.  Columns `keep` are carried through as
    keep_0, keep_1 and so on.  With `as_text`, kept is a string without characters that were cut apart.
    """
    columns, types = carried(documents, keep)
    docs = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"), *columns)
    docs, variants = _numbered(docs)
    # All columns travel on both readings, so that the exchange is the same.
    dealt = docs.repartition("doc_id")
    named = docs.where("doc_id IS NOT NULL")
    rows = (named.select("doc_id", "variant", F.col("raw").alias("text")).where(F.length("text") >= length)
            .mapInArrow(_chunk_rows(length, gram), CHUNKS))
    anchors = Window.partitionBy("anchor")
    same = Window.partitionBy("anchor", "chunk").orderBy("doc_id", "at")
    # Different texts under one doc_id may share the first place: it goes once for each of them.
    first = F.row_number().over(Window.partitionBy("anchor", "chunk", "variant").orderBy("doc_id", "at")) if variants else F.col("number")
    judged = (rows.repartition("anchor")
              .withColumn("place", F.rank().over(same)).withColumn("number", F.row_number().over(same)).withColumn("first", first)
              .withColumn("several", F.min("chunk").over(anchors) != F.max("chunk").over(anchors))
              .withColumn("whole", F.col("whole") | (F.col("place") > 1))
              .withColumn("kinds", F.sum((F.col("number") == 1).cast("int")).over(anchors))
              .where("whole OR (several AND first = 1)")
              .select("whole", "anchor", "doc_id", "variant", "at", "windows", "ahead", "kinds"))
    judged = stage(spark, judged, "suffix-chunks")
    wanted = _sharded(judged.where("NOT whole"), length, gram)
    size = wanted.agg(F.sum(F.col("windows") + length)).first()[0] or 0
    repeats = judged.where("whole").select("doc_id", "variant", "at", "windows")
    if size:
        listed = wanted.groupBy("doc_id", "variant").agg(F.collect_list(F.struct("shard", "at", "windows", "core_from", "core_to")).alias("wanted"))
        # A left join of the same dealt rows as below: their exchange is done once and read twice.
        taken = (dealt.join(listed, ["doc_id", "variant"], "left")
                 .mapInArrow(_take_bytes(length), "shard long, doc_id long, variant int, at long, windows long, bytes binary"))
        found = (taken.repartition(-(-size // shard_bytes), "shard")
                 .mapInArrow(_shard_rows(length, memory), "doc_id long, variant int, at long, windows long"))
        repeats = repeats.unionByName(found)
    # A place and its windows in one number: texts have fewer than 2^31 bytes.
    spans = (repeats.groupBy("doc_id", "variant")
             .agg(F.collect_list(F.shiftleft("at", 31).bitwiseOR(F.col("windows"))).alias("found")))
    extra = [f"keep_{k}" for k in range(len(keep))]
    schema = f"doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept {'string' if as_text else 'binary'}"
    return (dealt.join(spans, ["doc_id", "variant"], "left").select("doc_id", "variant", "raw", "found", *extra)
            .mapInArrow(_remove(length, as_text), schema + types))
