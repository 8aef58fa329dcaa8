"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints that occur are kept once, with the smallest document that has them.  The trie over them
is cut at a depth that grows with their number; the subtrie under each prefix is one unit of work and
meets itself and the later prefixes that the error budget still allows.  Inside a unit, pairs of
nodes are followed together, all pairs of one depth at a time; differing bits add up, and a pair of
nodes is dropped as soon as the budget is exceeded.

Two words of 64 bits that differ in b bits differ in at most b // 2 bits in one of their halves, so
the join runs over two tries, one with each half on top: b // 2 bits are allowed above the middle
and b in all.  That misses nothing and follows far fewer nodes.

A unit returns a spanning forest of the links it finds, never all pairs of a group.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, slices, stage
from .components import components

SHINGLE_WORDS = 4
MAXIMUM_BITS = 4
SEED = 42
UNIT_ROWS = 4096  # fingerprints under one prefix, about
HALF = 32
_FRONTIER = 1 << 19  # pairs of nodes followed at once
_LEAF = 8  # pairs under two nodes that are compared directly


def fingerprint(raw: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    words = raw.lower().split()  # A-Z only; blanks are \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    begins = [0, *ends]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest,
                             [joined[a:b - 1] for a, b in zip(begins, ends[shingle_words - 1:])], repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at:at + (1 << 16)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, bits long) for every row, and the columns `keep`; texts without words, and null, have bits 0."""
    columns, types = carried(documents, keep)

    def rows(batches):
        for batch in slices(batches):
            bits = [fingerprint(x.encode(), shingle_words) if x else 0 for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(bits, np.uint64).view(np.int64)), *batch.columns[2:]],
                ["doc_id", "bits", *batch.schema.names[2:]])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *columns)
    return plain.mapInArrow(rows, "doc_id long, bits long" + types)


class Forest:
    """Union-find over 0..n-1 that takes arrays of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while True:
            higher = self.parent[up]
            if np.array_equal(higher, up):
                return up
            up = higher

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            low, high = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
            self.parent[high] = low  # one of several wins; the rest come round again
            self.parent = self.roots(np.arange(len(self.parent)))


def _follow(own: np.ndarray, every: np.ndarray, depth: int, budget: int, link) -> None:
    """Call link(i, j) with positions in `own` and `every` (both sorted) that are near enough."""
    ones = {}

    def split(which, keys, t, low, high):
        if (which, t) not in ones:
            bit = (keys >> np.uint64(63 - t)) & np.uint64(1)
            ones[which, t] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        c = ones[which, t]
        return high - (c[high] - c[low])

    shift = np.uint64(64 - depth) if depth else None
    prefixes = (every >> shift) if depth else np.zeros(len(every), np.uint64)
    low = np.flatnonzero(np.append(True, prefixes[1:] != prefixes[:-1]))
    high = np.append(low[1:], len(every))
    mine = (own[0] >> shift) if depth else np.uint64(0)
    apart = np.bitwise_count(prefixes[low] ^ mine).astype(np.int64)
    zero = np.zeros(len(low), np.int64)
    todo = [(depth, np.stack([zero, zero + len(own), low, high, apart]))]
    while todo:
        t, pairs = todo.pop()
        pairs = pairs[:, pairs[4] <= (budget // 2 if t <= HALF else budget)]
        if pairs.shape[1] > _FRONTIER:
            middle = pairs.shape[1] // 2
            todo += [(t, pairs[:, middle:]), (t, pairs[:, :middle])]
            continue
        a0, a1, b0, b1, apart = pairs
        size = (a1 - a0) * (b1 - b0)
        small = (size <= _LEAF) | (t == 64)
        if small.any():
            n = size[small]
            which = np.repeat(np.flatnonzero(small), n)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            wide = (b1 - b0)[which]
            i, j = a0[which] + k // wide, b0[which] + k % wide
            differ = own[i] ^ every[j]
            near = np.bitwise_count(differ) <= budget
            link(i[near], j[near])
        if small.all():
            continue
        a0, a1, b0, b1, apart = pairs[:, ~small]
        am, bm = split(0, own, t, a0, a1), split(1, every, t, b0, b1)
        child = np.concatenate([np.stack(x) for x in (
            (a0, am, b0, bm, apart), (am, a1, bm, b1, apart), (a0, am, bm, b1, apart + 1), (am, a1, b0, bm, apart + 1))], axis=1)
        todo.append((t + 1, child[:, (child[0] < child[1]) & (child[2] < child[3])]))


def _unit(depth: int, budget: int):
    def links(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view(np.uint64)
        nodes, guest = table.column("node").to_numpy(), table.column("guest").to_numpy(zero_copy_only=False)
        order = np.argsort(keys, kind="stable")
        keys, nodes, guest = keys[order], nodes[order], guest[order]
        mine = np.flatnonzero(~guest)
        forest = Forest(len(keys))
        if len(mine):
            _follow(keys[mine], keys, depth, budget, lambda i, j: forest.link(mine[i], j))
        root = forest.roots(np.arange(len(keys)))
        linked = root != np.arange(len(keys))
        return pa.table({"a": nodes[linked], "b": nodes[root[linked]]})

    return links


def links(spark: SparkSession, kept: DataFrame, budget: int = MAXIMUM_BITS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Links (a, b) that join what lies within `budget` bits; `kept` has different bits and a node each."""
    n = kept.count()
    depth = min(HALF - 2, max(0, int(np.ceil(np.log2(max(1, n / unit_rows))))))
    masks = [sum(1 << b for b in bits) for k in range(min(budget // 2, depth) + 1) for bits in combinations(range(depth), k)]
    halves = F.array(F.struct(F.lit(0).alias("top"), F.col("bits").alias("key")),
                     F.struct(F.lit(1).alias("top"),
                              F.shiftleft("bits", 32).bitwiseOR(F.shiftrightunsigned("bits", 32)).alias("key")))
    turned = kept.select("node", F.explode(halves).alias("h")).select("node", "h.top", "h.key")
    prefix = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    units = F.array_distinct(F.transform(F.array(*(F.lit(m).cast("long") for m in masks)),
                                         lambda m: F.least(F.col("prefix"), F.col("prefix").bitwiseXOR(m))))
    dealt = (turned.withColumn("prefix", prefix)
             .select("node", "top", "key", "prefix", F.explode(units).alias("unit"))
             .select("top", "unit", "key", "node", (F.col("unit") != F.col("prefix")).alias("guest")))
    return dealt.groupBy("top", "unit").applyInArrow(_unit(depth, budget), "a long, b long")


def _groups(spark: SparkSession, prints: DataFrame, maximum_bits: int) -> DataFrame:
    """(bits, group_id, component_id) of every fingerprint: a label of its group, and the group's smallest doc_id."""
    kept = stage(spark, prints.where("doc_id IS NOT NULL").groupBy("bits").agg(F.min("doc_id").alias("node")), "simhash-kept")
    if not kept.groupBy("node").count().where("count > 1").limit(1).count():
        found = components(spark, links(spark, kept, maximum_bits), "simhash")
        label = F.coalesce("component", "node")
        return kept.join(found, "node", "left").select("bits", label.alias("group_id"), label.alias("component_id"))
    # Different texts under one doc_id: the doc_id does not link what they are near to, so nodes are fingerprints.
    found = components(spark, links(spark, kept.select("bits", F.col("bits").alias("node")), maximum_bits), "simhash")
    labelled = stage(spark, kept.join(found.withColumnRenamed("node", "bits"), "bits", "left")
                     .select("bits", F.coalesce("component", "bits").alias("group_id"), "node"), "simhash-labelled")
    return labelled.join(labelled.groupBy("group_id").agg(F.min("node").alias("component_id")), "group_id").drop("node")


def grouped(spark: SparkSession, documents: DataFrame, shingle_words: int = SHINGLE_WORDS,
            maximum_bits: int = MAXIMUM_BITS) -> DataFrame:
    """(doc_id, bits, group_id, component_id) for every row; group_id tells groups with one smallest doc_id apart."""
    prints = stage(spark, fingerprints(documents, shingle_words), "simhash-prints")
    return (prints.join(_groups(spark, prints, maximum_bits), "bits", "left")
            .select("doc_id", "bits", *(F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("group_id", "component_id"))))


def near_duplicates(spark: SparkSession, documents: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    maximum_bits: int = MAXIMUM_BITS) -> DataFrame:
    """(doc_id, bits, component_id) for every row.

    Null and empty texts have bits 0 and are linked like any other.  Repeated rows come back as often
    as they came; different texts under one doc_id each belong to the group of what they are near to.
    A row without doc_id gets its bits and a null component_id and links nothing.
    """
    return grouped(spark, documents, shingle_words, maximum_bits).drop("group_id")
