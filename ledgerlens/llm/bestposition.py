"""Exact ranked lexical search by best positions.

A shard of documents holds, for every query term, its postings in order of impact.  A query reads its
lists in parallel by direct access: in every round each list gives its next positions that have not
been seen.  The documents met there are scored at once in all lists, which also marks their positions
in those.  A list's best position is the end of its run of seen positions; what no list has shown yet
can score at most the sum of the impacts right after the best positions.  The search of a shard ends
when that sum lies strictly below the k-th best score, so that ties are still settled by doc_id.

The k-th score is carried from shard to shard of a task.  Items are handled in blocks of bounded
size against all documents, so that what a task is given doesn't grow with the items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ragged, reach, slices, stage, sums

K = 50
BLOCK_BYTES = 4 << 20  # terms of the items that are searched together
SHARD_POSTINGS = 2 << 20
_FIRST, _MOST = 16, 4096  # positions of a list that a round reads: doubled from round to round
_MERGE = 64  # groups in which an item's results are merged first
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TABLE = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the different terms of all rows of an item; rows without item_id are left out."""
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    return (items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), F.explode(words).alias("term"))
            .distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")))


def counted(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's number of terms, and its counts of those in `vocabulary`."""
    size = max(1, len(vocabulary))

    def rows(batches):
        for batch in slices(batches):
            split = [terms_of(x) if x else [] for x in batch.column("text").to_pylist()]
            n = np.fromiter(map(len, split), np.int64, len(split))
            met = np.fromiter(map(vocabulary.get, (w for words in split for w in words), repeat(-1)), np.int64, int(n.sum()))
            owner = np.repeat(np.arange(len(split)), n)[met >= 0]
            keys, tf = np.unique(owner * size + met[met >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(keys, np.arange(len(split) + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(ends, pa.array((keys % size).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(rows, "doc_id long, n long, terms array<int>, tfs array<int>")


class Shard:
    """Documents with their postings, by document and by term in order of impact."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, vocabulary: int):
        self.ids, self.terms, self.impacts = ids, terms, impacts
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        owner = np.repeat(np.arange(len(ids)), lengths)
        order = np.lexsort((-impacts, terms))
        self.list_starts = np.searchsorted(terms[order], np.arange(vocabulary + 1))
        self.list_docs, self.list_impacts = owner[order], impacts[order]
        self.places = np.empty(len(terms), np.int64)  # of a posting in its term's list
        self.places[order] = np.arange(len(terms)) - self.list_starts[terms[order]]


class Best:
    """The k best (score, doc_id) met so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a further document must reach; scores of 0 never count."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def search(shard: Shard, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Add a shard's best documents for a query to `best`; returns how many documents were scored."""
    start, length = shard.list_starts[terms], shard.list_starts[terms + 1] - shard.list_starts[terms]
    terms, weights, start, length = (x[length > 0] for x in (terms, weights, start, length))
    if not len(terms):
        return 0
    slot = np.full(len(shard.list_starts), -1)
    slot[terms] = np.arange(len(terms))
    weight_of = np.zeros(len(shard.list_starts), np.int64)
    weight_of[terms] = weights
    base = np.cumsum(length + 1) - (length + 1)
    seen = np.zeros(int(base[-1] + length[-1] + 1), bool)  # the place after a list's end is never seen
    known = np.zeros(len(shard.ids), bool)
    position, step, scored = np.zeros(len(terms), np.int64), _FIRST, 0
    while True:
        open_ = position < length
        bound = int((weights[open_] * shard.list_impacts[(start + position)[open_]]).sum())
        if bound < best.least:
            return scored
        take = np.minimum(step, length - position)
        fresh = ~seen[ragged(base + position, take)]
        docs = np.unique(shard.list_docs[ragged(start + position, take)[fresh]])
        docs = docs[~known[docs]]
        known[docs] = True
        scored += len(docs)
        sizes = shard.ends[docs] - shard.starts[docs]
        postings = ragged(shard.starts[docs], sizes)
        of = shard.terms[postings]
        gains = weight_of[of] * shard.impacts[postings]
        ends = np.cumsum(sizes)
        best.add(sums(gains, ends - sizes, ends), shard.ids[docs])
        mine = slot[of] >= 0
        seen[base[slot[of[mine]]] + shard.places[postings[mine]]] = True
        position += take
        while (more := seen[base + position]).any():
            position += more
        step = min(2 * step, _MOST)


def _found(queries: list, weights: np.ndarray, documents: int, total: int, k: int):
    """Search all documents of a task, shard by shard."""
    def rows(batches: Iterator[pa.RecordBatch]):
        best, held, waiting = [Best(k) for _ in queries], [], 0

        def work():
            ids, n, lengths, terms, tf = (np.concatenate(x) for x in zip(*held))
            m = 50 + (50 * n * documents) // total
            m = np.repeat(m, lengths)
            shard = Shard(ids, lengths, terms, (1_000_000_000 * tf) // (1000 * tf + 20 * m), len(weights))
            for (_, asked), mine in zip(queries, best):
                search(shard, asked, weights[asked], mine)
            held.clear()

        for batch in batches:
            lists = batch.column("terms")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("n").to_numpy(zero_copy_only=False), lengths,
                         lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                         batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)))
            waiting += int(lengths.sum())
            if waiting >= SHARD_POSTINGS:
                work()
                waiting = 0
        if held:
            work()
        for (item, _), mine in zip(queries, best):
            if len(mine.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine.ids), item)), pa.array(mine.ids), pa.array(mine.scores)],
                                                 ["item_id", "doc_id", "score"])

    return rows


def rank(spark: SparkSession, documents: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of every item that score highest, above 0.

    Equal scores go by doc_id.  A term is a maximal run of letters, digits and characters beyond ASCII, A-Z in
    lower case.  Every row of `documents` counts as a document: repeated rows are ranked next to each other, rows without doc_id count in
    the statistics and are never returned; null and empty texts have no terms.  Rows with one item_id are one item; items without
    item_id, without terms or without a match have no rows.
    """
    reach(spark)
    asked = stage(spark, item_terms(items), "position-items")
    size = asked.agg(F.sum(F.expr("aggregate(terms, 0L, (s, t) -> s + octet_length(t) + 16)"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    results = None
    for block in range(blocks):
        # about block_bytes: items are dealt to blocks by hash
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id").collect()
        vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for row in mine for t in row["terms"]}))}
        queries = [(row["item_id"], np.sort(np.array([vocabulary[t.encode()] for t in row["terms"]], np.int64))) for row in mine]
        counts = stage(spark, counted(documents, vocabulary), "position-counts")
        n, total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for term, number in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = number
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        held = counts.where("doc_id IS NOT NULL AND size(terms) > 0")
        found = held.mapInArrow(_found(queries, weights, n, max(total, 1), k), "item_id long, doc_id long, score long")
        found = stage(spark, found, "position-found")
        results = found if results is None else results.unionByName(found)

    def best(df: DataFrame, *by) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id"))
        return df.withColumn("rank", place).where(F.col("rank") <= k)

    part = F.pmod(F.xxhash64("doc_id"), F.lit(_MERGE)).alias("part")
    first = best(results.select("*", part), "item_id", "part").drop("rank", "part")
    return best(first, "item_id").select("item_id", "rank", "doc_id", "score")


SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') AS words FROM documents
), s AS (
  SELECT count(*) FILTER (WHERE len(words) > 0) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS total FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), r AS (
  SELECT row_number() OVER () AS r, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM d
), w AS (
  SELECT r, doc_id, n, unnest(words) AS term FROM r
), p AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, CAST(count(*) AS BIGINT) AS tf
  FROM w WHERE term IN (SELECT term FROM q) GROUP BY r, term
), f AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term, n_docs
), c AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY item_id, r
), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM c WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= {K}
"""
