"""Exact top-k inner products by MaxScore.

The components of a vector are the terms of a query.  A shard of candidates knows the smallest and
largest impact of each of its terms, so a query's term adds between lb and ub there.  With the k-th
best score known so far, the terms with the smallest spans ub - lb that together cannot lift a
candidate past it are non-essential.  Postings of essential terms are traversed; the other terms are
probed, widest span first, for candidates that are still competitive.  Shards are merged per query.

Shards and blocks of queries meet in a two-way deal of both, so that neither side is broadcast and no
task holds more than a shard and a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 5
QUERY_EVERY = 50
SCALE = 256
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
_PRIMERS = 64


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and whole components; null vectors, and those with null or non-finite components, are left out."""
    x = F.col("embedding")
    good = (F.col("vec_id").isNotNull() & x.isNotNull()
            & ~F.coalesce(F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    return embeddings.where(good).select(F.col("vec_id").cast("long"), whole.alias("v")).distinct()


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors go on with zeros."""
    column = column.combine_chunks()
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(n), width), np.int64)
    rows = np.repeat(np.arange(len(n)), n)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def search(shard: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best candidates of a shard, ties to the smaller id."""
    low, high = shard.min(axis=0), shard.max(axis=0)
    lb, ub = np.minimum(query * low, query * high), np.maximum(query * low, query * high)
    span = ub - lb
    allowed = ids != own
    if allowed.sum() <= k:
        best = np.flatnonzero(allowed)
    else:
        order = np.argsort(-span, kind="stable")
        terms = order[span[order] > 0]  # a term with one impact says nothing
        fixed = int(lb[span == 0].sum())
        # A few candidates with the strongest impact of the widest term give a first threshold.
        threshold = None
        if len(terms):
            impact = np.where(allowed, shard[:, terms[0]] * query[terms[0]], np.iinfo(np.int64).min)
            some = np.argpartition(-impact, min(_PRIMERS, len(impact) - 1))[:_PRIMERS]
            some = some[allowed[some]]
            if len(some) >= k:
                threshold = np.partition(shard[some] @ query, len(some) - k)[len(some) - k]
        # Non-essential: the longest tail of terms that stays below the threshold when all else is least.
        floor = int(lb.sum())
        tail = np.cumsum(span[terms][::-1])
        spare = 0 if threshold is None else int(np.searchsorted(tail, threshold - floor, side="left"))
        essential, others = terms[:len(terms) - spare], terms[len(terms) - spare:]
        alive = np.flatnonzero(allowed & ((shard[:, essential] != np.where(query[essential] > 0, low[essential], high[essential])).any(axis=1)
                                          if len(others) else True))
        score = shard[np.ix_(alive, essential)] @ query[essential] + fixed
        left_ub, left_lb = int(ub[others].sum()), int(lb[others].sum())
        for at in range(0, len(others) + 1, 4):
            if len(alive) > k:
                kth = np.partition(score, len(score) - k)[len(score) - k] + left_lb
                threshold = kth if threshold is None else max(threshold, kth)
                near = score + left_ub >= threshold
                alive, score = alive[near], score[near]
            group = others[at:at + 4]
            if len(group):
                score = score + shard[np.ix_(alive, group)] @ query[group]
                left_ub, left_lb = left_ub - int(ub[group].sum()), left_lb - int(lb[group].sum())
        best = alive
    exact = shard[best] @ query
    order = np.lexsort((ids[best], -exact))[:k]
    return best[order], exact[order]


def _meet(k: int):
    def rows(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if len(candidates) and len(queries):
            width = max(max(t.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False), default=0)
                        for t in (candidates, queries))
            shard, asked = _matrix(candidates.column("v"), int(width)), _matrix(queries.column("v"), int(width))
            ids = candidates.column("vec_id").to_numpy()
            for own, query in zip(queries.column("vec_id").to_numpy(), asked):
                best, score = search(shard, ids, query, own, k)
                out.append((np.full(len(best), own), ids[best], score))
        a, b, c = (np.concatenate(x).astype(np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"query_id": a, "vec_id": b, "score": c})

    return rows


def top(spark: SparkSession, embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY,
        shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose id is divisible by `every` its k best others.

    Vectors of different lengths are compared as if the shorter went on with zeros.  Equal repeated
    rows count once; rows with the query's own id are never its candidates; if rows with one id hold
    different vectors, the best score of each pair of ids counts.  Rows without id, null vectors and
    vectors with null or non-finite components take no part.  Without queries there are no rows.
    """
    vectors = quantised(embeddings)
    asking = vectors.where(F.col("vec_id") % every == 0)
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-asking.count() // block_rows))
    dealt = vectors.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    asked = asking.select("vec_id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                          F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    found = (dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInArrow(_meet(k), "query_id long, vec_id long, score long"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""
