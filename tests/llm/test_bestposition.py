"""Ranked search against scoring everything."""

import math
import re
from collections import Counter

import numpy as np

from ledgerlens.llm import bestposition, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, k):
    """{item_id: [(doc_id, score), ...]} by scoring every document for every item."""
    held = [(doc, Counter(terms(text))) for doc, text in documents]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, wanted in asked.items():
        scores = []
        for (doc, counts), n in zip(held, sizes):
            m = 50 + (50 * n * n_docs) // total if total else 50
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
                        for t in wanted if counts[t])
            if score > 0 and doc is not None:
                scores.append((doc, score))
        if scores:
            out[item] = sorted(scores, key=lambda s: (-s[1], s[0]))[:k]
    return out


def table(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r.rank)):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


def test_against_scoring_everything(spark, corpus, monkeypatch):
    items = [(1, "alpha1 BETA2 gamma3"), (2, "Wörter é漢😀"), (3, None), (4, ""), (5, "nowhere-to-be-found"), (None, "alpha1"),
             (6, "repeat"), (6, "this line, repeat"), (7, "x" * 5000), (8, "passage that several of the documents hold " * 3)]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS score", "2 AS doc_id", "3 AS terms")
    documents = [(r.doc_id, r.text) for r in corpus.collect()]
    monkeypatch.setattr(bestposition, "SHARD_POSTINGS", 40)  # several shards a task
    for k in (1, 3, 50):
        assert table(bestposition.rank(spark, corpus, asked, k)) == brute(documents, items, k)
    assert table(bestposition.rank(spark, corpus, asked, 3, block_bytes=60)) == brute(documents, items, 3)


def test_ties_go_by_doc_id(spark):
    rows = [(i, "same words here" if i % 2 else "same words here and some more of them") for i in range(200, 0, -1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(0, "words more")], "item_id long, text string")
    assert table(bestposition.rank(spark, documents, items, 20)) == brute(rows, [(0, "words more")], 20)


def test_empty_tables(spark, nothing, corpus):
    items = spark.createDataFrame([(1, "alpha1")], "item_id long, text string")
    assert bestposition.rank(spark, nothing, items).collect() == []
    assert bestposition.rank(spark, corpus, items.limit(0)).collect() == []


def shard_of(rng, docs, vocabulary):
    lengths = rng.integers(1, 12, docs)
    terms_ = np.concatenate([np.sort(rng.choice(vocabulary, n, replace=False)) for n in lengths])
    impacts = (rng.pareto(1.0, len(terms_)) * 1000).astype(np.int64) + 1
    return bestposition.Shard(rng.permutation(docs).astype(np.int64), lengths, terms_, impacts, vocabulary), terms_, impacts, lengths


def test_stops_early_and_exactly(spark):
    """Skewed impacts: far from all documents are scored, and the result is that of scoring all."""
    rng = np.random.default_rng(3)
    shard, terms_, impacts, lengths = shard_of(rng, 50_000, 40)
    weights = rng.integers(1, 5000, 40)
    asked = np.array([1, 5, 17, 33])
    best = bestposition.Best(10)
    scored = bestposition.search(shard, asked, weights[asked], best)
    gains = np.where(np.isin(terms_, asked), weights[terms_] * impacts, 0)
    score = np.add.reduceat(gains, np.cumsum(lengths) - lengths)
    order = np.lexsort((shard.ids, -score))[:10]
    assert best.scores.tolist() == score[order].tolist() and best.ids.tolist() == shard.ids[order].tolist()
    assert scored < 10_000


def test_stops_only_strictly_below(spark):
    """Equal scores behind the best position still count if their doc_id is smaller."""
    ids = np.arange(999, -1, -1)
    shard = bestposition.Shard(ids, np.ones(1000, np.int64), np.zeros(1000, np.int64), np.full(1000, 7), 1)
    best = bestposition.Best(3)
    bestposition.search(shard, np.array([0]), np.array([2]), best)
    assert best.ids.tolist() == [0, 1, 2] and best.scores.tolist() == [14] * 3


def test_query(spark, sf):
    documents = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert table(queries.op12_best_position(spark, sf)) == brute(documents, items, 50)
