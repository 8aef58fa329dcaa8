"""The n-gram Jaccard join against comparing all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import jaccardjoin, queries


def sets(documents, width=3):
    for doc, text in documents:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = low.encode().split()
        yield doc, ({tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())


def brute(documents, percent=90, width=3):
    """Sorted (doc_id, n_shingles, component_id) of rows whose doc_ids differ or whose texts are equal."""
    held = list(sets(documents, width))
    parent = list(range(len(held)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (doc, a) in enumerate(held):
        for j in range(i):
            other, b = held[j]
            if a and b and doc is not None and other is not None and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(held):
        if doc is not None:
            smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    return sorted(((doc, len(a), smallest.get(root(i))) for i, (doc, a) in enumerate(held)), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def variants(pick, count, edits, base=None, words=120):
    base = base or [f"w{pick.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(pick.randint(0, edits)):
            text[pick.randrange(len(text))] = f"e{pick.randrange(100000)}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def clusters():
    pick = random.Random(11)
    shared = " ".join(f"s{i}" for i in range(60))
    texts = [t for c in range(12) for t in variants(pick, 8, 5)]
    texts += [shared + " " + " ".join(f"w{pick.randrange(4000)}" for _ in range(pick.randint(0, 120))) for _ in range(60)]
    texts += [" ".join(f"t{i}" for i in range(n)) for n in range(1, 40)]  # chains of prefixes
    texts += [None, "", " \n ", "one", "One", "one two", "ONE two", "one  two three"]
    return [(1000 - i, t) for i, t in enumerate(texts)]


def test_documents(spark, corpus):
    documents = [(r.doc_id, r.text) for r in corpus.collect()]
    got = rows(jaccardjoin.join(spark, corpus))
    # one doc_id holds two texts there: they differ, so each has its own component
    want = brute(documents)
    assert [(d, n) for d, n, _ in got] == [(d, n) for d, n, _ in want] and got == want


@pytest.mark.parametrize("percent, region", [(90, 1 << 21), (90, 900), (70, 1500), (50, 1 << 21)])
def test_clusters(spark, clusters, percent, region):
    documents = spark.createDataFrame(clusters, "doc_id long, text string").selectExpr("*", "'x' AS node", "1 AS n", "2 AS keys").repartition(5)
    assert rows(jaccardjoin.join(spark, documents, percent=percent, region_shingles=region)) == brute(clusters, percent)


def test_a_large_cluster_is_cut(spark):
    """Copies that differ among themselves by more than allowed, so that their region doesn't fold into its pivot."""
    pick = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    texts = variants(pick, 250, 4, base) + variants(pick, 150, 3, [f"w{i}" if i > 12 else f"v{i}" for i in range(100)])
    documents = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(documents, "doc_id long, text string")
    want = brute(documents)
    for region in (1 << 21, 6000):
        assert rows(jaccardjoin.join(spark, df, region_shingles=region)) == want


def test_empty(spark, nothing):
    assert jaccardjoin.join(spark, nothing).collect() == []


def test_units_recurse():
    """Inside a task: regions by pivots, down to leaves, give the links of all pairs."""
    rng = np.random.default_rng(4)
    groups = [np.unique(rng.integers(0, 1 << 40, 60)) for _ in range(40)]
    held = []
    for g in groups:
        for _ in range(12):
            keys = g.copy()
            keys[rng.integers(0, len(g), 3)] = rng.integers(1 << 41, 1 << 42, 3)
            held.append(np.unique(keys))
    n = np.array([len(h) for h in held])
    no = np.full(len(held), -1)
    members = jaccardjoin._Members(pa.array(held, pa.list_(pa.int64())), n, no, np.ones(len(held), bool), no)
    forest = jaccardjoin.Forest(len(held))
    jaccardjoin._join(members, np.arange(len(held)), members.home, 90, forest)
    plain = jaccardjoin.Forest(len(held))
    every = np.arange(len(held))
    common = jaccardjoin._common(members, every, every)
    a, b = np.nonzero(100 * common >= 90 * (n[:, None] + n[None, :] - common))
    plain.link(a, b)
    assert (forest.roots(every) == plain.roots(every)).all()
    sample = set(held[0].tolist()) & set(held[1].tolist())
    assert common[0, 1] == len(sample)


def test_query(spark, sf):
    documents = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op13_jaccard_join(spark, sf)) == brute(documents)
