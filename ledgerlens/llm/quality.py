"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. Every word has a sparse random index vector, made from its hash.  One pass over all texts adds the
   index vectors of each word's neighbours into the word's row of a table of fixed size (words are
   hashed into `ROWS` rows, by shape), combined per task and summed by Spark.  The finished table has
   ROWS x DIMS numbers however large the corpus is.
2. A document is the mean and the spread of its word vectors, with its length and variety.
3. A network of two layers is trained by numpy on a bounded sample of labelled documents; its
   temperature is fitted on rows of the sample that training did not see.
4. All documents are scored in one more pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SpanHashes, carried, flat, mixed, slices, sums

DIMS, NEAR = 32, 2
#: Rows of the table for words in lower or mixed case, in capitals, with digits, and for signs.
SHAPES = (8192, 4096, 1024, 3072)
ROWS = sum(SHAPES)
SAMPLE_ROWS = 8_000  # bound of the labelled sample
THRESHOLD = 0.7
SEED = 23

_KIND = np.ones(256, np.uint8)  # 1: letters and what is not ASCII, 2: signs, 0: between words
_KIND[:128] = 2
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KIND[[*range(33), 127]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each row's index vector: three by hash, one by shape."""
    rows = np.arange(ROWS, dtype=np.uint64)
    draws = np.stack([mixed(rows * np.uint64(8) + np.uint64(k + 1)) for k in range(3)])
    places = (draws % np.uint64(DIMS - len(SHAPES))).astype(np.int64)
    signs = np.where(draws >> np.uint64(63), 1, -1)
    shape = np.repeat(np.arange(len(SHAPES)), SHAPES)
    return np.vstack([places, DIMS - len(SHAPES) + shape]), np.vstack([signs, np.ones(ROWS, np.int64)])


PLACES, SIGNS = _index_vectors()


def word_rows(raw: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table row of every word of the texts, and for text i its range first[i]:first[i + 1]."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    edge[0] = edge[-1] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    cuts = np.flatnonzero(edge)
    begin, end = cuts[:-1], cuts[1:]
    solid = kind[begin] > 0
    begin, end = begin[solid], end[solid]
    hashes = SpanHashes(_LOWER[data]).of(begin, end)
    capital = (data >= 65) & (data <= 90)
    capitals = sums(capital, begin, end)
    shape = np.zeros(len(begin), np.int64)
    shape[(capitals > 1) & (capitals == end - begin)] = 1
    shape[(data[begin] >= 48) & (data[begin] <= 57)] = 2
    shape[kind[begin] == 2] = 3
    size = np.array(SHAPES, np.uint64)[shape]
    rows = np.concatenate([[0], np.cumsum(SHAPES)])[shape] + (hashes % size).astype(np.int64)
    return rows, np.searchsorted(begin, starts)


def add_contexts(table: np.ndarray, rows: np.ndarray, first: np.ndarray) -> None:
    """Add the index vectors of each word's neighbours within `NEAR` words of the same text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here, there = [], []
    for gap in range(1, NEAR + 1):
        a, b = rows[:-gap], rows[gap:]
        same = text[:-gap] == text[gap:]
        a, b = a[same], b[same]
        here += [a, b]
        there += [b, a]
    if here:
        here, there = np.concatenate(here) * DIMS, np.concatenate(there)
        cells = np.concatenate([here + PLACES[k][there] for k in range(len(PLACES))])
        table += np.bincount(cells, np.concatenate([SIGNS[k][there] for k in range(len(PLACES))]), ROWS * DIMS).astype(np.int64)


def _contexts(batches):
    table = np.zeros(ROWS * DIMS, np.int64)
    for part in slices(batches):
        add_contexts(table, *word_rows(*flat(part.column("text"))))
    table = table.reshape(ROWS, DIMS)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(np.ascontiguousarray(table[used, k])) for k in range(DIMS))],
                                     ["row", *(f"d{k}" for k in range(DIMS))])


def word_vectors(documents: DataFrame) -> np.ndarray:
    """ROWS x DIMS vectors of length one (or zero), from the contexts in all texts."""
    parts = (documents.select(F.col("text").cast("string"))
             .mapInArrow(_contexts, "row long, " + ", ".join(f"d{k} long" for k in range(DIMS))))
    got = parts.groupBy("row").agg(*(F.sum(f"d{k}").alias(f"d{k}") for k in range(DIMS))).toPandas()
    out = np.zeros((ROWS, DIMS), np.float32)
    if len(got):
        vectors = got[[f"d{k}" for k in range(DIMS)]].to_numpy(float)
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        out[got["row"].to_numpy()] = vectors / np.where(length > 0, length, 1)
    return out


FEATURES = 2 * DIMS + 3


def pooled(vectors: np.ndarray, raw: bytes, starts: np.ndarray) -> np.ndarray:
    """One row of features per text; a text without words has zeros."""
    rows, first = word_rows(raw, starts)
    n = np.diff(first)
    out = np.zeros((len(n), FEATURES))
    full = np.flatnonzero(n)
    if len(full):
        m, at = n[full][:, None], first[:-1][full]
        v = vectors[rows]
        mean = np.add.reduceat(v, at, axis=0, dtype=np.float64) / m
        out[full, :DIMS] = mean
        np.square(v, out=v)
        out[full, DIMS:2 * DIMS] = np.sqrt(np.maximum(np.add.reduceat(v, at, axis=0, dtype=np.float64) / m - mean**2, 0))
        text = np.repeat(np.arange(len(n)), n)
        different = np.bincount(np.unique(text * ROWS + rows) // ROWS, minlength=len(n))
        repeated = np.zeros(len(rows), np.int64)
        repeated[1:] = (rows[1:] == rows[:-1]) & (text[1:] == text[:-1])
        out[:, 2 * DIMS] = np.log1p(n) / 10
        out[full, 2 * DIMS + 1] = different[full] / np.sqrt(n[full])
        out[full, 2 * DIMS + 2] = np.add.reduceat(repeated, at) / n[full]
    return out


@dataclass
class Network:
    """tanh layer, then a logistic unit whose logit is divided by the temperature."""
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 16, steps: int = 400, rate: float = 0.02,
          decay: float = 1e-3) -> Network:
    """Full-batch Adam on four fifths of the rows, temperature on the rest.

    With one label only, or none, the network is a constant: the share of label 1 among the rows and
    four more, of which three have it.
    """
    rng = np.random.default_rng(SEED)
    centre, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    share = (y.sum() + 3) / (len(y) + 4)
    net = Network(centre, scale, np.zeros((FEATURES, hidden)), np.zeros(hidden), np.zeros(hidden), float(np.log(share / (1 - share))))
    held = rng.random(len(y)) < 0.2
    if len(np.unique(y[~held])) < 2:
        return net
    z = np.clip((x - centre) / scale, -8, 8)
    zt, yt = z[~held], y[~held].astype(float)
    weight = np.where(yt == 1, 0.5 / yt.mean(), 0.5 / (1 - yt.mean()))  # both labels count alike
    p = [rng.normal(0, FEATURES**-0.5, (FEATURES, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for step in range(1, steps + 1):
        h = np.tanh(zt @ p[0] + p[1])
        error = weight * (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - yt) / len(yt)
        back = np.outer(error, p[2]) * (1 - h * h)
        grads = [zt.T @ back + decay * p[0], back.sum(axis=0), h.T @ error + decay * p[2], error.sum(keepdims=True)]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, scale, p[0], p[1], p[2], float(p[3][0]))
    if held.any():
        logits, truth = net.logit(x[held]), y[held]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        losses = [np.logaddexp(0, np.where(truth == 1, -1, 1) * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of the whole corpus and a network trained on at most `rows` labelled documents."""
    vectors = word_vectors(documents)
    known = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    chosen = (documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
              .join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text"))

    def features(batches):
        for part in slices(batches):
            x = pooled(vectors, *flat(part.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), lists], ["doc_id", "quality", "x"])

    local = (chosen.mapInArrow(features, "doc_id long, quality int, x array<double>")
             .orderBy("doc_id", "x").limit(rows).toPandas())
    x = np.stack(local["x"].to_list()) if len(local) else np.zeros((0, FEATURES))
    return vectors, train(x, local["quality"].to_numpy().astype(int))


def score(spark: SparkSession, documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS,
          threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    Null and empty texts are scored as texts without words; a null doc_id counts as not held out and
    is never trained on; repeated rows are scored alike; other columns are not looked at, and go along
    as keep_0, keep_1 and so on if named in `keep`.
    """
    vectors, net = fit(spark, documents, labels, rows)

    def scored(batches):
        for part in slices(batches):
            s = net.score(pooled(vectors, *flat(part.column("text"))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), *part.columns[2:]], ["doc_id", "score", *part.schema.names[2:]])

    columns, types = carried(documents, keep)
    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *columns)
    return (plain.mapInArrow(scored, "doc_id long, score double" + types)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"),
                    *(f"keep_{k}" for k in range(len(keep)))))
