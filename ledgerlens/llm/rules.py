"""Quality rules: a decision list learned by sequential covering, run as Spark conditionals.

`statistics` measures every whole text once.  `learn` grows interpretable conjunctions of thresholds
on a bounded sample of labelled statistics: each rule is grown on one part of the sample by
information gain, pruned on the other part, and the rows it covers are set aside before the next.
`verdict` emits the ordered rules as one Spark CASE expression; the first rule that fires rejects.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, slices

SYMBOLS = b"#*$%&|<>"
WORDS_AT_LEAST = 50  # fixed base rule
REPEATED_AT_MOST = 50  # fixed base rule, per cent of the words
SAMPLE_ROWS = 12_000  # bound of the labelled sample
SEED = 17

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct_words", "n_capitals", "n_letters", "n_digits", "n_points", "longest_word"]
#: Ratios over which thresholds are learned, as (name, counted, out of).
RATIOS = [("symbols_per_char", "n_symbols", "word_chars"), ("dup_lines_share", "n_dup_lines", "n_lines"),
          ("repeat_share", "n_repeat_words", "n_words"), ("distinct_share", "n_distinct_words", "n_words"),
          ("capital_share", "n_capitals", "n_letters"), ("digit_share", "n_digits", "word_chars"),
          ("point_share", "n_points", "word_chars"), ("chars_per_word", "word_chars", "n_words"),
          ("longest_word", "longest_word", None), ("n_words", "n_words", None)]
_CONTINUATION = bytes(range(0x80, 0xC0))
_LOWER, _UPPER, _DIGITS = (bytes(range(a, b)) for a, b in ((97, 123), (65, 91), (48, 58)))
_POINTS = b"!?.,;:"


def _measure(raw: bytes) -> list[int]:
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(b"\x20\t\n\v\f\r")]
    n = len(words)
    repeated = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            covered = bytearray(n)
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    covered[i] = covered[i + 1] = covered[i + 2] = 1
            repeated = sum(covered)
    size = len(raw)
    without = lambda signs: size - len(raw.translate(None, signs))
    blanks = without(b"\x20\t\n\v\f\r")
    chars = size - without(_CONTINUATION)
    lower, upper = without(_LOWER), without(_UPPER)
    return [n, chars - blanks, without(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
            len(set(words)), upper, lower + upper, without(_DIGITS), without(_POINTS),
            max(map(len, words), default=0)]


def _rows(batches):
    for batch in slices(batches):
        counts = [_measure(x.encode()) if x else [0] * len(COUNTS) for x in batch.column("text").to_pylist()]
        columns = np.array(counts, np.int64).reshape(-1, len(COUNTS)).T
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns), *batch.columns[2:]],
                                         ["doc_id", *COUNTS, *batch.schema.names[2:]])


def statistics(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and the counts of `COUNTS` for every row; columns `keep` go along as keep_0, keep_1 and so on.

    A null or empty text has zero counts; a null doc_id is kept; repeated rows stay repeated; other
    columns of the input are not looked at, whatever their names.
    """
    columns, types = carried(documents, keep)
    schema = "doc_id long, " + ", ".join(f"{x} long" for x in COUNTS) + types
    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *columns)
    return plain.mapInArrow(_rows, schema)


def ratio(name: str) -> Column:
    _, top, bottom = next(r for r in RATIOS if r[0] == name)
    top = F.col(top).cast("double")
    return top if bottom is None else F.when(F.col(bottom) > 0, top / F.col(bottom)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.name]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        return ratio(self.name) > self.threshold if self.above else ratio(self.name) <= self.threshold

    def __str__(self):
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table) -> np.ndarray:
    out = np.ones(len(next(iter(table.values()))), bool)
    for c in rule:
        out &= c.covers(table)
    return out


def _gain(good: int, bad: int, good_before: int, bad_before: int) -> float:
    """Information gained about the bad rows that stay covered."""
    if not bad:
        return 0.0
    return bad * (np.log2(bad / (bad + good)) - np.log2(bad_before / (bad_before + good_before)))


def _grow(table, bad: np.ndarray, most: int, cuts: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most and (bad[inside].sum() and (~bad[inside]).sum()):
        n_bad, n_good = int(bad[inside].sum()), int((~bad[inside]).sum())
        best, best_gain = None, 1e-9
        for name, values in table.items():
            x, y = values[inside], bad[inside]
            order = np.argsort(x, kind="stable")
            x, y = x[order], y[order]
            ends = np.flatnonzero(x[1:] > x[:-1])  # a cut lies between different values
            if not len(ends):
                continue
            ends = ends[np.unique(np.linspace(0, len(ends) - 1, min(cuts, len(ends))).astype(int))]
            low_bad = np.cumsum(y)[ends]
            for k, b in zip(ends, low_bad):
                threshold = float((x[k] + x[k + 1]) / 2)
                low = k + 1
                for above, p, n in ((False, b, low - b), (True, n_bad - b, n_good - (low - b))):
                    gain = _gain(int(n), int(p), n_good, n_bad)
                    if gain > best_gain:
                        best, best_gain = Condition(name, above, threshold), gain
        if best is None:
            break
        rule.append(best)
        inside &= best.covers(table)
    return tuple(rule)


def _prune(rule: Rule, table, bad: np.ndarray) -> tuple[Rule, float, int]:
    """Drop last conditions as long as (bad - good) / covered does not fall on the pruning part."""
    best, best_value, best_bad, best_share = rule, -2.0, 0, 0.0
    for k in range(len(rule), 0, -1):
        inside = _covered(rule[:k], table)
        n, p = int(inside.sum()), int(bad[inside].sum())
        value = (2 * p - n) / n if n else -1.0
        if value >= best_value:
            best, best_value, best_bad, best_share = rule[:k], value, p, p / n if n else 0.0
    return best, best_share, best_bad


def learn(table: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 12, most_conditions: int = 4,
          precision: float = 0.95, support: int = 3, cuts: int = 64) -> list[Rule]:
    """Ordered rules that reject; empty without both labels.  Works on a bounded sample only."""
    rng = np.random.default_rng(SEED)
    growing = rng.random(len(bad)) < 2 / 3
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules:
        g, p = left & growing, left & ~growing
        if not bad[g].any() or not (~bad[g]).any():
            break
        grown = _grow({k: v[g] for k, v in table.items()}, bad[g], most_conditions, cuts)
        if not grown:
            break
        rule, share, found = _prune(grown, {k: v[p] for k, v in table.items()}, bad[p])
        if share < precision or found < support:
            break
        rules.append(rule)
        left &= ~_covered(rule, table)
    return rules


def sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and label of at most `rows` labelled documents, chosen by hash."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    chosen = documents.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    return statistics(chosen).join(F.broadcast(known), "doc_id")


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list; the driver gets `rows` rows of ratios at most."""
    got = sample(documents, labels, rows).select("doc_id", "quality", *(ratio(r[0]).alias("_" + r[0]) for r in RATIOS))
    local = got.orderBy("doc_id", *(f"_{r[0]}" for r in RATIOS)).limit(rows).toPandas()
    table = {r[0]: local["_" + r[0]].to_numpy(float) for r in RATIOS}
    if local.empty:
        return []
    # Rows that the base rules refuse anyway teach nothing.
    rest = (table["n_words"] >= WORDS_AT_LEAST) & (table["repeat_share"] * 100 <= REPEATED_AT_MOST)
    if not rest.any():
        return []
    return learn({k: v[rest] for k, v in table.items()}, local["quality"].to_numpy()[rest] == 0)


def fired(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that covers a row, else null: one ordered CASE."""
    out = None
    for k, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, k) if out is None else out.when(condition, k)
    return (F.lit(None) if out is None else out).cast("int")


def judge(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts, base_failed, kept and the rule that fired for every row of `documents`.

    Null and empty texts have no words, so the base rules refuse them.  With no usable label the list
    is empty and the base rules alone decide.
    """
    rules = fit(documents, labels, rows)
    failed = ((F.col("n_words") < WORDS_AT_LEAST)
              | (100 * F.col("n_repeat_words") > REPEATED_AT_MOST * F.col("n_words")))
    return (statistics(documents, keep).withColumn("base_failed", failed).withColumn("rule", fired(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))
