"""Token counts by rank-synchronous array merging.

The different pre-tokens of a slice are one ragged array of symbols.  In every step each pre-token
finds the lowest rank among its neighbouring pairs and all its pairs of that rank are joined at once,
in all pre-tokens together.  A pre-token without a pair that the vocabulary joins is done; what is
left of it is its number of tokens.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, slices, sums
from .encoding import byte_letters
from .pretokens import WORDS_BYTES, distinct, split

LIMIT = 512
NEVER = np.int64(2**31)


class Merges:
    """Ranks of the pairs of a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model, pre, added = config["model"], config["pre_tokenizer"] or {}, config["added_tokens"]
        if (model["type"] != "BPE" or config["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or len(added) > 1):
            raise ValueError("only plain byte-level BPE vocabularies are counted by merging")
        vocab = model["vocab"]
        self.special = added[0]["content"].encode() if added else None
        letters = byte_letters()
        self.bytes = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.order = keys[order], order.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NEVER)

    def count(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols left of each pre-token; `data` has their bytes side by side, none is empty."""
        out = np.zeros(len(lengths), np.int64)
        who, size = np.arange(len(lengths)), lengths.astype(np.int64)
        symbol = self.bytes[data]
        rank = np.full(len(symbol), NEVER)
        rank[:-1] = self.ranks(symbol[:-1], symbol[1:])
        rank[np.cumsum(size) - 1] = NEVER
        while len(who):
            start = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, start)
            going = low < NEVER
            out[who[~going]] = size[~going]
            if not going.all():
                stays = np.repeat(going, size)
                symbol, rank, who, size, low = symbol[stays], rank[stays], who[going], size[going], low[going]
                if not len(who):
                    break
                start = np.cumsum(size) - size
            join = rank == np.repeat(low, size)
            # Of pairs that overlap (equal symbols in a row) every second one is joined, from the left.
            at = np.flatnonzero(join)
            fresh = np.append(True, at[1:] != at[:-1] + 1)
            number = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[number % 2 == 0]
            symbol[at] = self.made[rank[at]]
            last = np.zeros(len(symbol), bool)
            last[start + size - 1] = True
            last[at] = last[at + 1]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            size = size - sums(~keep, start, start + size)
            place = np.cumsum(keep) - 1
            symbol, rank, last, at = symbol[keep], rank[keep], last[keep], place[at]
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[changed] = NEVER
            changed = changed[~last[changed]]
            rank[changed] = self.ranks(symbol[changed], symbol[changed + 1])
        return out


@cache
def merges(path: str) -> Merges:
    return Merges(path)


def text_counts(model: Merges, raw: bytes, starts: np.ndarray) -> np.ndarray:
    begin, _, first = split(raw, starts, model.special)
    words, which = distinct(raw, begin)
    data, offsets = flat(words)
    count = model.count(np.frombuffer(data, np.uint8), np.diff(offsets))
    if model.special:
        count[np.fromiter((w == model.special for w in words.to_pylist()), bool, len(words))] = 1
    return sums(count[which], first[:-1], first[1:])


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row.

    Null and empty texts have no bytes and no tokens; a null doc_id is kept; repeated rows are counted
    each; other columns are not looked at.
    """

    def rows(batches):
        for part in slices(batches, limit=WORDS_BYTES):
            raw, starts = flat(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(starts)), pa.array(text_counts(merges(path), raw, starts))],
                ["doc_id", "n_bytes", "n_tokens"])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return (plain.mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
