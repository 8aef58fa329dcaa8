"""Token ids of whole texts by the tokenizers library, every different pre-token once per worker.

The texts of a slice are split by array operations, equal pre-tokens are found by Arrow, and the
library's model is asked only for those that the worker has not met lately.  The memory of met ones
has two halves: what is asked for stays in the younger one, and once that is full the older one goes,
so it is bounded and frequent pre-tokens never leave.  A vocabulary that is not plain byte-level BPE
is encoded text by text.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .common import ragged
from .pretokens import distinct, split

REMEMBERED = 300_000  # pre-tokens in each half of a worker's memory


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others are numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def plain(values: pa.Array) -> list[bytes]:
    """The binary values as bytes, cut from their one buffer (boxing each costs ten times as much)."""
    _, offsets, data = values.buffers()
    cuts = np.frombuffer(offsets, np.int32)[values.offset:values.offset + len(values) + 1].tolist()
    held = data.to_pybytes() if data is not None else b""
    return [held[a:b] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pre, added = config["pre_tokenizer"] or {}, config["added_tokens"]
        # Special strings overlap if one holds another; then the library had better find them itself.
        self.plain = (config["normalizer"] is None and config["model"]["type"] == "BPE" and len(added) <= 1
                      and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                      and not config["truncation"] and not config["padding"]
                      and not any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added))
        self.special = added[0]["content"].encode() if added else None
        self.special_id = added[0]["id"] if added else None
        self.younger: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.letters = byte_letters()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _tokenize(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers, by the library's model."""
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        found, sizes = [], []
        for word in words:
            if word == self.special:
                found.append(self.special_id)
                sizes.append(1)
            else:
                tokens = tokenize(word.decode("latin-1").translate(letters))
                found += [t.id for t in tokens]
                sizes.append(len(tokens))
        data = np.array(found, "<u4").tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of the (different) words, remembered or asked for."""
        if len(self.younger) >= REMEMBERED:
            self.younger, self.older = {}, self.younger
        got = list(map(self.younger.get, words))
        absent = [i for i, ids in enumerate(got) if ids is None]
        unmet = []
        for i in absent:
            ids = self.older.get(words[i])
            if ids is None:
                unmet.append(i)
            else:
                got[i] = self.younger[words[i]] = ids
        for part in range(0, len(unmet), REMEMBERED):
            some = unmet[part:part + REMEMBERED]
            asked = [words[i] for i in some]
            for i, word, ids in zip(some, asked, self._tokenize(asked)):
                got[i] = self.younger[word] = ids
        return got

    def ids(self, raw: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts in a row, and where those of each text begin."""
        if not self.plain:
            texts = [raw[a:b].decode() for a, b in zip(starts, starts[1:])]
            each = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return (np.concatenate([np.array(e, np.uint32) for e in each] or [np.zeros(0, np.uint32)]),
                    np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64))
        begin, _, first = split(raw, starts, self.special)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
        words, which = distinct(raw, begin)
        each = self.of(plain(words))
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        at = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(each), "<u4")[ragged(at[which], size[which])]
        ends = np.concatenate([[0], np.cumsum(size[which])])
        return ids, ends[first]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def ended(path: str, column_raw: bytes, starts: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text followed by `end`, and where those of each text begin."""
    ids, first = encoder(path).ids(column_raw, starts)
    n = np.diff(first) + 1
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.full(begin[-1], end, np.uint32)
    out[ragged(begin[:-1], n - 1)] = ids
    return out, begin


def binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """values[cuts[i]:cuts[i + 1]] as binary values of little-endian 32-bit numbers."""
    data = np.ascontiguousarray(values.astype("<u4"))
    offsets = (np.asarray(cuts, np.int64) * 4)
    if offsets[-1] < 2**31:
        return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    return pa.array([data[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
