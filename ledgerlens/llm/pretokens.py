"""Pre-tokens of byte-level BPE for many texts at once, by array operations.

The split is the one of the vocabulary's published pattern: contractions, an optional blank before a
run of letters, digits or other signs, white space up to the last blank.  Every code point has one of
four classes, so the matches follow from where the class changes.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

WORDS_BYTES = 2 << 20  # text split at once: equal pre-tokens are found within it
OTHER, LETTER, NUMBER, SPACE = range(4)
# The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
# The contractions of the pattern, without the apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


@cache
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                        np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


def split(raw: bytes, starts: np.ndarray, special: bytes | None = None):
    """Byte offsets of all pre-tokens of the texts raw[starts[i]:starts[i + 1]].

    Returns (begin, end, first): begin and end of each pre-token in `raw`, and for text i the range
    first[i]:first[i + 1] of its pre-tokens.  With `special`, each occurrence of that string inside a
    text is one pre-token and the text is split around it first.
    """
    size = len(raw)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    data = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # byte offset of each code point
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    kind = classes()[points]
    edge = np.zeros(n + 1, bool)  # a text, or a piece beside a special string, begins here
    edge[np.searchsorted(at, starts)] = True
    edge[n] = edge[0] = True
    marks = []
    if special and special in raw:
        length, found = len(special), raw.find(special)
        while found >= 0:
            text_end = starts[np.searchsorted(starts, found, side="right")]
            if found + length <= text_end:
                marks.append(found)
                found = raw.find(special, found + length)
            else:
                found = raw.find(special, found + 1)
        edge[np.searchsorted(at, marks)] = True
        edge[np.searchsorted(at, np.array(marks) + length)] = True
    change = edge.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    blank = points == 0x20
    begin = change[:n].copy()
    # A run of letters, digits or signs takes the blank before it along.
    begin[1:] &= space[1:] | edge[1:n] | ~blank[:-1]
    # White space gives its last code point away when something else follows.
    last = np.flatnonzero(space & change[1:] & ~edge[1:])
    begin[last] = True
    quote = np.flatnonzero((points == 0x27) & change[:n] & change[1:] & begin & ~edge[1:])
    if len(quote):
        near = np.zeros((2, len(quote)), np.uint32)
        near[0] = points[quote + 1]
        two = quote + 2 < n
        two[two] = ~edge[quote[two] + 2]
        near[1, two] = points[quote[two] + 2]
        taken = np.isin(near[0], [ord(x) for x in ONE_LETTER]).astype(np.int64)
        for pair in TWO_LETTERS:
            taken[(near[0] == ord(pair[0])) & (near[1] == ord(pair[1]))] = 2
        quote, taken = quote[taken > 0], taken[taken > 0]
        begin[quote + 1] = False
        after = quote + 1 + taken
        begin[after[after < n]] = True
        # A blank that follows stays with the next run; the run's own begin was kept off above.
    first_byte = at[np.flatnonzero(begin)]
    if marks:
        inside = np.searchsorted(marks, first_byte, side="right") - 1
        marks = np.array(marks)
        drop = (inside >= 0) & (first_byte > marks[inside]) & (first_byte < marks[inside] + length)
        first_byte = first_byte[~drop]
    end = np.append(first_byte[1:], size)
    return first_byte, end, np.searchsorted(first_byte, starts)


def distinct(raw: bytes, begin: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The different pre-tokens (binary) and, for each pre-token, which one it is.

    Pre-tokens lie side by side, so `begin` says everything.
    """
    if not len(begin):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    offsets = np.append(begin, len(raw)).astype(np.int32)
    whole = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    coded = whole.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)
