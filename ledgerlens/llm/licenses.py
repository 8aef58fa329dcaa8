"""Licence scans.

One Aho-Corasick automaton finds all notice phrases and identifier tags in a text's normalised words.
After a tag the licence expression of the raw text is read by a shunting-yard parser, which turns
`and`, `or`, `with` and brackets into postfix order, and evaluated: `or` is a choice (the freest
counts), `and` is both (the strictest counts), `with` is an exception to the licence before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notice phrases, in normalised words.
NOTICES = {
    "gnu general public license": "gpl", "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd", "bsd 3 clause": "bsd", "bsd 2 clause": "bsd",
    "licensed under the apache license": "apache-2", "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0", "dedicated to the public domain": "public-domain", "all rights reserved": "all-rights-reserved",
}
#: Tags that a licence expression follows, in normalised words.
TAGS = ("spdx license identifier", "license expression", "licence expression")
#: How freely a text may be used under a label, 0 to 1; labels that aren't listed count as 0.
FREEDOM = {"public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0,
           "apache-2": 0.95, "cc-by": 0.9, "mpl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3,
           "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nd": 0.2, "cc-by-nc-nd": 0.1, "all-rights-reserved": 0.0}
_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_NORMAL = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))
_TAG = re.compile(r"(?:spdx[^\w\n]+license[^\w\n]+identifier|licen[sc]e[^\w\n]+expression)[ \t]*[:=]", re.ASCII)
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


def label(identifier: str) -> str:
    """Family of a licence identifier: versions and `only`, `or-later` and `+` are dropped."""
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.rstrip(".:-"))
    name = re.sub(r"-(?:v?\d+(?:\.\d+)*)(?:-(?:clause|international|unported))?$", "", name)
    name = re.sub(r"^bsd-.*", "bsd", name)
    return {"apache": "apache-2", "cc0-1.0": "cc0"}.get(name, name)


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: operands and operators in the order of evaluation, or None if it isn't an expression."""
    out, waiting, operand = [], [], True
    for t in tokens:
        if t == "(":
            if not operand:
                return None
            waiting.append(t)
        elif t == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif t in _BINDS:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[t]:
                out.append(waiting.pop())
            waiting.append(t)
            operand = True
        else:
            if not operand:
                return None
            out.append(t)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def longest(tokens: Iterable[str]) -> list[str]:
    """The longest beginning that is a whole expression: one pass, up to the first token that can't go on."""
    seen, whole, depth, operand = [], 0, 0, True
    for t in tokens:
        if t == ")":
            if operand or not depth:
                break
            depth -= 1
        elif (t in _BINDS) == operand:  # an operator where an operand is due, or the other way round
            break
        elif t == "(":
            depth += 1
        else:
            operand = not operand
        seen.append(t)
        if not operand and not depth:
            whole = len(seen)
    return seen[:whole]


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels that an expression names and its freedom; trailing words that don't continue it are left."""
    tokens = longest(m.group() for m in _TOKEN.finditer(expression.lower()))
    order = postfix(tokens)
    if order is None:
        return None
    labels: set[str] = set()
    stack: list[tuple[float, str | None]] = []
    for t in order:
        if t not in _BINDS:
            stack.append((FREEDOM.get(label(t), 0.0), label(t)))
            continue
        (right, right_name), (left, left_name) = stack.pop(), stack.pop()
        if t == "with":  # the right side names an exception, not a licence
            if left_name:
                labels.add(left_name)
            stack.append(((1 + left) / 2 if left else left, None))
            continue
        labels.update(x for x in (left_name, right_name) if x)
        stack.append((max(left, right) if t == "or" else min(left, right), None))
    value, name = stack[0]
    return labels | ({name} if name else set()), value


def expressions(text: str) -> Iterator[str]:
    """What follows each tag of a lower-case text, up to the next tag or the line's end."""
    tags = list(_TAG.finditer(text))
    for m, limit in zip(tags, [*(m.start() for m in tags[1:]), len(text)]):
        end = text.find("\n", m.end(), limit)
        yield text[m.end():limit if end < 0 else end]


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    kinds: dict[str, list] = {}
    for phrase, name in BASE.items():
        kinds.setdefault(phrase, []).append(("base", name))
    for phrase, name in NOTICES.items():
        kinds.setdefault(phrase, []).append(("notice", name))
    for phrase in TAGS:
        kinds.setdefault(phrase, []).append(("tag", None))
    for phrase, what in kinds.items():
        found.add_word(f" {phrase} ", (len(phrase) + 1, what))
    found.make_automaton()
    return found


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base labels, all labels and score of one text.

    The score is the strictest freedom of all that was found, 0 where nothing was.
    """
    words = (text or "").encode().translate(_NORMAL).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0
    line = f" {b' '.join(words).decode()} "
    n_base, first, last = 0, None, None
    base, every, freedom, tagged = set(), set(), [], False
    for end, (size, what) in automaton().iter(line):
        for kind, name in what:
            if kind == "tag":
                tagged = True
                continue
            every.add(name)
            freedom.append(FREEDOM.get(name, 0.0))
            if kind == "base":
                n_base += 1
                base.add(name)
                at = end - size
                first, last = at if first is None else min(first, at), at if last is None else max(last, at)
    if tagged:
        for got in map(evaluate, expressions(text.lower())):
            if got:
                every |= got[0]
                freedom.append(got[1])
    if n_base:
        first, last = line.count(" ", 0, first), line.count(" ", 0, last)
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(every)), min(freedom, default=0.0)


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def licences(documents: DataFrame) -> DataFrame:
    """doc_id and COLUMNS for every row.

    Null and empty texts have no words, no places (null), empty labels and score 0; a null doc_id is
    kept; repeated rows are scanned each; other columns are not looked at.
    """
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def rows(batches):
        for part in slices(batches):
            found = list(zip(*(scan(x) for x in part.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(found, types))],
                                             ["doc_id", *(f.split()[0] for f in COLUMNS.split(", "))])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(rows, "doc_id long, " + COLUMNS)
