"""Conversation structure repair over a suffix-shared DAWG.

A conversation's rows become a signature, one symbol a row: its role's initial and its fault.  Read
from the end, signatures share their suffixes: a node of the automaton is a suffix, and equal
suffixes of all conversations are one node.  For a node and each state of the grammar
`(s?(ua)+)?` the cheapest cost-to-go and the best audit suffix are found once, from those of the
node behind it.

Distinct signatures are range-sorted by their reversal, so that a task walks the automaton depth
first with no more than the current path in memory; only the few nodes on the path at which a range
begins are found again.

The edits of a row are Delete, Insert (before it), Keep and Rerole.  In a given state each leads to
one state, so the best audits of two different edits differ in their first letter, and equal costs
are settled by that letter alone.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import reach, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # what the edits cost; a truncated row that stays adds TRUNCATED
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)  # states of the grammar; _START and _ASSISTANT may end it
_REQUIRED = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_KEPT = {("s", _START): _SYSTEM, ("a", _USER): _ASSISTANT} | {("u", q): _USER for q in (_START, _SYSTEM, _ASSISTANT)}
_LEGAL = {"su", "ua", "au"}
_MUST_DELETE = "D"  # the symbol of blank and repeated rows; others: s u a x, in capitals if truncated


@dataclass(frozen=True)
class Node:
    """A suffix of signatures: per state the cost-to-go, and the best audit as cells (letter, rest)."""

    costs: tuple
    audits: tuple

    def audit(self, state: int = _START) -> str:
        letters, cell = [], self.audits[state]
        while cell is not None:
            letters.append(cell[0])
            cell = cell[1]
        return "".join(letters)


def _with_inserts(direct: list) -> Node:
    """Let each state also insert the turn that the grammar requires there; `direct` has (cost, letter, audit) per state."""
    best = list(direct)
    for state, offers in ((_USER, direct), (_ASSISTANT, direct), (_START, best), (_SYSTEM, best)):
        # between _USER and _ASSISTANT a second insert only leads back, so there one is enough
        cost, _, audit = offers[_REQUIRED[state]]
        if (INSERT + cost, "I") < best[state][:2]:
            best[state] = (INSERT + cost, "I", ("I", audit))
    return Node(tuple(b[0] for b in best), tuple(b[2] for b in best))


_NEVER = 1 << 60
END = _with_inserts([(0, "", None), (_NEVER, "", None), (_NEVER, "", None), (0, "", None)])


def before(symbol: str, node: Node) -> Node:
    """The node of `symbol` followed by the suffix `node`."""
    direct = []
    extra = TRUNCATED if symbol.isupper() and symbol != _MUST_DELETE else 0
    for state in range(4):
        offers = [(DELETE + node.costs[state], "D", ("D", node.audits[state]))]
        if symbol != _MUST_DELETE:
            kept, to = _KEPT.get((symbol.lower(), state)), _REQUIRED[state]
            if kept is not None:
                offers.append((KEEP + extra + node.costs[kept], "K", ("K", node.audits[kept])))
            offers.append((REROLE + extra + node.costs[to], "R", ("R", node.audits[to])))
        direct.append(min(offers, key=lambda offer: offer[:2]))
    return _with_inserts(direct)


def _automaton(batches):
    """Rows of reversed signatures in order: the path of one is kept as far as the next one shares it."""
    path, last = [END], ""
    for batch in batches:
        costs, audits = [], []
        for backwards in batch.column("backwards").to_pylist():
            shared, most = 0, min(len(last), len(backwards))
            while shared < most and last[shared] == backwards[shared]:
                shared += 1
            del path[shared + 1:]
            for symbol in backwards[shared:]:
                path.append(before(symbol, path[-1]))
            costs.append(path[-1].costs[_START])
            audits.append(path[-1].audit())
            last = backwards
        yield pa.RecordBatch.from_arrays([batch.column("signature"), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                                         ["signature", "cost", "audit"])


def best_edits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of every distinct signature."""
    known = signatures.select("signature").distinct().withColumn("backwards", F.reverse("signature"))
    return (known.repartitionByRange("backwards").sortWithinPartitions("backwards")
            .mapInArrow(_automaton, "signature string, cost long, audit string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by crc32(conv_id:turn) % 20; a dropped row has 0 copies.

    A null role, text, or part of the hashed key counts as one space.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ENDS, "")).otherwise(shown("text"))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _signatures(batches):
    """Rows of whole conversations in order: one row a conversation, with its faults and its signature."""
    nothing = object()
    conversation = nothing
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature")

    def closed():
        gaps = last_turn - first_turn + 1 - turns if turns else 0
        return (conversation, gaps, *counts, illegal, "".join(symbols))

    kind = None
    for batch in batches:
        kind, done = batch.column("conv_id").type, []
        for own, turn, initial, symbol, copies in zip(*(batch.column(c).to_pylist() for c in
                                                        ("conv_id", "turn", "initial", "symbol", "copies"))):
            if own != conversation:
                if conversation is not nothing:
                    done.append(closed())
                conversation, counts, illegal, symbols = own, [0, 0, 0], 0, []
                turns, first_turn, last_turn, before_it = 0, None, None, None
            if not copies:
                continue
            if turn is not None and turn != last_turn:
                turns, last_turn = turns + 1, turn
                first_turn = turn if first_turn is None else first_turn
            illegal += before_it is not None and before_it + initial not in _LEGAL
            illegal += (copies - 1) * (initial + initial not in _LEGAL)
            before_it = initial
            if symbol == "blank":
                counts[0] += copies
                symbols.append(_MUST_DELETE * copies)
            else:
                again = copies - (symbol != "repeated")
                counts[1] += again
                if symbol != "repeated":
                    counts[2] += symbol.isupper()
                    symbols.append(symbol)
                symbols.append(_MUST_DELETE * again)
        if done:
            yield _batch(done, names, kind)
    if conversation is not nothing:
        yield _batch([closed()], names, kind)


def _batch(rows: list, names: tuple, kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, *[pa.int64()] * (len(names) - 2), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(names))


def _repaired(batches):
    """Rows of whole conversations in order, the audit first: the rows that its edits leave, then a closing row."""
    nothing = object()
    conversation, out, kind = nothing, [], None

    def say(role, text):
        nonlocal place
        digest.update((b"\n" if place else b"") + f"{role}:{text}".encode())
        out.append((conversation, place, role, text, None))
        place += 1

    def inserted():
        nonlocal at, state
        while audit[at:at + 1] == "I":
            at, state = at + 1, _REQUIRED[state]
            say(_ROLES[state], "")

    def close():
        inserted()
        out.append((conversation, place, None, None, digest.hexdigest()))

    def flush():
        columns = zip(*out)
        types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          ["conv_id", "place", "role", "text", "sha256"])
        out.clear()
        return made

    for batch in batches:
        kind = batch.column("conv_id").type
        for own, letters, role, text, copies in zip(*(batch.column(c).to_pylist() for c in
                                                      ("conv_id", "audit", "role", "text", "copies"))):
            if letters is not None:  # the first row of a conversation
                if conversation is not nothing:
                    close()
                conversation, audit, at, state, place, digest = own, letters, 0, _START, 0, hashlib.sha256()
                continue
            for _ in range(copies):
                inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = _KEPT[role[:1], state]
                    say(role, text)
                elif edit == "R":
                    state = _REQUIRED[state]
                    say(_ROLES[state], text)
        if out:
            yield flush()
    if conversation is not nothing:
        close()
        yield flush()


@dataclass(frozen=True)
class Repair:
    conversations: DataFrame  # conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    messages: DataFrame  # conv_id, place, role, text, and a closing row a conversation: role null, sha256 of all before it


def repair(spark: SparkSession, rows: DataFrame) -> Repair:
    """Find the cheapest edits of every conversation of `rows` (conv_id, turn, role, text, copies).

    Rows go by turn (nulls first), then role, then text; a row stands for `copies` adjacent equal ones,
    and equal rows count together.  Rows with 0 copies only say that the conversation exists: without
    others it has no faults, no cost and no messages.  A null conv_id is a conversation like any other.
    A role other than system, user and assistant goes by its first letter; one that starts otherwise, or is empty, can only be
    reroled or deleted.  Null roles and texts must have been replaced.

    Equal rows are counted before they are shuffled, and rows seen earlier are found by a join with the
    repeated ones, so neither needs a conversation in memory.  A conversation's signature, audit and
    digest are made by one task in one pass over its sorted rows, which hold a symbol a row.
    """
    reach(spark)
    kind = rows.schema["conv_id"].dataType.simpleString()
    merged = stage(spark, rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "dialogue-rows")
    present = merged.where("copies > 0").select("conv_id", "turn", F.md5(F.to_binary(F.concat_ws("\0", "role", "text"), F.lit("utf-8"))).alias("said"))
    repeated = (present.groupBy("conv_id", "said")
                .agg(F.count(F.lit(1)).alias("times"), F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("first"))
                .where("times > 1")
                .select(F.col("conv_id").alias("c"), F.col("said").alias("s"), F.when(~F.col("untimed"), F.col("first")).alias("first"),
                        F.lit(True).alias("again")))
    said = F.md5(F.to_binary(F.concat_ws("\0", "role", "text"), F.lit("utf-8")))
    body = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    marked = (merged.withColumn("said", said)
              .join(repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
              .withColumn("symbol", F.when(body == "", "blank")
                          .when(F.col("again") & ~F.col("turn").eqNullSafe(F.col("first")), "repeated")
                          .when(F.right(body, F.lit(1)).isin(*ENDS), plain).otherwise(F.upper(plain)))
              .withColumn("initial", initial))
    order = ("turn", "role", "text")
    faults = stage(spark, marked.repartition("conv_id").sortWithinPartitions("conv_id", *order)
                   .select("conv_id", "turn", "initial", "symbol", "copies")
                   .mapInArrow(_signatures, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, "
                                            "illegal long, signature string"), "dialogue-signatures")
    found = stage(spark, faults.join(best_edits(faults), "signature").drop("signature"), "dialogue-audits")
    lines = (found.select("conv_id", "audit").withColumns({"turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"),
                                                          "text": F.lit(None).cast("string"), "copies": F.lit(0).cast("long")})
             .unionByName(merged.where("copies > 0").withColumn("audit", F.lit(None).cast("string"))))
    messages = (lines.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *order)
                .select("conv_id", "audit", "role", "text", "copies")
                .mapInArrow(_repaired, f"conv_id {kind}, place long, role string, text string, sha256 string"))
    return Repair(found, messages)
