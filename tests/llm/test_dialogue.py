"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import dialogue, queries

BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    """The rows of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest(rows, faults):
    """(cost, audit, messages) by Dijkstra over (cost, audit), all edits tried everywhere."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, said = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, said
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for role in ("user", "assistant"):
            if role[0] in after:
                heapq.heappush(heap, (cost + 3, audit + "I", i, role[0], said + (f"{role}:",)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, said))
            if faults[i] in ("", "truncated"):
                extra = 3 if faults[i] else 0
                if role[:1] and role[0] in after:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[0], said + (f"{role}:{text}",)))
                for to in ("user", "assistant"):
                    if to[0] in after:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, to[0], said + (f"{to}:{text}",)))


def expected(conversation):
    rows = damage(conversation)
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, said = cheapest(rows, faults)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def found(spark, rows, schema="conv_id long, turn long, role string, text string"):
    made = dialogue.repair(spark, dialogue.damaged(spark.createDataFrame(rows, schema)))
    digests = {r.conv_id: r.sha256 for r in made.messages.where("role IS NULL").collect()}
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[r.conv_id])
            for r in made.conversations.collect()}


def grouped(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row[:4])
    return out


def test_random_conversations(spark):
    pick = random.Random(5)
    rows = []
    for conv in range(400):
        for turn in range(pick.randint(1, 9)):
            role = pick.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            rows.append((conv, pick.choice([turn] * 6 + [None, 3]), role,
                         pick.choice(["Yes.", "No!", "Why?", "so and", " \t", "", None, "Long answer. ", "é", "a:b\n."])))
    got = found(spark, rows)
    want = {conv: expected(part) for conv, part in grouped(rows).items()}
    assert got == want
    assert any("I" in w[6] for w in want.values()) and any("R" in w[6] for w in want.values())


def test_edges(spark, nothing):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, 2**62, "system", "x"), (2, -5, "user", "Go on!" * 50000)]
    rows += [(3, 1, "user", "same.")] * 5 + [(4, t, "user", "again.") for t in range(300)]
    rows += [(5, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(400)]
    got = found(spark, rows)
    assert got == {conv: expected(part) for conv, part in grouped(rows).items()}
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    assert found(spark, [(9, dropped, "user", "Gone.")]) == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, audit string, copies int")
    made = dialogue.repair(spark, dialogue.damaged(empty))
    assert made.conversations.count() == 0 and made.messages.count() == 0


def test_other_types_and_extra_columns(spark):
    rows = [("x", 1, "user", "Hi.", 7, "audit"), ("x", 2, "assistant", "Ho.", 7, "audit"), ("y", 1, "assistant", "so", 7, "audit")]
    got = found(spark, rows, "conv_id string, turn int, role string, text string, copies int, audit string")
    assert got == {conv: expected(part) for conv, part in grouped(rows).items()}


def test_suffixes_are_shared(spark):
    """A signature's node is built once however many signatures end in it."""
    made, before = [], dialogue.before

    def counting(symbol, node):
        made.append(symbol)
        return before(symbol, node)

    import pyarrow as pa
    signatures = sorted({a + b + "uaua" for a in "suax" for b in ("", "U", "D")}, key=lambda s: s[::-1])
    batch = pa.RecordBatch.from_pydict({"signature": signatures, "backwards": [s[::-1] for s in signatures]})
    try:
        dialogue.before = counting
        rows = [b.to_pylist() for b in dialogue._automaton([batch])][0]
    finally:
        dialogue.before = before
    assert len(made) == len({s[i:] for s in signatures for i in range(len(s))})
    assert len(rows) == len(signatures)


@pytest.mark.parametrize("table", ["sf0.001"])
def test_query(spark, table):
    folder = f"/root/testdata/{table}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in queries.op11_conversation_repair(spark, folder).collect()}
    assert got == {conv: expected(part) for conv, part in grouped(rows).items()}
    messages = dialogue.repair(spark, dialogue.damaged(spark.read.parquet(f"{folder}/conversations.parquet"))).messages
    said = (messages.where("role IS NOT NULL").groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("m")).collect())
    for row in said:
        text = "\n".join(f"{m.role}:{m.text}" for m in row.m)
        assert hashlib.sha256(text.encode()).hexdigest() == got[row.conv_id][7]
