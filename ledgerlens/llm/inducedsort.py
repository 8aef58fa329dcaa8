"""Suffix order with common prefixes by external induced sorting.

Only the suffixes that begin a descent-to-ascent turn of the text (the seeds) are ordered by
recursion; every other suffix follows from its right neighbour in two scans.  The scans run on
queues, one for each first byte, that hold tuples (position, common prefix with the tuple before) and
move to disk when `memory` tuples are held: since each queue is filled in order, the set of queues is
the priority queue of the scan.  Recursion on the seeds' names has too large an alphabet for that and
uses a heap with sorted runs on disk, unless the names fit in memory.

Common prefixes are carried up to `cap`, in as many bytes as it needs.  Two neighbours in a queue share one symbol more than the
least common prefix between the tuples that induced them.
"""

from __future__ import annotations

import bisect
import heapq
import os
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np

BLOCK = 1 << 16
MEMORY = 1 << 21
END_OF_CHUNK = 0xFF  # no UTF-8 text holds this byte


class Scratch:
    """A folder of the task, gone when the task ends, for arrays above `memory` items."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.folder = memory, tempfile.TemporaryDirectory(prefix="suffixes-")
        self.files = 0

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.folder.cleanup()

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder.name, str(self.files))

    def array(self, n: int, kind) -> np.ndarray:
        return np.empty(n, kind) if n <= self.memory else np.memmap(self.path(), kind, "w+", shape=(n,))


def blocks(n: int, size: int = 0) -> Iterator[slice]:
    size = size or BLOCK
    return (slice(a, min(n, a + size)) for a in range(0, n, size))


def _lexsorted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """By the columns but the last, which goes along."""
    order = np.lexsort(columns[-2::-1])
    return [c[order] for c in columns]


def external_sort(scratch: Scratch, parts: Iterable[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Rows of int64 columns in ascending order of all but the last, as consecutive pieces.

    Pieces that fill the memory are sorted and written as runs; then one range of the first column
    after another is read from all runs.  Equal first columns stay in one range.
    """
    runs, held, size = [], [], 0

    def close():
        nonlocal held, size
        rows = _lexsorted([np.concatenate(c) for c in zip(*held)])
        held, size = [], 0
        return rows

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= scratch.memory:
            rows = close()
            run = np.memmap(scratch.path(), np.int64, "w+", shape=(len(rows), len(rows[0])))
            for k, c in enumerate(rows):
                run[k] = c
            runs.append(run)
    last = close() if held else None
    if not runs:
        if last is not None:
            yield last
        return
    if last is not None:
        runs.append(np.stack(last))
    total = sum(r.shape[1] for r in runs)
    ranges = max(2, 4 * total // scratch.memory)
    some = np.sort(np.concatenate([r[0, ::max(1, r.shape[1] // (8 * ranges))] for r in runs]))
    pivots = np.unique(some[np.linspace(0, len(some) - 1, ranges + 1).astype(int)[1:-1]])
    at = [np.concatenate([[0], np.searchsorted(r[0], pivots), [r.shape[1]]]) for r in runs]
    for k in range(len(pivots) + 1):
        rows = [np.concatenate([r[c, a[k]:a[k + 1]] for r, a in zip(runs, at)]) for c in range(len(runs[0]))]
        if len(rows[0]):
            yield _lexsorted(rows)


class DiskHeap:
    """A priority queue of tuples; what memory cannot hold lies in sorted runs on disk."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.heap, self.runs = scratch, [], []

    def push(self, item: tuple[int, int, int]) -> None:
        heapq.heappush(self.heap, (*item, -1, 0))
        if len(self.heap) > self.scratch.memory:
            self.heap.sort()
            half = len(self.heap) // 2
            out = [x for x in self.heap[half:] if x[3] < 0]
            self.heap = self.heap[:half] + [x for x in self.heap[half:] if x[3] >= 0]
            if out:
                run = np.memmap(self.scratch.path(), np.int64, "w+", shape=(len(out), 3))
                run[:] = [x[:3] for x in out]
                self.runs.append(run)
                self._load(len(self.runs) - 1, 0)
            heapq.heapify(self.heap)

    def _load(self, run: int, k: int) -> None:
        if k < len(self.runs[run]):
            heapq.heappush(self.heap, (*map(int, self.runs[run][k]), run, k))

    def top(self) -> tuple | None:
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, int, int]:
        *item, run, k = heapq.heappop(self.heap)
        if run >= 0:
            self._load(run, k + 1)
        return tuple(item)


def seeds(scratch: Scratch, text: np.ndarray) -> np.ndarray:
    """Positions whose suffix is smaller than its right neighbour's, and its left one's is not."""
    n = len(text)
    found, rising = [], False  # the last suffix is larger than the end that follows
    kept = 0
    parts: list[np.ndarray] = []
    for part in reversed(list(blocks(n, max(BLOCK, 1 << 20)))):
        a, b = part.start, part.stop
        x = np.asarray(text[a:min(n, b + 1)]).astype(np.int64)
        if b == n:
            x = np.append(x, -1)
        step = np.sign(x[1:] - x[:-1])  # of positions a .. b - 1
        known = np.flatnonzero(step)
        up = np.empty(len(step), bool)
        up[:] = rising
        if len(known):
            nxt = np.searchsorted(known, np.arange(len(step)))
            has = nxt < len(known)
            up[has] = step[known[nxt[has]]] > 0
        after = np.append(up[1:], rising)
        # Position i + 1 is a seed if i falls and i + 1 rises.
        turn = np.flatnonzero(~up & after) + a + 1
        found.append(turn[turn < n])
        kept += len(found[-1])
        rising = bool(up[0]) if len(up) else rising
    out = scratch.array(kept, np.int64)
    at = 0
    for part in reversed(found):
        out[at:at + len(part)] = part
        at += len(part)
    return out


def names(scratch: Scratch, text: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, bool]:
    """For each seed the rank of its piece of text (up to the next seed, inclusive), and whether all differ.

    Several symbols make one sort key.  A piece that ends is padded with the largest value: where one
    piece continues another, the longer one falls at that place and is the smaller.
    """
    n, m = len(text), len(seed)
    largest = max((int(np.max(text[b])) for b in blocks(n, 1 << 20)), default=0)
    pad = largest + 2
    bits = pad.bit_length()
    per = max(1, 62 // bits)
    rank = scratch.array(m, np.int64)
    rank[:] = 0
    different, k = True, 0
    size = scratch.array(m, np.int64)
    for b in blocks(m, 1 << 20):
        ends = np.asarray(seed[b.start + 1:b.stop + 1])
        if b.stop == m:
            ends = np.append(ends, n)
        size[b] = ends - seed[b] + 1
    while True:
        ambiguous = False

        def parts():
            for b in blocks(m, 1 << 19):
                which = np.flatnonzero(size[b] >= k * per) + b.start if k else np.arange(b.start, b.stop)
                if not len(which):
                    continue
                at, length = seed[which] + k * per, size[which] - k * per
                key = np.zeros(len(which), np.int64)
                for j in range(per):
                    place = at + j
                    # The end of the text is smaller than every symbol.
                    symbol = np.where(place < n, text[np.minimum(place, n - 1)].astype(np.int64) + 1, 0)
                    symbol[j >= length] = pad
                    key = (key << bits) | symbol
                yield [np.asarray(rank[which]), key, which]

        done, last = 0, None
        more = False
        for r, key, which in external_sort(scratch, parts()):
            new = np.append(True, (r[1:] != r[:-1]) | (key[1:] != key[:-1]))
            group = np.append(True, r[1:] != r[:-1])
            if last is not None and last[0] == r[0]:
                group[0] = False
                if last[1] == key[0]:
                    new[0] = False
            index = np.arange(done, done + len(r))
            start_of_group = np.maximum.accumulate(np.where(group, index, last[2] if last is not None and not group[0] else -1))
            start_of_new = np.maximum.accumulate(np.where(new, index, last[3] if last is not None and not new[0] else -1))
            rank[which] = r + (start_of_new - start_of_group)
            ambiguous |= not new.all()
            more |= bool((size[which] >= (k + 1) * per).any())
            last = (r[-1], key[-1], start_of_group[-1], start_of_new[-1])
            done += len(r)
        k += 1
        if not more:
            break
    if m:
        different = _all_different(scratch, rank)
    return rank, different


def _all_different(scratch: Scratch, rank: np.ndarray) -> bool:
    seen = scratch.array(len(rank), np.uint8)
    seen[:] = 0
    for b in blocks(len(rank), 1 << 20):
        seen[rank[b]] = 1
    return all(bool(np.all(seen[b])) for b in blocks(len(rank), 1 << 20))


def _order_in_memory(text: np.ndarray) -> np.ndarray:
    """Suffix order by doubling the compared length; only places still tied are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    x = text[order]
    start = np.maximum.accumulate(np.where(np.append(True, x[1:] != x[:-1]), np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    width = 1
    tied = np.ones(n, bool)
    while True:
        first = np.append(True, start[1:] != start[:-1])
        alone = first & np.append(first[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            return order
        who = order[tied]
        beyond = who + width
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)], -1)
        again = np.lexsort((second, start[tied]))
        who, second, group = who[again], second[again], start[tied][again]
        order[tied] = who
        new = np.append(True, (group[1:] != group[:-1]) | (second[1:] != second[:-1]))
        start[tied] = np.maximum.accumulate(np.where(new, tied, 0))
        rank[who] = start[tied]
        width *= 2


def suffix_order(scratch: Scratch, text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a text of any integers."""
    n = len(text)
    if n <= max(2, scratch.memory):
        return _order_in_memory(np.asarray(text))
    seed = seeds(scratch, text)
    rank, different = names(scratch, text, seed)
    order = scratch.array(len(seed), np.int64)
    if different:
        for b in blocks(len(rank)):
            order[rank[b]] = np.arange(b.start, b.stop)
    elif len(seed):
        order = suffix_order(scratch, rank)
    # First scan, upwards: falling suffixes, after the end of the text and before the seeds.
    out = scratch.array(n, np.int64)
    falling, kept = scratch.array(n, np.int64), 0
    heap, number, k = DiskHeap(scratch), 1, 0
    heap.push((int(text[n - 1]), 0, n - 1))
    while True:
        top = heap.top()
        here = int(seed[order[k]]) if k < len(order) else None
        if top is None and here is None:
            break
        if here is None or top is not None and top[0] <= text[here]:
            here = heap.pop()[2]
            falling[kept] = here
            kept += 1
        else:
            k += 1
        if here and text[here - 1] >= text[here]:
            heap.push((int(text[here - 1]), number, here - 1))
            number += 1
    # Second scan, downwards: rising suffixes, before the falling ones of the same symbol.
    heap, number, k, at = DiskHeap(scratch), 0, kept - 1, n - 1
    while at >= 0:
        top = heap.top()
        rises = top is not None and (k < 0 or -top[0] >= text[falling[k]])
        if rises:
            here = heap.pop()[2]
        else:
            here, k = int(falling[k]), k - 1
        out[at] = here
        at -= 1
        if here and (text[here - 1] < text[here] or rises and text[here - 1] == text[here]):
            heap.push((-int(text[here - 1]), number, here - 1))
            number += 1
    return out


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes at a[i] and b[i], at most `cap`, eight bytes at a time."""
    n = len(text)
    out = np.zeros(len(a), np.int64)
    words = np.ndarray((n,), "<u8", buffer=np.append(text, np.zeros(8, np.uint8)), strides=(1,))
    left = np.flatnonzero((a < n) & (b < n))
    while len(left):
        x = words[np.minimum(a[left] + out[left], n - 1)] ^ words[np.minimum(b[left] + out[left], n - 1)]
        same = x == 0
        out[left[~same]] += np.bitwise_count((x[~same] & (~x[~same] + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        left = left[same]
        out[left] += 8
        left = left[(out[left] < cap) & (np.maximum(a[left], b[left]) + out[left] < n)]
    return np.minimum(np.minimum(out, n - np.maximum(a, b)), cap)


class Queues:
    """256 first-in-first-out queues of (position, common prefix), on disk above `memory` tuples."""

    def __init__(self, scratch: Scratch, kind: np.dtype):
        self.scratch, self.kind, self.held = scratch, kind, 0
        self.parts = [[] for _ in range(256)]  # arrays, or (file, offset) once written
        self.ends = [[] for _ in range(256)]  # tuples up to the end of each part

    def push(self, byte: int, at: np.ndarray, shared: np.ndarray) -> None:
        self.parts[byte].append((at, shared))
        self.ends[byte].append(self.count(byte) + len(at))
        self.held += len(at)
        if self.held > self.scratch.memory:
            self._spill()

    def _spill(self) -> None:
        path = self.scratch.path()
        with open(path, "wb") as f:
            for byte in range(256):
                parts, ends = self.parts[byte], self.ends[byte]
                k = next((k for k, p in enumerate(parts) if not isinstance(p[0], str)), len(parts))
                if k < len(parts):
                    at, shared = (np.concatenate(x) for x in zip(*parts[k:]))
                    parts[k:], ends[k:] = [(path, f.tell())], ends[-1:]
                    f.write(at.astype(np.int64).tobytes() + shared.astype(self.kind, copy=False).tobytes())
        self.held = 0

    def count(self, byte: int) -> int:
        return self.ends[byte][-1] if self.ends[byte] else 0

    def part(self, byte: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Tuples low .. high - 1 of a queue."""
        ends, got = self.ends[byte], []
        k = bisect.bisect_right(ends, low)
        while low < high:
            begin = ends[k - 1] if k else 0
            stop = min(high, ends[k])
            where, offset = self.parts[byte][k]
            if isinstance(where, str):
                with open(where, "rb") as f:
                    f.seek(offset + 8 * (low - begin))
                    at = np.frombuffer(f.read(8 * (stop - low)), np.int64)
                    wide = self.kind.itemsize
                    f.seek(offset + 8 * (ends[k] - begin) + wide * (low - begin))
                    got.append((at, np.frombuffer(f.read(wide * (stop - low)), self.kind)))
            else:
                got.append((where[low - begin:stop - begin], offset[low - begin:stop - begin]))
            low, k = stop, k + 1
        return got[0] if len(got) == 1 else tuple(np.concatenate(x) for x in zip(*got))


class _Scan:
    """One scan: takes tuples in order and pushes what they induce, with common prefixes."""

    def __init__(self, text: np.ndarray, into: Queues, cap: int, induces: Callable):
        self.text, self.into, self.cap, self.induces = text, into, cap, induces
        self.kind = into.kind
        self.most = np.iinfo(self.kind).max
        self.least = np.full(256, self.most, self.kind)  # least common prefix since the last push to each queue
        self.started = np.zeros(256, bool)

    def take(self, at: np.ndarray, shared: np.ndarray, rising: bool) -> None:
        for b in blocks(len(at)):
            self._block(at[b], shared[b], rising)

    def _block(self, at, shared, rising) -> None:
        ok = at > 0
        before = self.text[np.maximum(at - 1, 0)]
        ok &= self.induces(before, self.text[at], rising)
        pushed = np.flatnonzero(ok)
        if not len(pushed):
            np.minimum(self.least, shared.min(), out=self.least)
            return
        table = [shared]
        while 1 << len(table) <= len(shared):
            t, half = table[-1], 1 << (len(table) - 1)
            table.append(np.minimum(t[:-half], t[half:]))

        def least(low, high):
            """Least of shared[low..high], high not before low."""
            level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            out = np.empty(len(low), self.kind)
            for k in np.unique(level):
                i = level == k
                out[i] = np.minimum(table[k][low[i]], table[k][high[i] - (1 << int(k)) + 1])
            return out

        byte = before[pushed]
        order = np.argsort(byte, kind="stable")
        byte, place = byte[order], pushed[order]
        first = np.append(True, byte[1:] != byte[:-1])
        low = np.append(0, place[:-1] + 1)
        low[first] = 0
        got = least(low, place)
        heads = byte[first]
        got[first] = np.minimum(got[first], self.least[heads])
        value = np.minimum(got.astype(np.int64) + 1, self.cap).astype(self.kind)
        firsts = np.flatnonzero(first)
        value[firsts[~self.started[heads]]] = 0
        source = at[place] - 1
        ends = np.append(firsts[1:], len(byte))
        for c, a, e in zip(heads.tolist(), firsts.tolist(), ends.tolist()):
            self.into.push(c, source[a:e], value[a:e])
        self.started[heads] = True
        np.minimum(self.least, shared.min(), out=self.least)
        tail = place[ends - 1] + 1
        rest = np.full(len(heads), self.most, self.kind)
        inside = tail < len(shared)
        if inside.any():
            rest[inside] = least(tail[inside], np.full(int(inside.sum()), len(shared) - 1))
        self.least[heads] = rest


def _run(text: np.ndarray, at: int, cap: int) -> int:
    part = np.asarray(text[at:at + cap])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def sorted_suffixes(scratch: Scratch, text: np.ndarray, cap: int = 255) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (positions, common prefix with the suffix before) in suffix order of a text of bytes."""
    n = len(text)
    if not n:
        return
    kind = np.min_scalar_type(cap)
    seed = seeds(scratch, text)
    rank, different = names(scratch, text, seed)
    order = scratch.array(len(seed), np.int64)
    if different:
        for b in blocks(len(rank)):
            order[rank[b]] = np.arange(b.start, b.stop)
    elif len(seed):
        order = suffix_order(scratch, rank)
    # The seeds in order, with their common prefixes, in one queue for each first byte.
    ready = Queues(scratch, kind)
    before = -1
    for b in blocks(len(order), 1 << 18):
        at = seed[order[b]]
        left = np.append(before, at[:-1])
        shared = common(text, np.where(left < 0, n, left), at, cap).astype(kind)
        first = text[at]
        cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        for a, e in zip(cuts, np.append(cuts[1:], len(at))):
            ready.push(int(first[a]), at[a:e], shared[a:e])
        before = int(at[-1])
    falling = Queues(scratch, kind)
    scan = _Scan(text, falling, cap, lambda left, here, _: left >= here)
    falling.push(int(text[n - 1]), np.array([n - 1]), np.zeros(1, kind))  # induced by the end of the text
    scan.started[text[n - 1]] = True
    scan.least[:] = 0
    first_of = np.zeros(1, kind)
    for byte in range(256):
        done = 0
        while done < falling.count(byte):  # what it induces with the same byte comes at its own end
            high = min(falling.count(byte), done + BLOCK)
            at, shared = falling.part(byte, done, high)
            scan.take(at, shared if done else np.append(first_of, shared[1:]), False)
            done = high
        joint = _joint(text, falling, ready, byte, cap)
        for part in blocks(ready.count(byte)):
            at, shared = ready.part(byte, part.start, part.stop)
            scan.take(at, shared if part.start else np.append(kind.type(joint), shared[1:]), True)
    rising = Queues(scratch, kind)
    scan = _Scan(text, rising, cap, lambda left, here, up: (left < here) | ((left == here) & up))
    for byte in range(255, -1, -1):
        done = 0
        while done < rising.count(byte):
            high = min(rising.count(byte), done + BLOCK)
            at, shared = rising.part(byte, done, high)
            scan.take(at, shared if done else np.append(first_of, shared[1:]), True)
            done = high
        follows = _joint(text, falling, rising, byte, cap, last=True)
        for part in reversed(list(blocks(falling.count(byte)))):
            at, shared = falling.part(byte, part.start, part.stop)
            scan.take(at[::-1], np.append(kind.type(follows), shared[:0:-1]), False)
            follows = shared[0]
    for byte in range(256):
        for part in blocks(falling.count(byte)):
            at, shared = falling.part(byte, part.start, part.stop)
            yield at, shared if part.start else np.append(first_of, shared[1:])
        # Kept from the largest down: what a tuple shares with the one before it here lies with the next.
        follows = _joint(text, falling, rising, byte, cap, last=True)
        for part in reversed(list(blocks(rising.count(byte)))):
            at, shared = rising.part(byte, part.start, part.stop)
            yield at[::-1], np.append(kind.type(follows), shared[:0:-1])
            follows = shared[0]


def _joint(text: np.ndarray, falling: Queues, other: Queues, byte: int, cap: int, last: bool = False) -> int:
    """What the largest falling suffix of a byte shares with the smallest of the others: the shorter run."""
    n, m = falling.count(byte), other.count(byte)
    if not n or not m:
        return 0
    a = falling.part(byte, n - 1, n)[0][0]
    b = other.part(byte, m - 1, m)[0][0] if last else other.part(byte, 0, 1)[0][0]
    return min(_run(text, int(a), cap), _run(text, int(b), cap))
