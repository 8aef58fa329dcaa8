"""Operators that look at all documents together, against brute force."""

import zlib

import numpy as np
import pytest
import public_tokenizers as P
import xxhash
from tokenizers import Tokenizer

from ledgerlens.llm import hilbert, inducedsort, maxscore, simhash, suffixdedup, wavelet
from ledgerlens.workspace import fresh_folder

JSON = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("memory", [4, 64, 1 << 20])
def test_suffix_order_and_prefixes(memory, monkeypatch):
    monkeypatch.setattr(inducedsort, "BLOCK", 64)
    rng = np.random.default_rng(memory)
    for k in (1, 2, 5, 256):
        text = rng.integers(0, k, 150).astype(np.uint8)
        text = np.concatenate([text, text[:60], text[20:90], text])
        raw = text.tobytes()
        order = sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = [0]
        for a, b in zip(order, order[1:]):
            n = 0
            while n < 50 and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            shared.append(n)
        with inducedsort.Scratch(memory) as scratch:
            got = list(inducedsort.sorted_suffixes(scratch, text, 50))
        assert [int(x) for a, _ in got for x in a] == order
        assert [int(x) for _, b in got for x in b] == shared


def removed(rows, length):
    """Covered bytes by (doc_id, text): places of all windows in order of document and begin."""
    seen, out = {}, {}
    for d, t in rows:
        if d is None:
            continue
        b = t.encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            seen[w] = min(seen.get(w, (d, i)), (d, i))
    for d, t in rows:
        b = t.encode()
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and seen[b[i:i + length]] < (d, i):
                mask[i:i + length] = b"\1" * length
        out[d, t] = mask
    return out


@pytest.mark.parametrize("settings", [{}, {"memory": 64, "shard_bytes": 3000}, {"length": 40, "gram": 12}, {"busy": 1}])
def test_repeats_are_removed(spark, corpus, settings, monkeypatch):
    if settings.pop("busy", None):  # every anchor's windows are dealt over several shards
        monkeypatch.setattr(suffixdedup, "HOT_CHUNKS", 1)
    rows = [(r.doc_id, r.text or "") for r in corpus.collect()]
    want = removed(rows, settings.get("length", suffixdedup.LENGTH))
    got = suffixdedup.remove_repeats(spark, corpus, keep=("variant", "keep_0", "text"), **settings).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.keep_2 or ""
        mask = want[r.doc_id, text]
        assert bytes(r.kept) == bytes(c for c, m in zip(text.encode(), mask) if not m)
        assert len(r.spans) == len([x for x in bytes(mask).split(b"\0") if x])
        assert r.n_bytes == len(text.encode())


def test_different_texts_under_one_id(spark):
    long = "".join(f"{i:05d}" for i in range(60))
    rows = [(1, long), (1, "abc" + long), (2, long[30:230] + "tail"), (0, "short")]
    got = suffixdedup.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = removed(rows, 100)
    kept = sorted((r.doc_id, bytes(r.kept)) for r in got)
    assert kept == sorted((d, bytes(c for c, m in zip(t.encode(), want[d, t]) if not m)) for d, t in rows)


def test_equal_places_under_one_id(spark):
    long = "".join(f"{i * i % 99991:05d}" for i in range(60))
    rows = [(5, long + "one end"), (5, long + "another end"), (5, long), (5, long), (2, "head" + long[37:231] + "tail"), (7, long[9:])]
    got = suffixdedup.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = removed(rows, 100)
    assert all(any(want[d, t]) for d, t in rows if d != 2)
    assert sorted((r.doc_id, bytes(r.kept)) for r in got) == sorted(
        (d, bytes(c for c, m in zip(t.encode(), want[d, t]) if not m)) for d, t in rows)


@pytest.mark.parametrize("memory", [64, 1 << 20])
@pytest.mark.parametrize("cap", [255, 256, 700, 70_000])
def test_long_prefixes_are_carried(cap, memory):
    rng = np.random.default_rng(cap)
    text = rng.integers(0, 3, 400).astype(np.uint8)
    text = np.concatenate([text, text[50:], np.zeros(600, np.uint8), text])
    raw = text.tobytes()
    order = sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = [0] + [min(cap, next((n for n in range(len(raw)) if raw[a + n:a + n + 1] != raw[b + n:b + n + 1]))) for a, b in zip(order, order[1:])]
    with inducedsort.Scratch(memory) as scratch:
        got = list(inducedsort.sorted_suffixes(scratch, text, cap))
    assert [int(x) for a, _ in got for x in a] == order
    assert [int(x) for _, b in got for x in b] == shared


def test_long_repeats_inside_differing_chunks(spark):
    long = "".join(f"{i * i % 99991:05d}" for i in range(400))
    rows = [(0, "ahead " + long[300:1500] + " behind"), (1, long), (2, "x" + long[611:1100])]
    got = suffixdedup.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), length=400).collect()
    want = removed(rows, 400)
    assert any(want[1, long])
    assert sorted((r.doc_id, bytes(r.kept)) for r in got) == sorted(
        (d, bytes(c for c, m in zip(t.encode(), want[d, t]) if not m)) for d, t in rows)


def test_segments_of_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    letters = "".join(rng.choice(list("abcdefgh"), 3000))
    text = letters + letters[500:1500] + letters
    monkeypatch.setattr(suffixdedup, "SEGMENT", 700)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": [text], "doc_id": pa.array([1]), "variant": pa.array([0], pa.int32())})
    total = sum(sum(b.column("windows").to_pylist()) for b in suffixdedup._chunk_rows(100, 24)(iter([batch])))
    assert total == len(text) - 99


def fingerprint(text, words_in_shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - words_in_shingle + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + words_in_shingle]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def smallest(nodes, bits, budget):
    comp = dict(zip(range(len(nodes)), range(len(nodes))))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= budget:
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    groups = {}
    for i, n in enumerate(nodes):
        groups.setdefault(root(i), []).append(n)
    return [min(groups[root(i)]) for i in range(len(nodes))]


def test_near_duplicates_of_the_corpus(spark, corpus):
    got = simhash.near_duplicates(spark, corpus).collect()
    rows = [(r.doc_id, fingerprint(r.text)) for r in corpus.collect()]
    named = [r for r in rows if r[0] is not None]
    want = sorted(zip(*zip(*named), smallest(*zip(*named), 4)))
    assert sorted((r.doc_id, r.bits % 2**64, r.component_id) for r in got if r.doc_id is not None) == want
    assert [(r.bits % 2**64, r.component_id) for r in got if r.doc_id is None] == [(b, None) for d, b in rows if d is None]


@pytest.mark.parametrize("unit_rows", [8, 64, 4096])
def test_trie_join_finds_every_link(spark, unit_rows):
    rng = np.random.default_rng(unit_rows)
    centres = rng.integers(0, 2**64, 60, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centres for _ in range(8)]
    bits = sorted(set(near) | {0, 1, 2**64 - 1, 2**63})
    rows = [(i, b - 2**64 if b >= 2**63 else b) for i, b in enumerate(bits)]
    kept = spark.createDataFrame(rows, "node long, bits long")
    found = simhash.components(spark, simhash.links(spark, kept, 4, unit_rows), "test")
    got = {r.node: r.component for r in found.collect()}
    assert [got.get(i, i) for i in range(len(bits))] == smallest(list(range(len(bits))), bits, 4)


def test_a_long_chain_is_one_component(spark):
    rows = [(i, i + 1) for i in range(200)] + [(300, 301), (301, 300), (5, 5), (None, 7)]
    got = {r.node: r.component for r in simhash.components(spark, spark.createDataFrame(rows, "a long, b long"), "chain").collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}


def ids_of(texts):
    library = Tokenizer.from_file(JSON)
    return [np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in texts]


def test_wavelet_matrix_answers():
    values = np.random.default_rng(0).integers(0, 300, 5000)
    matrix = wavelet.open_shard(wavelet.pack_shard(wavelet.WaveletMatrix.build(values, 9)))
    assert (matrix.all() == values).all() and (matrix.access(np.arange(5000)) == values).all()
    for v in (0, 7, 299, 511, 600):
        places = np.flatnonzero(values == v)
        assert matrix.count(v) == len(places)
        assert (matrix.rank(v, np.arange(5001)) == np.concatenate([[0], np.cumsum(values == v)])).all()
        assert list(matrix.select(v, np.arange(len(places)))) == list(places)
    with pytest.raises(IndexError):
        matrix.select(7, [len(values)])


@pytest.mark.parametrize("shard_tokens", [500, 1 << 20])
def test_token_files_round_trip(spark, corpus, shard_tokens):
    folder = fresh_folder(spark, "test-files")
    wavelet.write(corpus, JSON, folder, shard_tokens=shard_tokens)
    rows = sorted(((r.doc_id, r.text) for r in corpus.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = ids_of([t for _, t in rows])
    starts = np.cumsum([0, *map(len, want)])
    got = sorted(wavelet.read(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got] == [
        (d, s, len(i), i.tobytes()) for (d, _), s, i in zip(rows, starts, want)]


def test_empty_inputs(spark, nothing):
    folder = fresh_folder(spark, "test-files")
    wavelet.write(nothing, JSON, folder)
    assert wavelet.read(spark, folder).count() == 0
    assert hilbert.pack(nothing, JSON).count() == 0
    assert simhash.near_duplicates(spark, nothing).count() == 0
    assert suffixdedup.remove_repeats(spark, nothing).count() == 0
    assert maxscore.top(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_curve_ranges_hold_equal_bytes(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, int(n))) for n in rng.pareto(1.2, 600) * 20 + 5]
    texts += ["one text, many copies of it, a third of all"] * 900  # one key, cut by doc_id
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    cuts = hilbert.range_cuts(docs, grain=64, range_bytes=8000)
    rows = hilbert.keyed(docs, cuts).collect()
    assert len(rows) == len(texts) and len(cuts[0]) >= 8
    ends = list(zip(*(c.tolist() for c in cuts)))
    assert all(r.part == sum(e <= (r.key, r.doc_id) for e in ends) for r in rows)
    size = np.bincount([r.part for r in rows], [len(r.text) for r in rows])
    assert size.max() <= 2 * size.mean() + max(map(len, texts))
    assert len({r.part for r in rows if r.doc_id >= 600}) > 1


@pytest.mark.parametrize("width, sizes", [(16, {}), (1024, {}), (64, {"grain": 16, "range_bytes": 2000})])
def test_every_id_is_packed_once(spark, corpus, width, sizes):
    got = hilbert.pack(corpus, JSON, width, **sizes).collect()
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    pieces = {}
    for r in got:
        assert len(r.ids) == 4 * r.length and r.length > 0
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    want = {}
    for (d, _), ids in zip(rows, ids_of([t for _, t in rows])):
        want.setdefault((d, len(ids)), []).extend((k, int(x)) for k, x in enumerate(ids))
    assert {k: sorted(v) for k, v in want.items()} == {
        k: sorted((start + i, int(x)) for start, ids in v for i, x in enumerate(np.frombuffer(ids, "<u4"))) for k, v in pieces.items()}
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n == width or n < width and n & (n - 1) == 0 for n in sequences.values())


def test_hilbert_curve_is_a_path():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = hilbert.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark, corpus):
    keys = {r.doc_id: r.key for r in hilbert.keyed(corpus, hilbert.range_cuts(corpus)).collect()}
    assert keys[0] == keys[7]


@pytest.mark.parametrize("shape", [(8192, 2048), (16, 3)])
def test_top_scores(spark, shape):
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 0.3, (230, 8)).astype(np.float32)
    vectors[60] = vectors[10]
    vectors[100] = 0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows[50] = (50, rows[50][1][:5])
    rows += [(7, rows[7][1]), (None, rows[1][1]), (300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (304, [])]
    got = maxscore.top(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_rows=shape[0], block_rows=shape[1])
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = np.pad(np.floor(256 * np.array(v, float)).astype(int), (0, 8 - len(v)))
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_crc_of_pieces_is_unsigned(spark, corpus):
    from pyspark.sql import functions as F
    row = hilbert.pack(corpus, JSON).withColumn("crc", F.crc32("ids")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))
