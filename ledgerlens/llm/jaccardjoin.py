"""Exact n-gram Jaccard join in metric space.

1 - |a & b| / |a | b| is a metric, so a pivot's distances bound those between other documents.

Who can be near to anyone at all: shingles are put in one order, rare ones first.  Two sets that are
near enough share at least SHARED shingles of their heads: their first few in that order, as many as
may differ and SHARED more.  Documents that share fewer with the rest are out before any set is moved.
Two heads also give a least distance of their sets, so whole sets move only where that allows a link.

Pivots: of all documents that share a shingle of their heads, the first is the pivot; each document
learns its distances to its pivots (or a least distance, where that rules a link out) and is linked
to those near enough.  Any two linked documents share a shingle and with it a pivot, so they meet in
that pivot's region.  There the triangle inequality says who is needed: two documents linked to one
pivot are connected already, and a document outside can only be linked to those whose distance to
the pivot is no more than the allowed one below its own.

A region too large for a task is cut again: pivots of its own create Voronoi regions, a document goes
to its nearest pivot, and as a guest to those that are at most twice the allowed distance further
away.  That repeats until regions are small; what no pivot divides is dealt in pairs of blocks.  Inside a task
regions are joined in the same way, down to a few documents that are compared by one matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, SpanHashes, mixed, ragged, reach, slices, stage
from .components import components
from .simhash import Forest

SHINGLE_WORDS = 3
PERCENT = 90  # of the union that two linked sets share
SHARED = 16
SAMPLE_SHARE = 0.125  # of the documents, whose shingles say which are frequent; that affects speed only
LISTED = 1 << 20  # frequent shingles known to every task, at most
REGION_SHINGLES = 2 << 20  # of the documents of a region that one task joins
PIVOTS = 16
_LEAF = 64
_COLUMNS = 1 << 16
_SLACK = 1e-9
_HASH = np.uint64((1 << 59) - 1)


def _least(n, percent: int):
    """Of a set of n shingles, how many any set linked to it must hold."""
    return -(-percent * n // 100)


def _shingles(texts: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Different 64-bit shingle hashes of all texts, ascending within a text, and where each text's begin."""
    split = [x.encode().lower().split() if x else [] for x in texts]  # A-Z only; blanks are \x20 and \x09-\x0D
    counts = np.fromiter(map(len, split), np.int64, len(split))
    data = np.frombuffer(b" ".join([w for words in split for w in words]), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(split) + 1, np.int64)
    gaps = np.flatnonzero(BLANKS[data])
    begin, end = np.append(0, gaps + 1), np.append(gaps, len(data))
    first = np.cumsum(counts) - counts
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    owner = np.repeat(np.arange(len(split)), shingles)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    hashes = SpanHashes(data).of(begin[at], end[at + np.minimum(counts[owner], width) - 1])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
    return hashes[new], np.searchsorted(owner[new], np.arange(len(split) + 1))


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def frequent(documents: DataFrame, width: int = SHINGLE_WORDS, share: float = SAMPLE_SHARE, most: int = LISTED) -> np.ndarray:
    """Order keys, by hash, of at most `most` shingles that occur more than once in a share of the documents.

    They rank behind all other shingles.  Any list gives the same results.
    """
    def hashes(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_shingles(batch.column("text").to_pylist(), width)[0].view(np.int64))], ["h"])

    some = _plain(documents).sample(share, 13).mapInArrow(hashes, "h long")
    found = (some.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(most)).toArrow()
    h = found.column("h").to_numpy().view(np.uint64)
    level = np.minimum(15, np.log2(np.maximum(found.column("n").to_numpy(), 1)).astype(np.uint64))
    low, first = np.unique(h >> np.uint64(5), return_index=True)
    return low | (level[first] << np.uint64(59))


def _ordered(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Shingles as keys of 59 bits of hash below 4 bits of frequency: their order is that of the join."""
    low = hashes >> np.uint64(5)
    if not len(listed):
        return low
    at = np.minimum(np.searchsorted(listed & _HASH, low), len(listed) - 1)
    return np.where(listed[at] & _HASH == low, listed[at], low)


def _sets(listed: np.ndarray, width: int, percent: int, shared: int, whole: bool):
    """Map texts to sets: class hashes that equal sets share, sizes, and the first keys or all of them."""
    def rows(batches):
        for batch in slices(batches):
            hashes, starts = _shingles(batch.column("text").to_pylist(), width)
            n = np.diff(starts)
            owner = np.repeat(np.arange(len(n)), n)
            keys = _ordered(hashes, listed)
            order = np.lexsort((keys, owner))
            keys = keys[order]
            one, two = (np.diff(np.append(np.uint64(0), np.cumsum(mixed(h)))[starts])  # wraps around: equal sets, equal sums
                        for h in (hashes, hashes ^ np.uint64(0x5851F42D4C957F2D)))
            if not whole:
                size = np.minimum(n, n - _least(n, percent) + np.minimum(shared, _least(n, percent)))
                place = np.arange(len(keys)) - np.repeat(starts[:-1], n)
                keys = keys[place < np.repeat(size, n)]
                starts = np.append(0, np.cumsum(size))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists],
                ["doc_id", "n", "one", "two", "keys"])

    return rows


_SCHEMA = "doc_id long, n long, one long, two long, keys array<long>"


def _distance(common: Column, n: Column, m: Column) -> Column:
    return 1 - common / (n + m - common)


def _linked(common: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * common >= percent * (n + m - common)


# -- inside a task ------------------------------------------------------------------------------


class _Members:
    """Documents of one unit: their sets, or the heads of them, laid end to end; `n` is the size of the set."""

    def __init__(self, keys: pa.ListArray, n: np.ndarray, core: np.ndarray, home: np.ndarray, half: np.ndarray):
        self.n, self.core, self.home, self.half = n, core, home, half
        self.held = keys.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys = keys.flatten().to_numpy(zero_copy_only=False)
        self.ends = np.cumsum(self.held)
        self.starts = self.ends - self.held

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        held = self.held[which]
        return self.keys[ragged(self.starts[which], held)], np.repeat(np.arange(len(which)), held)


def _common(members: _Members, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of members a (rows) and b (columns), by products of incidence matrices."""
    (ka, oa), (kb, ob) = members.of(a), members.of(b)
    shared = np.intersect1d(ka, kb)
    out = np.zeros((len(a), len(b)), np.int64)
    if not len(shared):
        return out
    sides = []
    for keys, owner in ((ka, oa), (kb, ob)):
        column = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        good = shared[column] == keys
        sides.append((column[good], owner[good]))
    for at in range(0, len(shared), _COLUMNS):
        matrices = []
        for (column, owner), rows in zip(sides, (len(a), len(b))):
            good = (column >= at) & (column < at + _COLUMNS)
            matrix = np.zeros((rows, min(_COLUMNS, len(shared) - at)), np.float32)
            matrix[owner[good], column[good] - at] = 1
            matrices.append(matrix)
        out += np.rint(matrices[0] @ matrices[1].T).astype(np.int64)
    return out


def _pairs(members: _Members, a: np.ndarray, b: np.ndarray, home: np.ndarray, percent: int, forest: Forest | None = None):
    """Blocks of members a and b with the pairs to look at: near enough in size and not connected already."""
    a, b = (x[np.argsort(members.n[x], kind="stable")] for x in (a, b))
    for i in range(0, len(a), _LEAF):
        one = a[i:i + _LEAF]
        low, high = members.n[one[0]], members.n[one[-1]]
        near = b[(100 * members.n[b] >= percent * low) & (100 * high >= percent * members.n[b])]
        for j in range(0, len(near), _LEAF):
            other = near[j:j + _LEAF]
            if forest is None:
                open_ = one[:, None] != other[None, :]
            else:
                roots = forest.roots(np.append(one, other))
                open_ = roots[:len(one), None] != roots[None, len(one):]
            open_ &= (members.core[one][:, None] < 0) | (members.core[one][:, None] != members.core[other][None, :])
            open_ &= home[one][:, None] | home[other][None, :]
            open_ &= (members.half[one][:, None] < 0) | (members.half[one][:, None] != members.half[other][None, :])
            rows, columns = open_.any(axis=1), open_.any(axis=0)
            if rows.any():
                yield one[rows], other[columns], open_[np.ix_(rows, columns)]


def _compare(members: _Members, a: np.ndarray, b: np.ndarray, home: np.ndarray, percent: int, forest: Forest) -> None:
    """Link members a with members b, whole sets at hand."""
    for one, other, open_ in _pairs(members, a, b, home, percent, forest):
        common = _common(members, one, other)
        union = members.n[one][:, None] + members.n[other][None, :] - common
        x, y = np.nonzero((100 * common >= percent * union) & open_)
        forest.link(one[x], other[y])


def _join(members: _Members, which: np.ndarray, home: np.ndarray, percent: int, forest: Forest) -> None:
    """Link the members `which` of a region; pairs of guests (not home) meet elsewhere."""
    todo = [(which, home)]
    while todo:
        which, home = todo.pop()
        if len(which) <= 2 * _LEAF:
            _compare(members, which, which, home, percent, forest)
            continue
        pivots = which[np.linspace(0, len(which) - 1, PIVOTS).astype(np.int64)]
        common = np.concatenate([_common(members, which[i:i + _LEAF], pivots) for i in range(0, len(which), _LEAF)])
        union = members.n[which][:, None] + members.n[pivots][None, :] - common
        far = 1 - common / np.maximum(union, 1)
        x, y = np.nonzero(100 * common >= percent * union)
        forest.link(which[x], pivots[y])
        nearest = far.argmin(axis=1)
        window = far <= far.min(axis=1)[:, None] + 2 * (1 - percent / 100) + _SLACK
        parts = [np.flatnonzero(window[:, p] & (((nearest == p) & home[which]).any())) for p in range(PIVOTS)]
        for p, part in enumerate(parts):
            if not len(part):
                continue
            own = np.zeros(len(home), bool)
            own[which[part]] = (nearest[part] == p) & home[which[part]]
            if 10 * len(part) > 9 * len(which):
                _compare(members, which[part], which[part], own, percent, forest)
            else:
                todo.append((which[part], own))


def _each(table: pa.Table):
    """The units of a bucket: unit, nodes, members."""
    table = table.sort_by([("unit", "ascending"), ("node", "ascending")]).combine_chunks()
    unit = table.column("unit").to_numpy()
    edges = np.append(np.flatnonzero(np.append(True, unit[1:] != unit[:-1])), len(unit))
    for low, high in zip(edges[:-1], edges[1:]):
        part = table.slice(low, high - low)
        core = np.unique(part.column("core").fill_null(0).to_numpy(), return_inverse=True)[1]
        members = _Members(part.column("keys").combine_chunks(), part.column("n").to_numpy(),
                           np.where(part.column("core").is_null().to_numpy(), -1, core),
                           part.column("home").to_numpy(), part.column("half").to_numpy())
        yield unit[low], part.column("node").to_numpy(), members


def _units(percent: int):
    """Join every unit of a bucket; links form a spanning forest of each."""
    def links(table: pa.Table) -> pa.Table:
        out = [pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})]
        for _, nodes, members in _each(table):
            forest = Forest(len(nodes))
            _join(members, np.arange(len(nodes)), members.home, percent, forest)
            root = forest.roots(np.arange(len(nodes)))
            linked = root != np.arange(len(nodes))
            out.append(pa.table({"a": nodes[linked], "b": nodes[root[linked]]}))
        return pa.concat_tables(out)

    return links


def _hopeful(percent: int):
    """Of every unit the members whose heads allow a link to another one that they aren't connected with."""
    def rows(table: pa.Table) -> pa.Table:
        out = [pa.table({"origin": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})]
        origins = dict(zip(table.column("unit").to_pylist(), table.column("origin").to_pylist()))
        for unit, nodes, members in _each(table):
            hope = np.zeros(len(nodes), bool)
            last = members.keys[members.ends - 1]
            for one, other, open_ in _pairs(members, np.arange(len(nodes)), np.arange(len(nodes)), members.home, percent):
                common = _common(members, one, other)
                # shingles up to the end of the shorter head are all known; of those beyond, all may be equal
                known = [np.stack([np.searchsorted(members.of(x[k:k + 1])[0], np.minimum(last[x[k]], last[y]), side="right")
                                   for k in range(len(x))]) for x, y in ((one, other), (other, one))]
                most = common + np.minimum(members.n[one][:, None] - known[0], members.n[other][None, :] - known[1].T)
                union = members.n[one][:, None] + members.n[other][None, :] - most
                x, y = np.nonzero((100 * most >= percent * union) & open_)
                hope[one[x]] = True
                hope[other[y]] = True
            out.append(pa.table({"origin": np.full(int(hope.sum()), origins[unit]), "node": nodes[hope]}))
        return pa.concat_tables(out)

    return rows


# -- across tasks -------------------------------------------------------------------------------


def _cut(spark: SparkSession, large: DataFrame, level: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Voronoi regions of regions too large for a task, and the links to their pivots."""
    own = Window.partitionBy("unit").orderBy(F.xxhash64("node", F.lit(level)), "node")
    pivots = (large.withColumn("place", F.row_number().over(own)).where(F.col("place") <= PIVOTS)
              .groupBy("unit").agg(F.collect_list(F.struct("node", "n", "keys")).alias("pivots")))
    common = F.transform("pivots", lambda p: F.size(F.array_intersect("keys", p["keys"])))
    met = (large.join(pivots, "unit").withColumn("common", common)
           .withColumn("pivots", F.transform("pivots", lambda p: F.struct(p["node"].alias("node"), p["n"].alias("n")))))
    far = F.zip_with("pivots", "common", lambda p, c: F.struct(
        (1 - c / (F.col("n") + p["n"] - c)).alias("far"), p["node"].alias("pivot"),
        (100 * c >= percent * (F.col("n") + p["n"] - c)).alias("linked")))
    met = stage(spark, met.withColumn("far", F.array_sort(far)).drop("pivots", "common"), f"jaccard-cut-{level}")
    nearest = F.col("far")[0]
    window = F.filter("far", lambda p: p["far"] <= nearest["far"] + 2 * (1 - percent / 100) + _SLACK)
    parts = (met.withColumn("p", F.explode(window))
             .select(F.xxhash64("unit", F.col("p.pivot"), F.lit(level)).alias("child"), F.col("unit").alias("parent"), "node", "n",
                     F.when(F.col("p.linked"), F.col("p.pivot")).otherwise(F.col("core")).alias("core"),
                     (F.col("home") & (F.col("p.pivot") == nearest["pivot"])).alias("home"), "half", "keys"))
    links = (met.select("node", F.explode(F.filter("far", lambda p: p["linked"])).alias("p"))
             .select(F.col("node").alias("a"), F.col("p.pivot").alias("b")))
    return parts, links


def _blocks(members: DataFrame, region_shingles: int, *keep: str) -> DataFrame:
    """Units of what no pivot divides: all members of two blocks meet in one unit, those of one block in another."""
    blocks = F.ceil(F.col("size") * 2 / region_shingles)
    dealt = (members.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))))
    one, two = F.least("block", "other"), F.greatest("block", "other")
    half = F.when(one == two, F.lit(-1).cast("long")).otherwise(F.col("block"))
    return dealt.select(F.xxhash64("unit", one, two, F.lit(-1)).alias("unit"), "node", "n", "core", "home", half.alias("half"), "keys", *keep)


def _region_links(spark: SparkSession, members: DataFrame, percent: int, region_shingles: int) -> DataFrame:
    """Links within regions: `members` has unit, node, n, core, home, half and keys."""
    found, small, level = [], [], 0
    large = members
    while True:
        sizes = stage(spark, large.groupBy("unit").agg(F.sum("n").alias("size")), f"jaccard-sizes-{level}")
        small.append(large.join(sizes.where(F.col("size") <= region_shingles), "unit", "left_semi"))
        over = sizes.where(F.col("size") > region_shingles)
        if not over.limit(1).count():
            break
        parts, links = _cut(spark, large.join(over, "unit", "left_semi"), level, percent)
        found.append(links)
        parts = stage(spark, parts, f"jaccard-parts-{level}")
        child = parts.groupBy("child", "parent").agg(F.sum("n").alias("part"), F.count_if("home").alias("homes")).where("homes > 0")
        tried = (child.groupBy("parent").agg(F.max("part").alias("largest"), F.sum("part").alias("total"))
                 .join(over.select(F.col("unit").alias("parent"), "size"), "parent"))
        divided = stage(spark, tried.select("parent", "size", ((10 * F.col("largest") <= 9 * F.col("size"))
                                                              & (F.col("total") <= 2 * F.col("size"))).alias("divided")),
                        f"jaccard-divided-{level}")
        undivided = divided.where("NOT divided").select(F.col("parent").alias("unit"), "size")
        small.append(_blocks(large.join(undivided, "unit"), region_shingles))
        large = (parts.join(divided.where("divided").select("parent"), "parent", "left_semi")
                 .join(child.select("child"), "child", "left_semi").drop("parent").withColumnRenamed("child", "unit"))
        level += 1
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    rows = stage(spark, rows.select("unit", "node", "n", "core", "home", "half", "keys"), "jaccard-units")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-total // region_shingles))
    links = (rows.withColumn("bucket", F.pmod(F.xxhash64("unit", F.lit(7)), F.lit(buckets))).groupBy("bucket")
             .applyInArrow(_units(percent), "a long, b long"))
    for more in found:
        links = links.unionByName(more)
    return links


def _whole_sets(spark: SparkSession, documents: DataFrame, chosen: DataFrame, made) -> DataFrame:
    """(node, n, keys): the whole sets of some classes, made from their texts again."""
    texts = _plain(documents).join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    whole = ["doc_id", "n", "one", "two"]
    sets = texts.mapInArrow(made, _SCHEMA).join(chosen.select("node", *whole), whole).select("node", "n", "keys")
    sets = stage(spark, sets, "jaccard-sets")
    if sets.groupBy("node").count().where("count > 1").limit(1).count():  # repeated rows
        sets = stage(spark, sets.dropDuplicates(["node"]), "jaccard-sets-once")
    return sets


def _cells(hits: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, cell): a document's shared shingles, with its own class of size and the next one.

    Sets near enough are in one class of size or in neighbouring ones, so they share a cell.
    """
    band = F.floor(F.log("n") / float(np.log(100 / percent)) + _SLACK).cast("int")
    return hits.withColumn("cell", F.explode(F.array(band, band + 1)))


def links(spark: SparkSession, documents: DataFrame, reps: DataFrame, listed: np.ndarray, width: int = SHINGLE_WORDS,
          percent: int = PERCENT, shared: int = SHARED, region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """Links (a, b) between nodes that connect all sets near enough; `reps` has node, doc_id, n, one, two and keys (heads)."""
    times = F.count(F.lit(1)).alias("times")
    entries = reps.select("node", "n", F.explode("keys").alias("key"))
    known = entries.groupBy("key").agg(times).where("times > 1").select("key")
    hits = stage(spark, entries.join(known, "key"), "jaccard-hits")
    least = F.least(F.lit(shared), F.ceil(F.lit(percent) * F.ceil(F.lit(percent) * F.col("n") / 100) / 100))
    enough = hits.groupBy("node", "n").agg(times).where(F.col("times") >= least).select("node")
    cells = _cells(hits.join(enough, "node", "left_semi"), percent)
    met = stage(spark, cells.join(cells.groupBy("key", "cell").agg(times).where("times > 1").drop("times"), ["key", "cell"]), "jaccard-cells")
    alive = stage(spark, met.select("key", "node", "n").distinct().groupBy("node", "n").agg(times).where(F.col("times") >= least)
                  .select("node"), "jaccard-alive")
    cells = met.join(alive, "node", "left_semi")
    first = F.min(F.struct("node", F.col("n").alias("m"))).alias("first")
    pivots = (cells.groupBy("key", "cell").agg(first, times).where("times > 1")
              .select("key", "cell", F.col("first.node").alias("pivot"), F.col("first.m").alias("m")))
    stars = stage(spark, cells.join(pivots, ["key", "cell"]).where("node <> pivot").select("node", "n", "pivot", "m").distinct(), "jaccard-stars")

    # Least distances to the pivots, from sizes and heads.
    chosen = stage(spark, reps.join(alive, "node", "left_semi"), "jaccard-heads")
    heads = chosen.select("node", "keys")
    shorter, longer = F.least("n", "m"), F.greatest("n", "m")
    alike = 100 * shorter >= percent * longer
    led = stars.where(alike).select(F.col("pivot").alias("node")).distinct()
    right = heads.join(led, "node", "left_semi").select(F.col("node").alias("pivot"), F.col("keys").alias("other"))
    end = F.least(F.element_at("keys", -1), F.element_at("other", -1))
    most = F.size(F.array_intersect("keys", "other")) + F.least(
        F.col("n") - F.size(F.filter("keys", lambda k: k <= end)), F.col("m") - F.size(F.filter("other", lambda k: k <= end)))
    met = (stars.where(alike).join(heads, "node").join(right, "pivot").withColumn("most", most.cast("long"))
           .select("pivot", "node", "n", "m", _distance(F.col("most"), F.col("n"), F.col("m")).alias("far"),
                   _linked(F.col("most"), F.col("n"), F.col("m"), percent).alias("near")))
    met = stage(spark, met.unionByName(stars.where(~alike).select(
        "pivot", "node", "n", "m", (1 - shorter / longer).alias("far"), F.lit(False).alias("near"))), "jaccard-met")

    # Distances, from whole sets.
    sets = _whole_sets(spark, documents, chosen, _sets(listed, width, percent, shared, True))
    near = met.where("near").select("pivot", "m", "node", "n")
    led = near.select(F.col("pivot").alias("node")).distinct()
    right = sets.join(led, "node", "left_semi").select(F.col("node").alias("pivot"), F.col("keys").alias("other"))
    common = F.size(F.array_intersect("keys", "other")).cast("long")
    measured = (near.join(sets.drop("n"), "node").join(right, "pivot").withColumn("common", common)
                .select("pivot", "node", "n", _distance(F.col("common"), F.col("n"), F.col("m")).alias("far"),
                        _linked(F.col("common"), F.col("n"), F.col("m"), percent).alias("linked")))
    measured = stage(spark, measured.unionByName(met.where("NOT near").select("pivot", "node", "n", "far", F.lit(False).alias("linked"))),
                     "jaccard-measured")
    direct = measured.where("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b"))

    # Regions: all outside, and those linked to the pivot that one outside may be near to.
    homes = measured.where("linked").groupBy("node").agg(F.min_by("pivot", F.struct("far", "pivot")).alias("core"))
    own = measured.where("linked").select(F.col("pivot").alias("node")).distinct().join(homes, "node", "left_anti")
    homes = homes.unionByName(own.withColumn("core", F.col("node")))
    outside = measured.where("NOT linked").groupBy("pivot").agg(F.min("far").alias("lo"), F.count(F.lit(1)).alias("outside"))
    needed = (measured.join(outside, "pivot").where(~F.col("linked") | (F.col("far") >= F.col("lo") - (1 - percent / 100) - _SLACK)))
    several = needed.groupBy("pivot").agg(times).where("times > 1").select("pivot")
    needed = (needed.join(several, "pivot", "left_semi").join(homes, "node", "left")
              .select(F.col("pivot").alias("unit"), "node", "n", "core", F.lit(True).alias("home"), F.lit(-1).cast("long").alias("half")))
    needed = stage(spark, needed, "jaccard-needed")
    members = needed.join(heads.withColumn("held", F.size("keys")), "node")
    sizes = needed.join(heads.select("node", F.size("keys").alias("held")), "node").groupBy("unit").agg(F.sum("held").alias("size"))
    sized = members.join(sizes, "unit").withColumn("origin", F.col("unit"))
    columns = ("origin", "unit", "node", "n", "core", "home", "half", "keys")
    fit = F.col("size") <= region_shingles
    dealt = stage(spark, sized.where(fit).select(*columns).unionByName(_blocks(sized.where(~fit), region_shingles, "origin").select(*columns)),
                  "jaccard-dealt")
    total = dealt.agg(F.sum(F.size("keys"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("unit", F.lit(7)), F.lit(max(8, -(-total // region_shingles))))
    hopeful = (dealt.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_hopeful(percent), "origin long, node long")
               .select(F.col("origin").alias("unit"), "node").distinct())
    hopeful = stage(spark, hopeful, "jaccard-hopeful")
    final = needed.join(hopeful, ["unit", "node"], "left_semi").join(sets.drop("n"), "node")
    return direct.unionByName(_region_links(spark, stage(spark, final, "jaccard-members"), percent, region_shingles))


def join(spark: SparkSession, documents: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT,
         shared: int = SHARED, region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Sets that share at least `percent` of 100 of their union are linked.  Texts without words, and
    null, have no shingles and link nothing; a text with fewer than `width` words has one.  Repeated
    rows come back as often as they came; different texts under one doc_id each belong to the
    component of what they are near to.  A row without doc_id gets its number of shingles and a null
    component_id, and links nothing.
    """
    reach(spark)
    listed = frequent(documents, width)
    prints = stage(spark, _plain(documents).mapInArrow(_sets(listed, width, percent, shared, False), _SCHEMA), "jaccard-prints")
    whole = ["n", "one", "two"]
    reps = (prints.where("n > 0 AND doc_id IS NOT NULL").groupBy(*whole)
            .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.any_value("keys").alias("keys")))
    reps = stage(spark, reps.withColumn("node", F.col("doc_id")), "jaccard-classes")
    if reps.groupBy("node").count().where("count > 1").limit(1).count():  # different texts under one doc_id
        reps = reps.withColumn("node", F.col("one"))
    found = components(spark, links(spark, documents, reps.drop("copies"), listed, width, percent, shared, region_shingles), "jaccard")
    grouped = reps.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    labelled = (grouped.join(smallest, "component").where("classes > 1 OR copies > 1").select(*whole, "component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return prints.join(labelled, whole, "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
