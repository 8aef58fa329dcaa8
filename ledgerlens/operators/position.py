"""Exact order statistics without a global sort.

A chronological split needs one cut point, not a row number on every row.  The k-th smallest value
of (time, id) is found by counting the rows between a few sampled pivots and going on inside the one
gap that holds it.  Quantiles of any number of columns come from counts of 16-bit digits, in four
passes.  Only counts travel; a split itself is then a plain filter with literals.
"""

import math
import struct
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

LIMIT = 500_000  # rows one task may sort
PIVOTS = 31  # rows drawn per pass; a pass leaves about one part in so many


def _sortable(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.StringType):
        return F.col(column)
    return F.col(column).cast("bigint")


def _gap(key: Column, pivots: list, first: int = 0) -> Column:
    """2 i for keys between pivots i - 1 and i, 2 i + 1 for keys equal to pivot i: a decision tree."""
    if not pivots:
        return F.lit(2 * first)
    m = len(pivots) // 2
    return (F.when(key < pivots[m], _gap(key, pivots[:m], first))
            .when(key == pivots[m], F.lit(2 * (first + m) + 1))
            .otherwise(_gap(key, pivots[m + 1:], first + m + 1)))


def kth(df: DataFrame, order: list, k: int, limit: int = LIMIT) -> tuple:
    """The k-th (1-based) smallest tuple of the ``order`` columns, exactly.

    Every pass draws pivots among the rows that are left, so it settles the answer or leaves fewer
    rows, however long texts are and however many rows are equal.  The draw affects only the number
    of passes.
    """
    keys = df.select(*[_sortable(df, c).alias(f"o{i}") for i, c in enumerate(order)])
    kinds = [f.dataType for f in keys.schema.fields]
    key = F.struct(*keys.columns)

    def literal(values):
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(values, kinds, keys.columns)])

    left = keys
    while True:
        pivots = sorted({tuple(r) for r in left.orderBy(F.rand(7)).limit(PIVOTS).collect()})
        known = [literal(p) for p in pivots]
        counts = dict(left.groupBy(_gap(key, known).alias("g")).count().collect())
        for gap in sorted(counts):  # at most one per pivot and one per gap
            if k <= counts[gap]:
                break
            k -= counts[gap]
        else:
            raise ValueError("fewer rows than the rank asked for")
        if gap % 2:
            return pivots[gap // 2]
        i = gap // 2
        if i > 0:
            left = left.where(key > known[i - 1])
        if i < len(known):
            left = left.where(key < known[i])
        if counts[gap] <= limit:
            return tuple(left.orderBy(*keys.columns).limit(k).select(F.max(key).alias("m")).first()["m"])


def at_most(df: DataFrame, order: list, cut: tuple) -> Column:
    """Rows up to and including the cut point, as literals the scan can use."""
    condition = F.lit(False)
    for i in reversed(range(len(order))):
        kind = df.schema[order[i]].dataType
        value = F.lit(cut[i])
        if isinstance(kind, T.TimestampNTZType):
            value = F.timestamp_micros(value).cast("timestamp_ntz")
        elif isinstance(kind, T.TimestampType):
            value = F.timestamp_micros(value)
        here = F.col(order[i])
        last = i == len(order) - 1
        condition = (here <= value) if last else (here < value) | ((here == value) & condition)
    return condition


def split(df: DataFrame, order: list, first_rows: int, limit: int = LIMIT) -> Column:
    """Condition that is true for exactly the first ``first_rows`` rows in ``order``.

    The last ``order`` column must identify a row.
    """
    if first_rows <= 0:
        return F.lit(False)
    return at_most(df, order, kth(df, order, first_rows, limit))


def chronological_split(df: DataFrame, time: str, row_id: str, test_fraction: float,
                        limit: int = LIMIT, target: str | None = None) -> tuple:
    """(train, test): the earlier ``int(n * (1 - test_fraction))`` rows and the rest.

    A row without time or id has no place and is an error; with ``target``, both sides must hold a
    positive row.
    """
    if not 0 < test_fraction < 1:
        raise ValueError("test_fraction must be between 0 and 1")
    n = _placed(df, [time, row_id])
    if n < 10:
        raise ValueError("at least 10 rows are required for a chronological split")
    train_rows = int(n * (1 - test_fraction))
    if not 0 < train_rows < n:
        raise ValueError("the split leaves one side empty")
    early = split(df, [time, row_id], train_rows, limit)
    if target is not None:
        hit = F.expr(f"try_cast({target} as double)") == 1
        sides = df.agg(F.count_if(hit & early).alias("train"),
                       F.count_if(hit & ~early).alias("test")).first()
        for side in ("train", "test"):
            if not sides[side]:
                raise ValueError(f"the {side} side of the split holds no positive row")
    return df.where(early), df.where(~early)


def _placed(df: DataFrame, order: list) -> int:
    """Number of rows; raises when one lacks an order column."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(
        reduce(lambda a, b: a | b, [F.col(c).isNull() for c in order])).alias("lost")).first()
    if row["lost"]:
        raise ValueError(f"{row['lost']} rows have no {' or '.join(order)} and cannot be ordered")
    return row["n"]


def halves(df: DataFrame, order: list, limit: int = LIMIT) -> DataFrame:
    """Add ``period``: baseline for the first n // 2 rows in ``order``, current for the rest."""
    n = _placed(df, order)
    if n < 2:
        raise ValueError("two non-empty periods need at least two rows")
    early = split(df, order, n // 2, limit)
    return df.withColumn("period", F.when(early, "baseline").otherwise("current"))


# -- exact quantiles ----------------------------------------------------------------------------


def _guess(size: Column) -> Column:
    return F.floor(F.log2(size))  # off by one near powers of two


def _scaled(size: Column, guess: Column) -> Column:
    return size * F.pow(F.lit(2.0), -guess)


def _bits(value: Column, size: Column, guess: Column, scaled: Column) -> Column:
    exponent = F.when(scaled < 1, guess - 1).when(scaled >= 2, guess + 1).otherwise(guess)
    digits = F.when(scaled < 1, scaled * 2).when(scaled >= 2, scaled / 2).otherwise(scaled)
    bits = (F.when(size == float("inf"), F.lit(0x7FF << 52))
            .when(size < 2.0**-1022, (size * 2.0**1022 * 2.0**52).cast("bigint"))
            .otherwise((exponent + 1023) * F.lit(1 << 52) + ((digits - 1) * 2.0**52).cast("bigint")))
    return F.when(~F.isnan(value), F.when(value < 0, -bits).otherwise(bits))


def _image(value: Column) -> Column:
    """The bits of a double as a long that sorts like it; null for missing values and NaN.

    Scaling by powers of two is exact, so the bits are those of the number itself; a negative number
    is the negated image of its opposite.
    """
    size = F.abs(value)
    return _bits(value, size, _guess(size), _scaled(size, _guess(size)))


def _images(cells: DataFrame) -> DataFrame:
    """(c, x): cells (c, v) with the image of their value; missing values and NaN are left out.

    The steps are columns of their own: in one expression each step is repeated, and worked out anew,
    wherever it is used.
    """
    v, size, guess = F.col("v"), F.col("size"), F.col("guess")
    steps = cells.where(v.isNotNull() & ~F.isnan(v)).withColumn("size", F.abs(v))
    steps = steps.withColumn("guess", _guess(size)).withColumn("scaled", _scaled(size, guess))
    return steps.select("c", _bits(v, size, guess, F.col("scaled")).alias("x"))


def _double(image: int) -> float:
    size = struct.unpack("<d", struct.pack("<q", abs(image)))[0]
    return -size if image < 0 else size


def _digit_pass(cells: DataFrame, asks: list, shift: int) -> list:
    """Where each asked rank lies among the 16-bit digits at ``shift`` below its known prefix.

    ``asks`` holds (column, prefix, item, fraction, up, rank); a missing rank follows from the
    fraction and the column's number of values.  One aggregate, whatever the number of ranks.
    """
    wanted = cells.sparkSession.createDataFrame(
        asks, "c int, prefix bigint, item int, q double, up boolean, k bigint")
    prefix = F.lit(0).cast("bigint") if shift == 48 else F.shiftright("x", shift + 16)
    cells = cells.withColumn("prefix", prefix)
    if shift < 48:  # a few rows per ask
        cells = cells.join(F.broadcast(wanted.select("c", "prefix").distinct()), ["c", "prefix"],
                           "left_semi")
    counts = cells.groupBy("c", "prefix", F.shiftright("x", shift).alias("digit")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    group = Window.partitionBy("c", "prefix")  # at most 65,536 digits
    placed = counts.withColumns({
        "total": F.sum("n").over(group),
        "before": F.sum("n").over(group.orderBy("digit").rowsBetween(
            Window.unboundedPreceding, 0)) - F.col("n")})
    at = F.col("q") * (F.col("total") - 1)
    rank = F.coalesce("k", F.when(F.col("up"), F.ceil(at)).otherwise(F.floor(at)) + 1)
    return (placed.join(F.broadcast(wanted), ["c", "prefix"]).withColumn("k", rank)
            .where("k > before AND k <= before + n").collect())


def quantiles(df: DataFrame, wanted: dict) -> dict:
    """Exact linear-interpolated quantiles of several columns: {column: [fractions]} -> values.

    Radix selection on the doubles' bits: four passes from the top 16 bits down count digits, for
    all columns and ranks together; a rank is settled as soon as its digit holds one value.  Missing
    values and NaN are ignored; a column without values gives None.
    """
    columns = list(wanted)
    numbers = F.array(*[F.col(c).cast("double") for c in columns])
    # a column of its own is compiled; what a generator works out itself is interpreted
    cells = _images(df.select(numbers.alias("_n")).select(F.posexplode_outer("_n").alias("c", "v")))
    asks = [(c, 0, i, float(q), up, None) for c, name in enumerate(columns)
            for i, q in enumerate(wanted[name]) for up in (False, True)]
    totals, values = {}, {}
    for shift in (48, 32, 16, 0):
        found = _digit_pass(cells, asks, shift) if asks else []
        asks = []
        for r in found:
            totals.setdefault(r["c"], r["total"])
            if r["low"] == r["high"]:
                values[r["c"], r["item"], r["up"]] = _double(r["low"])
            else:
                asks.append((r["c"], r["low"] >> shift, r["item"], r["q"], r["up"],
                             r["k"] - r["before"]))

    def at(c, i, q):
        if c not in totals:
            return None
        place, low, high = q * (totals[c] - 1), values[c, i, False], values[c, i, True]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {name: [at(c, i, q) for i, q in enumerate(wanted[name])]
            for c, name in enumerate(columns)}
