"""Lookup joins: checked keys, first row per key, and salting of crowded keys."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import sweep


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """Keep the first row of every key in an explicit order.

    A min over a struct combines on the map side, so a key with many copies is reduced before it
    is shuffled (a ranking window would collect all copies in one task).
    """
    rest = [c for c in df.columns if c != key]
    leading = [c for c in order if c != key]
    picked = F.min(F.struct(*[F.col(c) for c in leading],
                            F.struct(*[F.col(c) for c in rest]).alias("_row"))).alias("_first")
    return df.groupBy(key).agg(picked).select(key, "_first._row.*").select(*df.columns)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """Raise when ``key`` repeats; call before a join that must not multiply rows."""
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"{name}.{key} is not unique; the join would multiply rows")
    return df


def crowded(df: DataFrame, key: str) -> DataFrame | None:
    """(key, parts) of the keys with more rows than one task should join, or None without any.

    They are at most as many as the table has times that number of rows.
    """
    rows = sweep.SEGMENT_ROWS
    if df.count() <= rows:
        return None
    found = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
             .where(F.col("_rows") > rows))
    return found.select(key, F.ceil(F.col("_rows") / rows).alias("_parts"))


def lookup(left: DataFrame, right: DataFrame, key: str, crowded_keys: DataFrame | None = None,
           spread: Column | None = None) -> DataFrame:
    """Left join to a table with unique ``key``.

    Rows of crowded keys are spread over as many tasks as they need; only those keys are repeated
    on the right.  They are few and broadcast; for other sides the optimizer decides by their size.
    """
    if crowded_keys is None:
        return left.join(right, key, "left")
    crowded_keys = F.broadcast(crowded_keys)
    parts = F.coalesce("_parts", F.lit(1))
    salt = F.pmod(F.xxhash64(spread if spread is not None else F.monotonically_increasing_id()), parts)
    salted = left.join(crowded_keys, key, "left").withColumn("_salt", salt).drop("_parts")
    repeated = (right.join(crowded_keys, key, "left")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("_parts"))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")
