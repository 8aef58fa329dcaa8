"""Column-expression helpers shared by every operator (all JVM-side, no Python UDFs)."""

from functools import reduce

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """Boolean -> 0/1; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def member(column, values) -> Column:
    """Set membership that is false (never null) for a missing value."""
    values = list(values)
    if not values:
        return F.lit(False)
    return F.coalesce(F.col(column).isin(values) if isinstance(column, str)
                      else column.isin(values), F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """Inequality in which a missing value differs from everything, also from another one."""
    return F.coalesce(left != right, F.lit(True))


def truthy(column: Column) -> Column:
    """Read booleans and the texts true/false; anything else is false."""
    return F.coalesce(F.lower(column.cast("string")) == "true", F.lit(False))


def round_even(column: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: how array libraries round."""
    factor = float(10 ** digits)
    return F.rint(column * factor) / factor


def fixed2(column: Column, digits: int = 2) -> Column:
    """Text with a fixed number of decimals, rounded on the exact binary value, ties to even.

    The JVM formatter rounds the shortest decimal text half up instead, which differs when that
    text ends in a 5.  Splitting the number in two halves makes its distance to such a tie exact.
    """
    column = column.cast("double")
    scale = float(10 ** (digits + 1))
    shifted = column * 134217729.0
    high = shifted - (shifted - column)
    whole = F.rint(column * scale)
    excess = (high * scale - whole) + (column - high) * scale
    near_tie = (F.abs(F.pmod(whole, F.lit(10.0)) - 5.0) < 0.5) & (F.abs(excess) < 1e-3)
    down = F.floor(whole / 10.0)
    up = (excess > 0) | ((excess == 0) & (F.pmod(down, F.lit(2)) == 1))
    settled = (down + up.cast("int")) / float(10 ** digits)
    return F.format_string(f"%.{digits}f", F.when(near_tie, settled).otherwise(column))


def iso_timestamp(column: Column) -> Column:
    """ISO text; the fraction appears only when it is not zero."""
    whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(column, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def micros(column: Column) -> Column:
    """Event time as whole microseconds (session zone pinned to UTC)."""
    return F.unix_micros(column.cast("timestamp"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 when the denominator is 0 or missing."""
    return F.coalesce(numerator / F.nullif(denominator.cast("double"), F.lit(0.0)), F.lit(0.0))


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(part) for item in mapping.items() for part in item])


def lookup(column: Column, mapping: dict) -> Column:
    return reduce(lambda acc, item: acc.when(column == F.lit(item[0]), F.lit(item[1])),
                  list(mapping.items())[1:],
                  F.when(column == F.lit(next(iter(mapping))), F.lit(next(iter(mapping.values())))))


def json_text(fields: dict) -> Column:
    """Compact JSON with alphabetical keys; nulls are kept."""
    return F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]),
                     {"ignoreNullFields": "false"})


def joined_reasons(conditions, separator: str, fallback: str, limit: int | None = None) -> Column:
    """Join the texts whose condition holds, in order; a fallback when none does."""
    texts = F.array(*[F.when(condition, text) for condition, text in conditions])
    kept = F.array_compact(texts)
    if limit is not None:
        kept = F.slice(kept, 1, limit)
    return F.when(F.size(kept) == 0, F.lit(fallback)).otherwise(F.array_join(kept, separator))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[part.cast("string") for part in parts]), 256)


def surrogate_key(entity: str, natural_id: Column) -> Column:
    """Stable 60-bit integer key; null for a missing id."""
    hexed = F.substring(digest(F.lit(entity), natural_id), 1, 15)
    return F.when(natural_id.isNotNull(), F.conv(hexed, 16, 10).cast("bigint"))


def prefixed_digest(prefix: str, length: int, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.upper(F.substring(digest(*parts), 1, length)))
