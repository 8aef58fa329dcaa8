"""Data validation: every check is a row (name, dataset, status, severity, message, category)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schema as S

LISTED = 50  # unexpected values that a message lists; unexpected_table has all of them
CHECK = ("name string, dataset string, status string, severity string, message string, "
         "category string")


def _row(name, dataset, passed: Column, good, bad: Column, category, severity="critical"):
    return F.struct(
        F.lit(name).alias("name"), F.lit(dataset).alias("dataset"),
        F.when(passed, "passed").otherwise("failed").alias("status"),
        F.lit(severity).alias("severity"),
        F.when(passed, F.lit(good)).otherwise(bad).alias("message"),
        F.lit(category).alias("category"))


def _literal(spark, name, dataset, passed, message, category) -> DataFrame:
    return spark.createDataFrame(
        [(name, dataset, "passed" if passed else "failed", "critical", message, category)], CHECK)


def _text(values) -> Column:
    """A list rendered the way the messages quote lists."""
    return F.concat(F.lit("['"), F.array_join(values, "', '"), F.lit("']"))


def required_columns(dataset: str, df: DataFrame, required: list) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    message = f"Missing required columns: {missing}" if missing else \
        "All required columns are present."
    return _literal(df.sparkSession, "required_columns", dataset, not missing, message, "schema")


def null_counts(df: DataFrame, fields: list) -> DataFrame:
    """(field, nulls) for several fields in one scan."""
    row = df.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("nulls")) for f in fields])).alias("r")
    ).select("r.*")


def _exploded(row: DataFrame, checks: list) -> DataFrame:
    return row.select(F.explode(F.array(*checks)).alias("r")).select("r.*")


def _null_parts(dataset: str, df: DataFrame, fields: list):
    fields = [f for f in fields if f in df.columns]
    counts = [F.count_if(F.col(f).isNull()).alias(f"n_{f}") for f in fields]
    found = F.array_compact(F.array(*[
        F.when(F.col(f"n_{f}") > 0, F.concat(F.lit(f"'{f}': "), F.col(f"n_{f}").cast("string")))
        for f in fields]))
    bad = F.concat(F.lit("Null values found in key fields: {"), F.array_join(found, ", "),
                   F.lit("}"))
    return counts, [_row("key_field_nulls", dataset, F.size(found) == 0,
                         "No null values found in key fields.", bad, "completeness")]


def key_nulls(dataset: str, df: DataFrame, fields: list) -> DataFrame:
    counts, checks = _null_parts(dataset, df, fields)
    return _exploded(df.agg(*counts), checks)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of every key; missing keys count as one value.

    Counts combine on the map side; only distinct keys are shuffled.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_primary_key(dataset: str, df: DataFrame, key: str) -> DataFrame:
    if key not in df.columns:
        return _literal(df.sparkSession, "duplicate_primary_key", dataset, False,
                        f"Primary key column is missing: {key}", "uniqueness")
    n = F.col("duplicates")
    return duplicates(df, key).select(_row(
        "duplicate_primary_key", dataset, n == 0, "Primary key values are unique.",
        F.concat(F.lit("Found "), n.cast("string"), F.lit(" duplicate primary key values.")),
        "uniqueness").alias("r")).select("r.*")


def orphans(child: DataFrame, child_column: str, parent: DataFrame,
            parent_column: str) -> DataFrame:
    """Distinct non-null child values without a parent, compared as text."""
    values = (child.select(F.col(child_column).cast("string").alias("value"))
              .where("value is not null").distinct())
    known = (parent.select(F.col(parent_column).cast("string").alias("value"))
             .where("value is not null"))
    return values.join(known, "value", "left_anti")


# -- keys: uniqueness and references from one census ---------------------------------------------


def _held_keys(df: DataFrame, primary: list, child: list, parent: list) -> DataFrame:
    """(relation, key, child, parent) of one table's keys, in one scan.

    ``primary``, ``child`` and ``parent`` list (relation, column); keys compare as text.  A missing
    key is a value for uniqueness and no reference.
    """
    def entry(relation, column, is_child, always):
        key = F.col(column).cast("string")
        row = F.struct(F.lit(relation).alias("relation"), key.alias("key"),
                       F.lit(int(is_child)).cast("bigint").alias("child"),
                       F.lit(int(not is_child)).cast("bigint").alias("parent"))
        return row if always else F.when(key.isNotNull(), row)

    entries = [entry(r, c, False, True) for r, c in primary]
    entries += [entry(r, c, True, False) for r, c in child]
    entries += [entry(r, c, False, False) for r, c in parent]
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def key_census(tables: dict, primary: dict, foreign: list) -> DataFrame:
    """(relation, key, child, parent): how often each key occurs on each side, in one exchange.

    ``primary`` maps a table to its key; ``foreign`` lists (child, column, parent, column).  Counts
    combine on the map side, so a key with very many rows is one row per task in the exchange.
    """
    parts = []
    for name, df in tables.items():
        own = [(f"{name} key", primary[name])] if name in primary else []
        out = [(_reference(f), f[1]) for f in foreign if f[0] == name]
        into = [(_reference(f), f[3]) for f in foreign if f[2] == name]
        if own or out or into:
            parts.append(_held_keys(df, own, out, into))
    return union(parts).groupBy("relation", "key").agg(
        F.sum("child").alias("child"), F.sum("parent").alias("parent"))


def _reference(foreign: tuple) -> str:
    child, child_column, parent, parent_column = foreign
    return f"{child}.{child_column} to {parent}.{parent_column}"


def key_checks(tables: dict, primary: dict, foreign: list) -> DataFrame:
    """Uniqueness of all primary keys and orphans of all references, read off one census."""
    spark, rows, absent = next(iter(tables.values())).sparkSession, [], []
    kept, held = {}, []
    for name, key in primary.items():
        if key not in tables[name].columns:
            absent.append(_literal(spark, "duplicate_primary_key", name, False,
                                   f"Primary key column is missing: {key}", "uniqueness"))
            continue
        kept[name] = key
        rows.append((f"{name} key", "duplicate_primary_key", name, "uniqueness", "Primary key values are unique."))
    for reference in foreign:
        child, child_column, parent, parent_column = reference
        name = f"{child_column}_references_{parent}"
        if child_column not in tables[child].columns or parent_column not in tables[parent].columns:
            absent.append(_literal(spark, name, child, False, f"Cannot validate relationship; missing "
                                   f"{child_column} or {parent_column}.", "relationship"))
            continue
        held.append(reference)
        rows.append((_reference(reference), name, child, "relationship",
                     f"{child}.{child_column} values all exist in {parent}.{parent_column}."))
    if not rows:
        return union(absent)
    census = key_census(tables, kept, held)
    orphan = (F.col("child") > 0) & (F.col("parent") == 0)
    counts = census.groupBy("relation").agg(F.count_if(orphan).alias("orphans"),
                                            F.sum(F.col("parent") - 1).alias("again"))
    # Five examples are the feature; a ranking limit keeps five per task before the shuffle.
    place = F.row_number().over(Window.partitionBy("relation").orderBy("key"))
    examples = (census.where(orphan).withColumn("place", place).where(F.col("place") <= 5)
                .groupBy("relation").agg(F.sort_array(F.collect_list("key")).alias("examples")))
    asked = spark.createDataFrame(rows, "relation string, name string, dataset string, category string, good string")
    unique = F.col("category") == "uniqueness"
    n = F.coalesce(F.when(unique, F.col("again")).otherwise(F.col("orphans")), F.lit(0))
    bad = F.when(unique, F.concat(F.lit("Found "), n.cast("string"), F.lit(" duplicate primary key values."))).otherwise(
        F.concat(F.lit("Found "), n.cast("string"), F.lit(" invalid references. Examples: "), _text(F.col("examples"))))
    found = asked.join(counts, "relation", "left").join(examples, "relation", "left").select(
        "name", "dataset", F.when(n == 0, "passed").otherwise("failed").alias("status"),
        F.lit("critical").alias("severity"), F.when(n == 0, F.col("good")).otherwise(bad).alias("message"), "category")
    return union([found, *absent])


def duplicate_primary_key(dataset: str, df: DataFrame, key: str) -> DataFrame:
    return key_checks({dataset: df}, {dataset: key}, [])


def foreign_key(child_name, child, child_column, parent_name, parent, parent_column) -> DataFrame:
    return key_checks({child_name: child, parent_name: parent}, {},
                      [(child_name, child_column, parent_name, parent_column)])


def _amount_parts():
    value = F.expr("try_cast(amount as double)")
    counts = [F.count_if(value.isNull() | F.isnan(value) | (value <= 0)).alias("bad_amounts")]
    n = F.col("bad_amounts")
    return counts, [_row(
        "transaction_amount_positive", "transactions", n == 0,
        "All transaction amounts are numeric and positive.",
        F.concat(F.lit("Found "), n.cast("string"),
                 F.lit(" transactions with invalid amounts.")), "validity")]


def positive_amount(transactions: DataFrame) -> DataFrame:
    if "amount" not in transactions.columns:
        return _literal(transactions.sparkSession, "transaction_amount_positive", "transactions",
                        False, "Missing amount column.", "validity")
    counts, checks = _amount_parts()
    return _exploded(transactions.agg(*counts), checks)


def _time_parts(dataset: str, df: DataFrame, columns: list):
    present = [c for c in columns if c in df.columns]
    counts = [F.count_if(F.expr(f"try_to_timestamp(cast(`{c}` as string))").isNull())
              .alias(f"t_{c}") for c in present]
    checks = [_row(f"{c}_timestamp_parseable", dataset, F.col(f"t_{c}") == 0,
                   f"All values in {c} are parseable.",
                   F.concat(F.lit("Found "), F.col(f"t_{c}").cast("string"),
                            F.lit(f" unparseable values in {c}.")), "validity") for c in present]
    return counts, checks


def _absent_times(dataset: str, df: DataFrame, columns: list) -> list:
    return [_literal(df.sparkSession, f"{c}_timestamp_parseable", dataset, False,
                     f"Missing timestamp/date column: {c}", "validity")
            for c in columns if c not in df.columns]


def timestamps(dataset: str, df: DataFrame, columns: list) -> DataFrame:
    """Unparseable (or missing) times, all columns of a table in one scan."""
    counts, checks = _time_parts(dataset, df, columns)
    parts = [_exploded(df.agg(*counts), checks)] if counts else []
    return union(parts + _absent_times(dataset, df, columns))


def unexpected_values(df: DataFrame, domains: dict) -> DataFrame:
    """(column, value, rows) outside the allowed values: one scan, counted on the map side."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in domains])).alias("p")
    allowed = {c: [str(v) for v in values] for c, values in domains.items()}
    inside = reduce(lambda acc, c: acc | ((F.col("column") == c)
                                          & F.col("value").isin(allowed[c])),
                    allowed, F.lit(False))
    return (df.select(pairs).select("p.*").where(F.col("value").isNotNull() & ~inside)
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows")))


def unexpected_table(tables: dict, domains: dict) -> DataFrame:
    """(dataset, column, value, rows): every value outside its domain, whole; ``domains`` goes by (table, column)."""
    parts = []
    for name, df in tables.items():
        own = {c: v for (t, c), v in domains.items() if t == name and c in df.columns}
        if own:
            parts.append(unexpected_values(df, own).select(F.lit(name).alias("dataset"), "column", "value", "rows"))
    return union(parts)


def allowed_values(dataset: str, df: DataFrame, domains: dict, listed: int = LISTED) -> DataFrame:
    present = {c: v for c, v in domains.items() if c in df.columns}
    parts = []
    if present:
        # A message lists the first of a column's unexpected codes and counts all: a free text in the
        # wrong column must not end up in one row.  The whole list is unexpected_table.
        strange = unexpected_values(df, present)
        shown = (strange.withColumn("_rank", F.row_number().over(
            Window.partitionBy("column").orderBy("value"))).where(F.col("_rank") <= listed)
            .groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("bad")))
        found = strange.groupBy("column").agg(F.count(F.lit(1)).alias("n")).join(shown, "column")
        more = F.when(F.col("n") > listed, F.concat(
            F.lit(" and "), (F.col("n") - listed).cast("string"), F.lit(" more"))).otherwise("")
        columns = df.sparkSession.createDataFrame([(c,) for c in present], "column string")
        joined = columns.join(found, "column", "left")
        c = F.col("column")
        parts.append(joined.select(
            F.concat(c, F.lit("_allowed_values")).alias("name"), F.lit(dataset).alias("dataset"),
            F.when(F.col("bad").isNull(), "passed").otherwise("failed").alias("status"),
            F.lit("critical").alias("severity"),
            F.when(F.col("bad").isNull(), F.concat(
                F.lit("All values in "), c, F.lit(" are within the expected domain.")))
            .otherwise(F.concat(F.lit("Unexpected values in "), c, F.lit(": "),
                                _text(F.col("bad")), more)).alias("message"),
            F.lit("validity").alias("category")))
    parts += [_literal(df.sparkSession, f"{c}_allowed_values", dataset, False,
                       f"Missing categorical column: {c}", "validity")
              for c in domains if c not in df.columns]
    return union(parts)


def union(parts: list) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def report(tables: dict) -> DataFrame:
    """All checks over the six tables; gaps, times and amounts of a table share one scan."""
    parts = []
    for name in S.TABLES:
        df = tables[name]
        parts.append(required_columns(name, df, S.TABLES[name].fieldNames()))
        times = S.TIME_COLUMNS.get(name, [])
        scans = [_null_parts(name, df, S.KEY_FIELDS[name]), _time_parts(name, df, times)]
        if name == "transactions" and "amount" in df.columns:
            scans.append(_amount_parts())
        parts.append(_exploded(df.agg(*[c for counts, _ in scans for c in counts]),
                               [c for _, checks in scans for c in checks]))
        parts += _absent_times(name, df, times)
        domains = {c: v for (t, c), v in S.DOMAINS.items() if t == name}
        if domains:
            parts.append(allowed_values(name, df, domains))
    parts.append(key_checks(tables, {name: S.PRIMARY_KEYS[name] for name in S.TABLES}, S.FOREIGN_KEYS))
    if "amount" not in tables["transactions"].columns:
        parts.append(positive_amount(tables["transactions"]))
    return union(parts)


def overview(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status", "severity", "category").agg(F.count(F.lit(1)).alias("checks"))


def overall_status(checks: DataFrame) -> DataFrame:
    critical = F.count_if((F.col("status") == "failed") & (F.col("severity") == "critical"))
    return checks.agg(
        F.when(critical > 0, "failed").otherwise("passed").alias("overall_status"),
        F.count_if(F.col("status") == "passed").alias("passed_checks"),
        F.count_if(F.col("status") == "failed").alias("failed_checks"),
        F.count_if((F.col("status") == "failed") & (F.col("severity") == "warning"))
        .alias("warnings"),
        F.count_if(F.col("category") == "relationship").alias("relationship_checks"))


def row_counts(tables: dict) -> DataFrame:
    return union([df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), "rows") for name, df in tables.items()])


def gate(checks: DataFrame) -> DataFrame:
    """Raise unless the report passed; later stages call this before they write."""
    row = overall_status(checks).first()
    if row["overall_status"] != "passed":
        failed = [r["name"] for r in checks.where("status = 'failed'").limit(20).collect()]
        raise ValueError(f"data validation failed: {row['failed_checks']} checks, e.g. {failed}")
    return checks
