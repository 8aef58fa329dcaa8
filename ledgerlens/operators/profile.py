"""Profile of the feature tables: one row per column, and quality totals per table."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..settings import LABEL_COLUMNS
from .explain import feature_category
from .quality import duplicates, union


def _missing(df: DataFrame, column: str):
    gap = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        gap = gap | F.isnan(column)
    return gap


def _distinct_counts(df: DataFrame) -> DataFrame:
    """(feature_name, distinct_count): one deduplicated (column, value) table.

    Several exact distinct counts in one aggregate would send every row once per column through the
    exchange; deduplicating on the map side first sends each value once per task.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("string").alias("v"))
        for c in df.columns])).alias("p")
    return (df.select(pairs).select("p.*").where(F.col("v").isNotNull()).distinct()
            .groupBy("feature_name").agg(F.count(F.lit(1)).alias("distinct_count")))


def columns(table: str, df: DataFrame) -> DataFrame:
    """Type, gaps, distinct values, category, source, leakage risk and use of every column."""
    gaps = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    long = gaps.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("feature_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f.name).alias("missing_count")) for f in df.schema])).alias("c")
    ).select("c.*")
    name = F.col("feature_name")
    label = name.isin(*LABEL_COLUMNS) | name.startswith("historical_fraud_")
    category = F.col("category")
    return (long.join(_distinct_counts(df), "feature_name", "left").na.fill(0, ["distinct_count"])
            .withColumn("feature_table", F.lit(table))
            .withColumn("category", feature_category(name, F.lit(table)))
            .withColumns({
                "source_dataset": F.when(label, "fraud_labels")
                .when(category == "KYC", "customers").when(category == "AML", "aml_watchlist")
                .when(category == "device", "transactions;device_sessions").otherwise("derived"),
                "leakage_risk": F.when(label, "high - outcome only")
                .otherwise("low - prior-only or static"),
                "intended_use": F.when(label, "outcome analysis only")
                .otherwise("predictive modelling and analytics")}))


def unsafe_columns(profile: DataFrame, table: str = "transaction_features") -> list:
    """Columns a model must not read (as many names as the table has columns)."""
    rows = profile.where((F.col("feature_table") == table)
                         & ((F.col("category") == "label")
                            | F.contains("leakage_risk", F.lit("high"))))
    return sorted(r["feature_name"] for r in rows.select("feature_name").collect())


def quality_summary(tables: dict, keys: dict, profile: DataFrame) -> DataFrame:
    """(section, item, value): rows, columns, repeated keys, gaps, categories."""
    def rows(df, section):
        return df.select(F.lit(section).alias("section"), "item",
                         F.col("value").cast("bigint").alias("value"))

    parts = []
    for name, df in tables.items():
        parts.append(rows(df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("item"), "value"), "row_count"))
        if name in keys:
            parts.append(rows(duplicates(df, keys[name]).select(
                F.lit(f"{name}.{keys[name]}").alias("item"), F.col("duplicates").alias("value")),
                "duplicate_keys"))
    gaps = profile.where("missing_count > 0").select(
        F.concat_ws(".", "feature_table", "feature_name").alias("item"),
        F.col("missing_count").alias("value"))
    counted = profile.groupBy(F.col("feature_table").alias("item")).agg(
        F.count(F.lit(1)).alias("value"))
    categories = profile.groupBy(F.col("category").alias("item")).agg(
        F.count(F.lit(1)).alias("value"))
    parts += [rows(gaps, "missing_values"), rows(counted, "column_count"),
              rows(categories, "category")]
    return reduce(lambda a, b: a.unionByName(b), parts)


def profile_all(tables: dict) -> DataFrame:
    return union([columns(name, df) for name, df in tables.items()])
