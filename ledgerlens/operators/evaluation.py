"""Threshold analysis and classification metrics without sorting all scores in one task."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import safe_ratio

THRESHOLDS = [round(i / 100, 2) for i in range(1, 100)]


def _threshold_index(probability: Column) -> Column:
    """How many of the thresholds are at most ``probability`` (compared as literals)."""
    ladder = F.array(*[F.lit(t) for t in THRESHOLDS])
    guess = F.greatest(F.lit(0), F.least(F.lit(99), F.floor(probability * 100).cast("int")))
    up = (guess < 99) & (F.get(ladder, guess) <= probability)
    down = (guess > 0) & (F.get(ladder, guess - 1) > probability)
    return guess + F.when(up, 1).when(down, -1).otherwise(0)


def threshold_analysis(df: DataFrame, label: str = "actual_fraud_label",
                       probability: str = "fraud_probability") -> DataFrame:
    """Precision, recall, F1 and volume at 0.01 ... 0.99.

    Each row is counted once, in the bucket of the largest threshold it passes; the rest is a
    running sum over at most 100 buckets.
    """
    buckets = df.groupBy(_threshold_index(F.col(probability)).alias("i")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("p"))
    ladder = df.sparkSession.range(0, 100).select(
        F.col("id").cast("int").alias("i"),
        F.get(F.array(*[F.lit(t) for t in THRESHOLDS]), (F.col("id") - 1).cast("int"))
        .alias("threshold"))
    above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)  # 100 rows
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    full = ladder.join(buckets, "i", "left").na.fill(0, ["n", "p"])
    counted = full.select("i", "threshold", F.sum("n").over(above).alias("predicted"),
                          F.sum("p").over(above).alias("hits"), F.sum("p").over(total).alias("all"))
    precision = safe_ratio(F.col("hits"), F.col("predicted"))
    recall = safe_ratio(F.col("hits"), F.col("all"))
    return counted.where("i > 0").select(
        "threshold", precision.alias("precision"), recall.alias("recall"),
        safe_ratio(2 * precision * recall, precision + recall).alias("f1_score"),
        F.col("predicted").alias("predicted_positive_count"))


def select_threshold(analysis: DataFrame, cfg: dict) -> DataFrame:
    """One row with the operating threshold (the default when nothing qualifies)."""
    metric = cfg["threshold_selection_metric"]
    if metric == "f1":
        eligible = analysis.where("f1_score > 0")
        order = [F.desc("f1_score"), F.desc("recall"), F.desc("precision"), F.asc("threshold")]
    elif metric == "recall_at_minimum_precision":
        eligible = analysis.where(F.col("precision") >= float(cfg["minimum_precision"]))
        order = [F.desc("recall"), F.desc("precision"), F.asc("threshold")]
    else:
        raise ValueError(f"unsupported threshold selection metric: {metric}")
    best = eligible.orderBy(*order).limit(1)
    return best.agg(F.coalesce(F.first("threshold"), F.lit(float(cfg["default_threshold"])))
                    .alias("selected_threshold"))


def confusion(df: DataFrame, by: list, label: str, prediction: str,
              probability: str) -> DataFrame:
    actual, flagged = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(probability).alias("fraud_probability_mean"),
        F.count_if(actual & flagged).alias("true_positives"),
        F.count_if(~actual & flagged).alias("false_positives"),
        F.count_if(~actual & ~flagged).alias("true_negatives"),
        F.count_if(actual & ~flagged).alias("false_negatives"))


SLICE_ROWS = 1_000_000  # rows that one slice holds, about
MOST_SLICES = 20_000  # 20 TB of scores; bounds what is broadcast


def ranking(df: DataFrame, by: list, label: str, probability: str,
            slices: int | None = None) -> DataFrame:
    """ROC AUC and average precision (step sum) per group.  Slices grow in number with the rows.

    Rows collapse to one per distinct score; score slices of about equal size are summed first, so
    the running totals are computed slice by slice, each starting from the totals of the slices
    above it (at most ``slices`` + 1 rows per group, hence the broadcast).
    """
    slices = slices or max(256, min(MOST_SLICES, df.count() // SLICE_ROWS))
    distinct = df.groupBy(*by, F.col(probability).alias("s")).agg(
        F.sum(F.col(label).cast("bigint")).alias("p"),
        F.count_if(F.col(label) == 0).alias("n"))
    edges = sorted(set(df.stat.approxQuantile(
        probability, [i / slices for i in range(1, slices)], 0.25 / slices)))
    cut = Bucketizer(splits=[-float("inf"), *edges, float("inf")], inputCol="s", outputCol="slice")
    sliced = cut.transform(distinct) if edges else distinct.withColumn("slice", F.lit(0.0))
    above = (Window.partitionBy(*by).orderBy(F.desc("slice"))
             .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*by)
    starts = (sliced.groupBy(*by, "slice").agg(F.sum("p").alias("sp"), F.sum("n").alias("sn"))
              .select(*by, "slice", F.coalesce(F.sum("sp").over(above), F.lit(0)).alias("p0"),
                      F.coalesce(F.sum("sn").over(above), F.lit(0)).alias("n0"),
                      F.sum("sp").over(whole).alias("all_p"), F.sum("sn").over(whole).alias("all_n")))
    inner = (Window.partitionBy(*by, "slice").orderBy(F.desc("s"))
             .rowsBetween(Window.unboundedPreceding, 0))
    running = sliced.withColumns({"cp": F.sum("p").over(inner), "cn": F.sum("n").over(inner)}).join(
        F.broadcast(starts), [*by, "slice"])
    hits = F.col("p0") + F.col("cp")
    misses = F.col("n0") + F.col("cn")
    below = F.col("all_n") - misses
    return running.groupBy(*by).agg(
        F.max("all_p").alias("_P"), F.max("all_n").alias("_N"),
        F.sum(F.col("p") * (below + F.col("n") / 2.0)).alias("_wins"),
        F.sum(F.col("p") * hits / (hits + misses)).alias("_steps")).select(
        *by,
        F.when((F.col("_P") > 0) & (F.col("_N") > 0),
               F.col("_wins") / F.col("_P") / F.col("_N")).alias("roc_auc"),
        F.when((F.col("_P") > 0) & (F.col("_N") > 0),
               F.col("_steps") / F.col("_P")).alias("average_precision"))


def metrics(df: DataFrame, by: list | None = None, label: str = "actual_fraud_label",
            prediction: str = "predicted_fraud_label",
            probability: str = "fraud_probability") -> DataFrame:
    """All classification metrics, one row per group (one row overall without ``by``)."""
    by = by or []
    work = df if by else df.withColumn("_all", F.lit(1))
    keys = by or ["_all"]
    counts = confusion(work, keys, label, prediction, probability)
    joined = counts.join(ranking(work, keys, label, probability), keys)
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    precision, recall = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    out = joined.withColumns({
        "fraud_rate": safe_ratio(tp + fn, F.col("row_count")),
        "predicted_fraud_count": tp + fp,
        "accuracy": safe_ratio(tp + tn, F.col("row_count")),
        "precision": precision, "recall": recall,
        "f1_score": safe_ratio(2 * precision * recall, precision + recall),
        "false_positive_rate": safe_ratio(fp, fp + tn),
        "false_negative_rate": safe_ratio(fn, fn + tp)})
    return out if by else out.drop("_all")
