"""Fraud model: leak-free inputs, preprocessing, class-balanced logistic regression, scoring.

A fitted model is a short list of terms (one per numeric input, one per category level), so scoring
and explaining are Column expressions on the feature table; nothing is collected per row.
"""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..settings import LABEL_COLUMNS, MODEL
from .position import quantiles

_PLAIN_TERMS = 200  # more would nest too deeply as one sum
OUTCOMES = ["true_positive", "false_positive", "true_negative", "false_negative"]


def predictive_columns(df: DataFrame, cfg: dict = MODEL, unsafe: list | None = None) -> list:
    """Model inputs: everything but ids, outcomes, the timestamp and columns profiled as leaks."""
    excluded = {*cfg["id_columns"], *cfg["excluded_feature_columns"], *LABEL_COLUMNS,
                cfg["target_column"], cfg["timestamp_column"], *(unsafe or [])}
    selected = [c for c in df.columns if c not in excluded]
    if not selected:
        raise ValueError("no predictive columns remain")
    return selected


def split_kinds(df: DataFrame, columns: list) -> tuple:
    """(numeric, categorical) by column type."""
    numeric = [c for c in columns
               if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]
    return numeric, [c for c in columns if c not in numeric]


def target_profile(df: DataFrame, target: str) -> DataFrame:
    value = F.expr(f"try_cast({target} as double)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(value.isNull()).alias("missing"),
        F.count_if(value.isNotNull() & ~value.isin(0.0, 1.0)).alias("outside"),
        F.count_if(value == 0).alias("negatives"), F.count_if(value == 1).alias("positives"))


def validate_target(df: DataFrame, target: str) -> dict:
    """Counts of a usable binary target; raises when it is missing, non-binary or one-sided."""
    row = target_profile(df, target).first().asDict()
    if row["missing"]:
        raise ValueError(f"{target} contains {row['missing']} missing or non-numeric values")
    if row["outside"]:
        raise ValueError(f"{target} must be 0 or 1")
    if not (row["negatives"] and row["positives"]):
        raise ValueError(f"{target} must contain both classes")
    return row


@dataclass(frozen=True)
class Term:
    name: str
    source: str
    level: str | None = None  # category level; None for a numeric term
    fill: object = None  # what replaces a missing value
    center: float = 0.0
    scale: float = 1.0
    coefficient: float = 0.0

    def value(self) -> Column:
        if self.level is not None:
            filled = F.coalesce(F.col(self.source).cast("string"), F.lit(self.fill))
            return F.coalesce(filled == F.lit(self.level), F.lit(False)).cast("double")
        number = F.col(self.source).cast("double")
        filled = F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(self.fill))
        return (filled - F.lit(self.center)) / F.lit(self.scale)


@dataclass(frozen=True)
class LinearModel:
    terms: tuple
    intercept: float = 0.0

    @property
    def sources(self) -> list:
        return list(dict.fromkeys(t.source for t in self.terms))

    def values(self) -> Column:
        return F.array(*[t.value() for t in self.terms])

    def with_coefficients(self, coefficients: dict, intercept: float) -> "LinearModel":
        return LinearModel(tuple(replace(t, coefficient=float(coefficients[t.name]))
                                 for t in self.terms), float(intercept))

    def decision(self) -> Column:
        if len(self.terms) <= _PLAIN_TERMS:  # compiled; a lambda and all that it reads are interpreted
            return reduce(lambda acc, t: acc + t.value() * F.lit(t.coefficient), self.terms,
                          F.lit(float(self.intercept)))
        products = F.zip_with(self.values(), F.array(*[F.lit(t.coefficient) for t in self.terms]),
                              lambda v, c: v * c)
        return F.aggregate(products, F.lit(float(self.intercept)), lambda acc, x: acc + x)


def sigmoid(score: Column) -> Column:
    """Logistic function that never overflows."""
    small = F.exp(-F.abs(score))
    return F.when(score >= 0, 1.0 / (1.0 + small)).otherwise(small / (1.0 + small))


def levels(df: DataFrame, columns: list, limit: int = 100_000) -> dict:
    """{column: [(value, count), ...]} of code columns: one pass, counts only."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in columns])).alias("p")
    rows = (df.select(pairs).select("p.c", "p.v").where(F.col("v").isNotNull())
            .groupBy("c", "v").count().limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError("a categorical input has too many levels for one-hot terms")
    found = {c: [] for c in columns}
    for row in sorted(rows, key=lambda r: (r["c"], r["v"])):
        found[row["c"]].append((row["v"], row["count"]))
    return found


def fit_terms(train: DataFrame, columns: list) -> LinearModel:
    """Median fill and population scaling of numbers; mode fill and one-hot levels of categories.

    A level that training never saw matches no term, so all of its one-hot values are 0.
    """
    numeric, categorical = split_kinds(train, columns)
    medians = quantiles(train, {c: [0.5] for c in numeric}) if numeric else {}
    fills = {c: (medians[c][0] if medians[c][0] is not None else 0.0) for c in numeric}
    terms = []
    if numeric:
        filled = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                             F.lit(fills[c])) for c in numeric]
        # one small aggregate over (column, value), whatever the number of columns
        cells = train.select(F.array(*filled).alias("_n")).select(
            F.posexplode_outer("_n").alias("c", "v"))
        moments = {r["c"]: (r["m"], r["s"]) for r in cells.groupBy("c").agg(
            F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()}
        for i, c in enumerate(numeric):
            center, scale = moments.get(i, (None, None))
            terms.append(Term(f"numeric__{c}", c, None, fills[c], center, scale or 1.0))
    for c, found in levels(train, categorical).items():
        mode = min(found, key=lambda item: (-item[1], item[0]))[0] if found else ""
        terms += [Term(f"categorical__{c}_{value}", c, value, mode) for value, _ in found]
    return LinearModel(tuple(terms))


def fit(train: DataFrame, columns: list, target: str, cfg: dict = MODEL) -> tuple:
    """Class-balanced L2 logistic regression with C = 1; (LinearModel, Spark model).

    The constant is one more penalised column, which is the objective of the usual linear solver
    for this penalty.  Spark ignores a column without variance, so half of the rows (by hash) enter
    with label and inputs both negated: the logistic loss of a row does not change, and the constant
    becomes a column of +1 and -1.  ``regParam`` is 1/n because Spark divides the loss by the weight
    sum, and balanced weights sum to n.
    """
    counts = validate_target(train, target)
    n = counts["rows"]
    shape = fit_terms(train, columns)
    if cfg["class_weight"] == "balanced":
        weight = F.when(F.col(target) == 1, n / (2.0 * counts["positives"])).otherwise(
            n / (2.0 * counts["negatives"]))
    else:
        weight = F.lit(1.0)
    side = F.when(F.pmod(F.xxhash64(target, *columns), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    # plain products: what a lambda reads is interpreted
    inputs = F.array(*[t.value() * F.col("side") for t in shape.terms], F.lit(1.0) * F.col("side"))
    label = F.col(target).cast("double")
    design = train.withColumn("side", side).select(
        F.when(F.col("side") > 0, label).otherwise(1.0 - label).alias("label"),
        weight.alias("weight"), array_to_vector(inputs).alias("features"))
    solver = LogisticRegression(weightCol="weight", regParam=1.0 / n, elasticNetParam=0.0,
                                standardization=False, fitIntercept=False, tol=1e-6,
                                maxIter=int(cfg["max_iterations"]))
    solved = solver.fit(design)
    weights = solved.coefficients.toArray()
    named = dict(zip([t.name for t in shape.terms], weights[:-1]))
    return shape.with_coefficients(named, weights[-1]), solved


def slopes(train: DataFrame, model: LinearModel, target: str, cfg: dict = MODEL) -> DataFrame:
    """(transformed_feature_name, slope): the derivative of the penalised loss per weighted row.

    All terms come from one pass: the error of a row times its values, summed per term.
    """
    counts = validate_target(train, target)
    n = counts["rows"]
    balanced = cfg["class_weight"] == "balanced"
    weight = F.when(F.col(target) == 1, n / (2.0 * counts["positives"]) if balanced else 1.0) \
        .otherwise(n / (2.0 * counts["negatives"]) if balanced else 1.0)
    error = F.col("w") * (sigmoid(F.col("score")) - F.col("y"))
    per_term = (train.select(weight.alias("w"), F.col(target).cast("double").alias("y"),
                             model.decision().alias("score"), model.values().alias("z"))
                .select(error.alias("e"), "z")
                .select("e", F.posexplode_outer("z").alias("i", "z")).groupBy("i")
                .agg((F.sum(F.col("e") * F.col("z")) / n).alias("gradient")))
    terms = train.sparkSession.createDataFrame(
        [(i, t.name, float(t.coefficient) / n) for i, t in enumerate(model.terms)],
        "i int, transformed_feature_name string, penalty double")
    return terms.join(per_term, "i").select(
        "transformed_feature_name", (F.col("gradient") + F.col("penalty")).alias("slope"))


def design_vector(model: LinearModel) -> Column:
    return array_to_vector(F.concat(model.values(), F.array(F.lit(1.0))))


def score(df: DataFrame, model: LinearModel, solved) -> DataFrame:
    """Add the Spark model's decision score and positive-class probability in [0, 1]."""
    scored = solved.transform(df.withColumn("features", design_vector(model)))
    return scored.select(
        *df.columns, vector_to_array("rawPrediction")[1].alias("decision_score"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), vector_to_array("probability")[1]))
        .alias("fraud_probability"))


def score_linear(df: DataFrame, model: LinearModel) -> DataFrame:
    """The same two columns from a term list alone."""
    return (df.withColumn("decision_score", model.decision())
            .withColumn("fraud_probability", sigmoid(F.col("decision_score"))))


def coefficient_table(spark, model: LinearModel) -> DataFrame:
    """One row per term: what fills a gap (number or level), center, scale and coefficient."""
    rows = [(t.name, t.source, "numeric", float(t.fill), None, float(t.center), float(t.scale),
             float(t.coefficient)) if t.level is None else
            (t.name, t.source, "categorical", None, t.fill, None, None, float(t.coefficient))
            for t in model.terms]
    return spark.createDataFrame(
        rows, "transformed_feature_name string, source_feature_name string, transform_type string, "
              "fill_number double, fill_level string, center double, scale double, coefficient double")


def predictions(scored: DataFrame, threshold: float, target: str = "fraud_label") -> DataFrame:
    """Row-level decisions and their outcome type."""
    actual = F.col(target).cast("int") == 1
    flagged = F.col("fraud_probability") >= F.lit(float(threshold))
    outcome = (F.when(actual & flagged, "true_positive").when(flagged, "false_positive")
               .when(actual, "false_negative").otherwise("true_negative"))
    return scored.withColumns({
        "actual_fraud_label": F.col(target).cast("bigint"),
        "predicted_fraud_label": flagged.cast("bigint"),
        "selected_threshold": F.lit(float(threshold)), "error_type": outcome})
