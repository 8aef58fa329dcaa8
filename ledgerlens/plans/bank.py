"""Stage tables of one input folder.

Like any batch pipeline, later stages read what earlier stages published.  A stage is computed once
per session and folder and written to the shared folder; reading it back cuts the lineage, survives
lost executors and gives the optimizer real sizes.
"""

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..functions.columns import iso_timestamp
from ..operators import (aggregates, cases, evaluation, explain, features, model, monitor,
                         position, profile, quality, risk, rules, star)
from ..settings import LABEL_COLUMNS, MODEL
from ..sources import banking, files
from ..workspace import fresh_folder, prepare, size_shuffles
from .fixtures import AML_T, CASES_T, FEATURES_T, MONITOR_T, RISK_T
from .scorecard import scorecard

_BANKS: dict = {}


class Lazy(Mapping):
    """Named tables that are built when first asked for."""

    def __init__(self, builders: dict):
        self._builders, self._built = builders, {}

    def __getitem__(self, name):
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def bank(spark: SparkSession, sf_dir: str, fixed_weights: bool = True) -> "Bank":
    """Stages of a folder, remembered per session, folder and state of its files.

    The registered queries ask for fixed weights, which SQL can repeat; a :class:`Bank` of its own
    runs on the trained model.
    """
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir, fixed_weights, files.state(spark, sf_dir))
    if key not in _BANKS:
        size_shuffles(spark, sf_dir)
        _BANKS[key] = Bank(spark, sf_dir, fixed_weights)
    return _BANKS[key]


class Bank:
    features_cfg, aml_cfg, risk_cfg = FEATURES_T, AML_T, RISK_T
    cases_cfg, monitor_cfg = CASES_T, MONITOR_T

    def __init__(self, spark: SparkSession, sf_dir: str, fixed_weights: bool = False):
        self.spark, self.sf_dir, self.fixed_weights = spark, sf_dir, fixed_weights
        self.folder = fresh_folder(spark, "stages")

    @cached_property
    def tables(self) -> dict:
        """The six base tables, landed once as every later stage reads them."""
        return self.publish_all(banking.banking_tables(self.spark, self.sf_dir))

    @cached_property
    def validation_report(self) -> DataFrame:
        return self.publish("validation_report", quality.report(self.tables))

    @cached_property
    def unexpected_values(self) -> DataFrame:
        """Beside the report, whose messages list only the first ones of a column."""
        return self.publish("unexpected_values", quality.unexpected_table(self.tables, S.DOMAINS))

    @cached_property
    def refusal(self) -> Exception | None:
        """What the validation gate says against these tables; asked once, whatever it says."""
        try:
            quality.gate(self.validation_report)
        except ValueError as error:
            return error
        return None

    @property
    def admitted(self) -> dict:
        """The tables behind the validation gate: later stages refuse invalid input."""
        if self.refusal is not None:
            raise self.refusal
        return self.tables

    @cached_property
    def crowded(self) -> dict:
        """Keys with very many transactions, published; None without any."""
        return {name: None if keys is None else self.publish(name, keys)
                for name, keys in features.crowded_keys(self.tables["transactions"]).items()}

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def publish_all(self, tables: dict) -> dict:
        """Independent tables, written by concurrent jobs."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            written = pool.map(lambda item: (item[0], self.publish(*item)), tables.items())
            return dict(written)

    # -- lazy results (nothing published) -------------------------------------------------------

    def lazy_features(self) -> DataFrame:
        return features.transaction_features(self.admitted, self.features_cfg,
                                             self.crowded["crowded_customers"])

    # -- published stages -----------------------------------------------------------------------

    @cached_property
    def features(self) -> DataFrame:
        return self.publish("transaction_features", self.lazy_features())

    @cached_property
    def account_features(self) -> DataFrame:
        return self.publish("account_features", aggregates.account_features(
            self.tables["accounts"], self.features, self.features_cfg))

    @cached_property
    def customer_features(self) -> DataFrame:
        return self.publish("customer_features", aggregates.customer_features(
            self.tables, self.features, self.features_cfg))

    @cached_property
    def books(self) -> dict:
        return rules.codebooks(self.tables["transactions"])

    def aml_prepared(self) -> DataFrame:
        return rules.prepare(self.tables, self.features, **self.crowded)

    def rule_history(self, only: list | None = None) -> DataFrame:
        return rules.with_history(self.aml_prepared(), self.aml_cfg, only, self.books,
                                  source=self.tables["transactions"])

    @cached_property
    def alerts(self) -> DataFrame:
        return self.publish("aml_alerts", rules.evaluate(self.rule_history(), self.aml_cfg))

    @cached_property
    def aml_summary(self) -> DataFrame:
        return self.publish("aml_customer_summary",
                            rules.customer_summary(self.alerts, self.aml_cfg))

    # -- fraud model ----------------------------------------------------------------------------

    @cached_property
    def labelled(self) -> DataFrame:
        return self.publish("labelled_features", features.join_labels(
            self.features, self.tables["fraud_labels"]))

    @cached_property
    def split(self) -> tuple:
        return position.chronological_split(self.labelled, "transaction_timestamp",
                                            "transaction_id", MODEL["test_fraction"],
                                            target=MODEL["target_column"])

    @cached_property
    def scorecard(self):
        """The linear model in use: the trained one, or fixed weights where SQL has to follow."""
        return scorecard(self.split[0]) if self.fixed_weights else self.trained[0]

    @cached_property
    def scored(self) -> DataFrame:
        return self.publish("scored", model.score_linear(self.split[1], self.scorecard))

    @cached_property
    def threshold(self) -> float:
        analysis = evaluation.threshold_analysis(self.scored, "fraud_label")
        return evaluation.select_threshold(analysis, MODEL).first()[0]

    @cached_property
    def predictions(self) -> DataFrame:
        return self.publish("predictions", model.predictions(self.scored, self.threshold))

    @cached_property
    def trained(self) -> tuple:
        train = self.split[0]
        unsafe = profile.unsafe_columns(self.profile)
        return model.fit(train, model.predictive_columns(train, unsafe=unsafe), "fraud_label")

    # -- customer risk --------------------------------------------------------------------------

    def joined_indicators(self) -> DataFrame:
        return risk.joined_indicators(
            risk.without_labels(self.customer_features), self.tables["customers"], self.features,
            self.predictions, self.aml_summary, self.tables["device_sessions"], self.risk_cfg)

    @cached_property
    def indicators(self) -> DataFrame:
        return self.publish("risk_indicators", risk.fill_indicators(self.joined_indicators()))

    @cached_property
    def components(self) -> DataFrame:
        return self.publish("risk_components", risk.component_rows(self.indicators, self.risk_cfg))

    @cached_property
    def scores(self) -> DataFrame:
        return self.publish("risk_scores", risk.scores(self.indicators, self.risk_cfg))

    # -- explanations ---------------------------------------------------------------------------

    def explained(self) -> DataFrame:
        chosen = explain.select_outcomes(self.predictions, self.features, self.scorecard)
        return explain.with_contributions(chosen, self.scorecard)

    @cached_property
    def contributions(self) -> DataFrame:
        rows = explain.contributions(self.explained())
        outcome = self.predictions.select("transaction_id", "error_type")
        return self.publish("contributions", rows.join(outcome, "transaction_id"))

    @cached_property
    def reasons(self) -> DataFrame:
        return self.publish("reasons", explain.reasons(self.explained()))

    @cached_property
    def explanations(self) -> DataFrame:
        return self.publish("explanations", explain.local(self.explained(), self.scorecard))

    def explanation_quality(self) -> DataFrame:
        return explain.quality(self.explanations, self.reasons, self.scorecard,
                               [*MODEL["id_columns"], *MODEL["excluded_feature_columns"],
                                *LABEL_COLUMNS])

    # -- investigation cases --------------------------------------------------------------------

    def _text_ids(self, df: DataFrame) -> DataFrame:
        """Case texts quote transactions, so they carry printable ids."""
        return df.withColumn("transaction_id", F.concat(F.lit("TXN-"), F.lpad(
            F.col("transaction_id").cast("string"), 9, "0")))

    @cached_property
    def selected(self) -> DataFrame:
        return self.publish("selected_cases", cases.select(self.scores, self.cases_cfg))

    @cached_property
    def case_inputs(self) -> dict:
        explanations = self._text_ids(self.explanations).withColumn(
            "transaction_timestamp", iso_timestamp(F.col("transaction_timestamp")))
        return {"alerts": self._text_ids(self.alerts), "explanations": explanations,
                "reasons": self._text_ids(self.reasons)}

    @cached_property
    def packets(self) -> DataFrame:
        inputs = self.case_inputs
        return self.publish("packets", cases.packets(
            self.selected, self.components, inputs["alerts"], self.aml_summary,
            inputs["explanations"], inputs["reasons"], self.explanation_quality(),
            self.cases_cfg))

    @cached_property
    def case_references(self) -> DataFrame:
        inputs = self.case_inputs
        best = cases.top_explanations(self.selected, inputs["explanations"], self.cases_cfg)
        return self.publish("case_references", cases.references(
            self.selected, inputs["alerts"], best, self.cases_cfg))

    @cached_property
    def grounded(self) -> DataFrame:
        return self.publish("grounding", cases.grounding(
            self.packets, cases.summaries(self.packets, self.cases_cfg),
            cases.drafts(self.packets, self.cases_cfg), self.case_references, self.cases_cfg))

    @cached_property
    def case_rows(self) -> DataFrame:
        return self.publish("cases", cases.with_status(
            cases.summaries(self.packets, self.cases_cfg), self.grounded))

    # -- monitoring -----------------------------------------------------------------------------

    @cached_property
    def monitored(self) -> DataFrame:
        """The feature table split into two periods; a literal filter, so nothing is stored."""
        return monitor.periods(self.features)

    @cached_property
    def numeric_drift(self) -> DataFrame:
        return self.publish("numeric_drift", monitor.numeric_drift(self.monitored,
                                                                   self.monitor_cfg))

    @cached_property
    def categorical_drift(self) -> DataFrame:
        return self.publish("categorical_drift", monitor.categorical_drift(self.monitored,
                                                                           self.monitor_cfg))

    def rule_monitoring(self) -> DataFrame:
        return monitor.rule_monitoring(self.alerts, self.features.count(), self.scores.count(),
                                       self.monitor_cfg)

    def grounding_monitoring(self) -> DataFrame:
        return monitor.grounding(cases.grounding_quality(self.grounded),
                                 cases.payloads(self.packets, self.cases_cfg), self.monitor_cfg)

    @cached_property
    def health(self) -> DataFrame:
        return self.publish("table_health", monitor.table_health({
            "transaction_features": (self.features, "transaction_timestamp"),
            "aml_alerts": (self.alerts, "transaction_timestamp"),
            "fraud_predictions": (self.predictions, "transaction_timestamp"),
            "customer_risk_scores": (self.scores, None),
            "investigation_cases": (self.case_rows, None),
            "model_registry": (None, None),
        }, self.monitor_cfg))

    @cached_property
    def controls(self) -> DataFrame:
        cfg = self.monitor_cfg
        return self.publish("controls", monitor.control_rows({
            "data_quality": monitor.data_quality(self.monitored, cfg),
            "numeric_drift": self.numeric_drift,
            "categorical_drift": self.categorical_drift,
            "fraud_model": monitor.fraud_monitoring(monitor.fraud_performance(self.predictions),
                                                    cfg),
            "aml": self.rule_monitoring(),
            "customer_risk": monitor.risk_monitoring(self.scores, self.components, cfg),
            "explainability": monitor.explainability(self.explanation_quality(), cfg),
            "genai": self.grounding_monitoring(),
            "pipeline": self.health,
        }))

    @cached_property
    def monitoring_alerts(self) -> DataFrame:
        return self.publish("monitoring_alerts", monitor.alerts(self.controls, self.monitor_cfg))

    # -- reporting ------------------------------------------------------------------------------

    @cached_property
    def profile(self) -> DataFrame:
        return self.publish("feature_profile", profile.profile_all(self.feature_tables))

    @cached_property
    def feature_tables(self) -> dict:
        return {"transaction_features": self.labelled, "account_features": self.account_features,
                "customer_features": self.customer_features}

    @cached_property
    def dimensions(self) -> Mapping:
        t = self.tables
        return Lazy({
            "dim_customer": lambda: star.dim_customer(t["customers"], self.scores),
            "dim_account": lambda: star.dim_account(t["accounts"], t["customers"]),
            "dim_date": lambda: star.dim_date(self.features, self.alerts),
            "dim_time": lambda: star.dim_time(self.spark),
            "dim_aml_rule": lambda: star.dim_rule(rules.rule_table(self.spark, self.aml_cfg)),
            "dim_risk_band": lambda: star.dim_band(self.spark),
            "dim_monitoring_control": lambda: star.dim_control(self.monitoring_alerts),
        })

    @cached_property
    def facts(self) -> Mapping:
        t = self.tables
        builders = {
            "fact_transactions": lambda: star.fact_transactions(self.features, t["customers"],
                                                                t["accounts"]),
            "fact_fraud_predictions": lambda: star.fact_fraud(self.predictions, self.features),
            "fact_aml_alerts": lambda: star.fact_alerts(self.alerts, t["customers"],
                                                        t["accounts"]),
            "fact_customer_risk": lambda: star.fact_risk(self.scores),
            "fact_risk_components": lambda: star.fact_components(self.components),
            "fact_model_explanations": lambda: star.fact_explanations(
                self.contributions, self.reasons, self.explanations),
            "fact_investigation_cases": lambda: star.fact_cases(self.case_rows),
            "fact_monitoring_alerts": lambda: star.fact_monitoring(self.monitoring_alerts),
            "fact_pipeline_health": lambda: star.fact_pipeline(self.health),
        }
        # each is published once, when first asked for, and read by all that use it
        return Lazy({name: (lambda name=name, build=build: self.publish(name, build()))
                     for name, build in builders.items()})

    def report_sources(self) -> dict:
        """The table whose number of rows each fact must match."""
        return {"fact_transactions": self.features, "fact_aml_alerts": self.alerts,
                "fact_customer_risk": self.scores, "fact_investigation_cases": self.case_rows,
                "fact_monitoring_alerts": self.monitoring_alerts}
