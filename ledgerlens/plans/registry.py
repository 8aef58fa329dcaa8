"""All registered queries by the identifiers of the operator inventory."""

from importlib import import_module

MODULES = ["quality_queries", "feature_queries", "rule_queries", "model_queries", "risk_queries",
           "explain_queries", "case_queries", "monitor_queries",
           "star_queries", "stream_queries"]


def all_queries() -> dict:
    found = {}
    for module in MODULES:
        found.update(import_module(f"{__package__}.{module}").QUERIES)
    return found
