"""All oracle SQL by query name."""

from importlib import import_module

MODULES = ["quality", "features", "rules", "model", "risk", "explain", "cases", "monitor",
           "star", "stream"]

# Literal and source columns that are 32-bit there; results use 64-bit integers.
WIDEN = {
    "dq_gate": ["warnings"],
    "dq_dedup_lookup": ["l_linenumber"],
    "ag_account": ["account_status_encoded", "account_type_encoded"],
    "ag_customer": ["kyc_status_encoded"],
    "rk_indicators": ["kyc_status_encoded"],
    "ex_quality": ["explanations_failed", "invalid_reason_code_count",
                   "excluded_feature_violation_count", "missing_feature_count"],
    "ex_samples": ["slot"],
    "iv_prompt_payload": ["prohibited"],
    "iv_grounding_quality": ["grounding_checks_failed", "safety_checks_failed"],
    "st_fact_pipeline": ["artefact_count"],
}


def all_sql() -> dict:
    found = {}
    for module in MODULES:
        found.update(import_module(f"oracles.{module}").SQL)
    for name, columns in WIDEN.items():
        casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
        found[name] = f"SELECT * REPLACE ({casts}) FROM (\n{found[name]}\n)"
    return found
