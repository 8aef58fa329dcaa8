"""Parameter overrides that make every rule fire on the test tables.

Amounts there are small (median about 35, at most about 490) and span 30 days, so the production
defaults would select almost nothing.
"""

from ..settings import AML, CASES, FEATURES, MONITOR, RISK

COUNTRIES = ["NATION_3", "NATION_7", "NATION_11"]

FEATURES_T = {**FEATURES, "high_value_transaction_threshold": 100.0,
              "rapid_transaction_minutes": 60, "high_risk_countries": COUNTRIES}

AML_T = {
    **AML,
    "high_risk_countries": COUNTRIES,
    "high_value_transaction_threshold": 200.0,
    "structuring_reporting_threshold": 200.0,
    "structuring_aggregate_threshold": 300.0,
    "structuring_window_hours": 24,
    "structuring_minimum_transaction_count": 3,
    "rapid_movement_window_minutes": 60.0,
    "rapid_movement_minimum_amount": 100.0,
    "cross_border_window_days": 3,
    "cross_border_count_threshold": 9,
    "cross_border_ratio_threshold": 0.95,
    "dormant_account_days": 5,
    "dormant_reactivation_amount": 100.0,
    "failed_transaction_window_hours": 72,
    "failed_transaction_count_threshold": 2,
}

RISK_T = {**RISK, "component_caps": {**RISK["component_caps"], "aml_alert": 12000.0}}
CASES_T = {**CASES, "minimum_total_risk_score": 50.0}
MONITOR_T = {**MONITOR, "reference_timestamp": "2024-02-01T00:00:00"}
