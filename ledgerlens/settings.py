"""Default parameters of every stage.

The numbers and word lists below are fixed values: results are only comparable when they are equal,
so they are stated plainly, once, here.  Callers override with ``{**FEATURES, "night_end_hour": 5}``.
"""

FEATURES = {
    "reference_timestamp": "2026-01-01T00:00:00",
    "velocity_window_hours": 24,
    "behaviour_window_days": 7,
    "night_start_hour": 22,
    "night_end_hour": 6,
    "rapid_transaction_minutes": 10,
    "high_value_transaction_threshold": 1000.0,
    "high_risk_channels": ["ATM", "Online Banking"],
    "high_risk_merchant_categories": ["Crypto Exchange", "Money Transfer", "Cash Services"],
    "high_risk_countries": ["BR", "TR", "ZA"],
    "include_label_columns": True,
}

RULE_NAMES = {
    "AML001": "High-value transaction",
    "AML002": "Structuring or smurfing",
    "AML003": "Rapid movement of funds",
    "AML004": "High-risk geography",
    "AML005": "Unusual cross-border activity",
    "AML006": "Dormant or low-activity account reactivation",
    "AML007": "Repeated failed transactions",
    "AML008": "Device or session risk",
    "AML009": "KYC, PEP, sanctions, or watchlist exposure",
    "AML010": "Unusual merchant or channel pattern",
}

AML = {
    "reference_timestamp": "2026-01-01T00:00:00",
    "enabled_rules": list(RULE_NAMES),
    "rule_severity": {
        "AML001": "high", "AML002": "high", "AML003": "high", "AML004": "medium",
        "AML005": "medium", "AML006": "high", "AML007": "medium", "AML008": "medium",
        "AML009": "high", "AML010": "low",
    },
    "rule_risk_points": {
        "AML001": 30, "AML002": 35, "AML003": 30, "AML004": 18, "AML005": 20,
        "AML006": 28, "AML007": 16, "AML008": 18, "AML009": 32, "AML010": 10,
    },
    "high_value_transaction_threshold": 500.0,
    "structuring_reporting_threshold": 1000.0,
    "structuring_aggregate_threshold": 300.0,
    "structuring_window_hours": 720,
    "structuring_minimum_transaction_count": 3,
    "rapid_movement_window_minutes": 1440.0,
    "rapid_movement_minimum_amount": 100.0,
    "high_risk_countries": ["BR", "TR", "ZA"],
    "high_risk_channels": ["ATM", "Online Banking"],
    "high_risk_merchant_categories": ["Crypto Exchange", "Money Transfer", "Cash Services"],
    "cross_border_window_days": 30,
    "cross_border_count_threshold": 5,
    "cross_border_ratio_threshold": 0.9,
    "dormant_account_days": 60,
    "dormant_reactivation_amount": 200.0,
    "failed_transaction_window_hours": 720,
    "failed_transaction_count_threshold": 2,
    "customer_alert_threshold": 800,
    "critical_alert_threshold": 1600,
}

# Which parameters belong to which rule (shown in the rule summary).
RULE_PARAMETERS = {
    "AML001": ["high_value_transaction_threshold"],
    "AML002": ["structuring_aggregate_threshold", "structuring_minimum_transaction_count",
               "structuring_reporting_threshold", "structuring_window_hours"],
    "AML003": ["rapid_movement_minimum_amount", "rapid_movement_window_minutes"],
    "AML004": ["high_risk_countries"],
    "AML005": ["cross_border_count_threshold", "cross_border_ratio_threshold",
               "cross_border_window_days"],
    "AML006": ["dormant_account_days", "dormant_reactivation_amount"],
    "AML007": ["failed_transaction_count_threshold", "failed_transaction_window_hours"],
    "AML008": [],
    "AML009": [],
    "AML010": ["high_risk_channels", "high_risk_merchant_categories"],
}

MODEL = {
    "target_column": "fraud_label",
    "timestamp_column": "transaction_timestamp",
    "id_columns": ["transaction_id", "account_id", "customer_id", "device_id", "session_id"],
    "excluded_feature_columns": [
        "fraud_typology", "label_confidence", "label_source", "transaction_status",
    ],
    "test_fraction": 0.25,
    "max_iterations": 1000,
    "class_weight": "balanced",
    "default_threshold": 0.5,
    "threshold_selection_metric": "f1",
    "minimum_precision": 0.10,
}

RISK = {
    "reference_timestamp": "2026-01-01T00:00:00",
    "score_version": "1.0.0",
    "component_weights": {
        "kyc": 0.20, "transaction_behaviour": 0.20, "aml_alert": 0.30,
        "fraud_model": 0.15, "device_session": 0.15,
    },
    "component_caps": {
        "kyc": 300.0, "transaction_behaviour": 100.0, "aml_alert": 5000.0,
        "fraud_model": 100.0, "device_session": 100.0,
    },
    "risk_band_thresholds": {"moderate": 30.0, "high": 55.0, "critical": 75.0},
    "review_priority_thresholds": {"standard": 25.0, "enhanced": 50.0, "urgent": 75.0},
    "fraud_probability_threshold": 0.05,
    "high_fraud_probability_threshold": 0.70,
    "aml_severity_points": {"low": 5, "medium": 15, "high": 30, "critical": 50},
    "kyc_mappings": {"Verified": 0, "Pending Review": 40, "Enhanced Due Diligence": 70},
    "customer_risk_rating_mappings": {"Low": 0, "Medium": 30, "High": 70},
    "sanctions_mappings": {"Clear": 0, "Potential Match": 60, "Escalated": 100},
    "pep_points": 50,
    "watchlist_points": 60,
    "onboarding_recency": {
        "very_recent_days": 365, "recent_days": 730,
        "very_recent_points": 30, "recent_points": 15,
    },
    # metric column -> (threshold, maximum points)
    "behaviour_metrics": {
        "total_transaction_count": (40.0, 15),
        "total_transaction_amount": (5000.0, 15),
        "maximum_transaction_amount": (500.0, 20),
        "cross_border_ratio": (0.80, 15),
        "failed_transaction_ratio": (0.10, 10),
        "night_transaction_ratio": (0.30, 5),
        "unique_merchant_country_count": (10.0, 10),
        "new_device_transaction_count": (4.0, 5),
        "maximum_transaction_velocity": (2.0, 5),
    },
    "device_metrics": {
        "risky_session_count": (3.0, 25),
        "new_device_transaction_count": (4.0, 20),
        "failed_authentication_count": (1.0, 25),
        "geography_mismatch_count": (5.0, 20),
        "elevated_session_count": (1.0, 10),
    },
    "top_reason_count": 3,
}

EXPLAIN = {
    "top_global_feature_count": 10,
    "top_local_positive_count": 3,
    "top_local_negative_count": 3,
    "minimum_absolute_contribution": 0.01,
    "probability_reconstruction_tolerance": 1.0e-10,
    "contribution_reconstruction_tolerance": 1.0e-10,
    "explanation_sample_size": 6,
    "reason_code_prefix": "FRC",
    "included_outcomes": ["true_positive", "false_positive", "true_negative", "false_negative"],
}

CASES = {
    "maximum_cases": 5,
    "included_risk_bands": ["critical", "high"],
    "included_review_priorities": ["urgent", "enhanced"],
    "minimum_total_risk_score": 55.0,
    "minimum_aml_alert_count": 20,
    "minimum_fraud_probability": 0.70,
    "top_aml_alert_count": 5,
    "top_fraud_transaction_count": 5,
    "top_model_reason_count": 5,
    "maximum_narrative_words": 250,
    "prohibited_claims": [
        "committed fraud",
        "committed money laundering",
        "is guilty",
        "confirmed criminal activity",
        "submit this report",
        "close the account",
    ],
    "required_disclaimers": [
        "Analytical draft requiring human review.",
        "All data and indicators are synthetic.",
    ],
    "deterministic_timestamp": "2026-01-01T00:00:00",
    "output_version": "1.0.0",
}

MONITOR = {
    "reference_timestamp": "2026-06-22T00:00:00",
    "artefact_freshness_threshold_hours": 48,
    "row_count_change_warning_threshold": 0.25,
    "row_count_change_critical_threshold": 0.50,
    "missing_value_warning_threshold": 0.01,
    "duplicate_key_warning_threshold": 0,
    "psi_warning_threshold": 0.10,
    "psi_critical_threshold": 0.25,
    "distribution_distance_warning_threshold": 0.10,
    "distribution_distance_critical_threshold": 0.25,
    "precision_warning_threshold": 0.05,
    "recall_warning_threshold": 0.50,
    "average_precision_warning_threshold": 0.05,
    "false_positive_rate_warning_threshold": 0.50,
    "aml_alert_rate_warning_threshold": 0.50,
    "aml_alert_rate_critical_threshold": 1.00,
    "affected_customer_rate_warning_threshold": 0.9,
    "aml_rule_concentration_threshold": 0.30,
    "high_critical_concentration_threshold": 0.5,
    "customer_risk_band_shift_threshold": 0.20,
    "explanation_failure_threshold": 0,
    "reconstruction_difference_threshold": 1.0e-10,
    "severity": {
        "healthy": "information", "warning": "medium",
        "critical": "critical", "unavailable": "high",
    },
    "monitoring_version": "1.0.0",
    "numeric_features": [
        "amount", "log_transaction_amount", "amount_vs_account_average",
        "amount_vs_customer_average", "transaction_count_customer_24h",
        "transaction_amount_customer_24h", "transaction_velocity_score",
        "cross_border_transaction_count_7d", "risky_session_flag", "country_mismatch_flag",
    ],
    "categorical_features": [
        "channel", "transaction_type", "merchant_category", "merchant_country",
        "transaction_status", "session_risk_signal",
    ],
}

REPORT = {
    "reference_timestamp": "2026-06-22T00:00:00",
    "reporting_version": "1.0.0",
    "model_version": "1.0.0-baseline",
}

PERSONAL_COLUMNS = ["first_name", "last_name", "date_of_birth", "address", "email", "phone"]
LABEL_COLUMNS = ["fraud_label", "fraud_typology", "label_confidence", "label_source"]
