"""Explicit schemas, keys and domains of the six base tables (never inferred)."""

from pyspark.sql import types as T

_S, _D, _L, _B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
_TS, _DATE = T.TimestampNTZType(), T.DateType()


def _table(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


TABLES = {
    "customers": _table(
        ("customer_id", _S), ("first_name", _S), ("last_name", _S), ("date_of_birth", _DATE),
        ("age_band", _S), ("country", _S), ("customer_segment", _S), ("employment_status", _S),
        ("annual_income_band", _S), ("onboarding_date", _DATE), ("kyc_status", _S),
        ("pep_flag", _B), ("sanctions_screening_status", _S), ("customer_risk_rating", _S)),
    "accounts": _table(
        ("account_id", _S), ("customer_id", _S), ("account_type", _S),
        ("account_open_date", _DATE), ("account_status", _S), ("currency", _S),
        ("branch_region", _S), ("average_monthly_balance_band", _S)),
    "transactions": _table(
        ("transaction_id", _S), ("account_id", _S), ("customer_id", _S),
        ("transaction_timestamp", _TS), ("transaction_type", _S), ("channel", _S),
        ("merchant_category", _S), ("merchant_country", _S), ("amount", _D), ("currency", _S),
        ("is_cross_border", _B), ("transaction_status", _S), ("device_id", _S),
        ("session_id", _S)),
    "device_sessions": _table(
        ("session_id", _S), ("customer_id", _S), ("device_id", _S), ("session_timestamp", _TS),
        ("ip_country", _S), ("device_type", _S), ("operating_system", _S),
        ("login_success", _B), ("authentication_method", _S), ("session_risk_signal", _S)),
    "fraud_labels": _table(
        ("transaction_id", _S), ("fraud_label", _L), ("fraud_typology", _S),
        ("label_confidence", _D), ("label_source", _S)),
    "aml_watchlist": _table(
        ("watchlist_id", _S), ("customer_id", _S), ("watchlist_type", _S), ("alert_reason", _S),
        ("alert_severity", _S), ("created_date", _DATE), ("review_status", _S)),
}

FORMATS = {
    "customers": "csv", "accounts": "csv", "transactions": "json",
    "device_sessions": "json", "fraud_labels": "csv", "aml_watchlist": "csv",
}

PRIMARY_KEYS = {
    "customers": "customer_id", "accounts": "account_id", "transactions": "transaction_id",
    "device_sessions": "session_id", "fraud_labels": "transaction_id",
    "aml_watchlist": "watchlist_id",
}

KEY_FIELDS = {
    "customers": ["customer_id"],
    "accounts": ["account_id", "customer_id"],
    "transactions": ["transaction_id", "account_id", "customer_id", "session_id"],
    "device_sessions": ["session_id", "customer_id", "device_id"],
    "fraud_labels": ["transaction_id", "fraud_label"],
    "aml_watchlist": ["watchlist_id", "customer_id"],
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("accounts", "customer_id", "customers", "customer_id"),
    ("transactions", "account_id", "accounts", "account_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("transactions", "session_id", "device_sessions", "session_id"),
    ("device_sessions", "customer_id", "customers", "customer_id"),
    ("fraud_labels", "transaction_id", "transactions", "transaction_id"),
    ("aml_watchlist", "customer_id", "customers", "customer_id"),
]

# Fixed value domains.
DOMAINS = {
    ("customers", "kyc_status"): ["Verified", "Pending Review", "Enhanced Due Diligence"],
    ("customers", "sanctions_screening_status"): ["Clear", "Potential Match", "Escalated"],
    ("customers", "customer_risk_rating"): ["Low", "Medium", "High"],
    ("accounts", "account_type"): ["Current", "Savings", "Credit", "Business"],
    ("accounts", "account_status"): ["Active", "Dormant", "Restricted"],
    ("transactions", "transaction_status"): ["Approved", "Declined", "Reversed"],
    ("transactions", "transaction_type"): [
        "Card Purchase", "Bank Transfer", "Cash Withdrawal", "Direct Debit"],
    ("device_sessions", "device_type"): ["Mobile", "Desktop", "Tablet"],
    ("device_sessions", "session_risk_signal"): ["Low", "Medium", "Elevated"],
    ("fraud_labels", "fraud_label"): [0, 1],
    ("fraud_labels", "fraud_typology"): [
        "Not Fraud", "Account Takeover", "Card Not Present Fraud",
        "Synthetic Identity Pattern", "Mule Account Activity", "Unauthorized Transfer"],
    ("aml_watchlist", "alert_severity"): ["Low", "Medium", "High"],
    ("aml_watchlist", "review_status"): ["Open", "In Review", "Closed - No Issue", "Escalated"],
}

TIME_COLUMNS = {
    "customers": ["date_of_birth", "onboarding_date"],
    "accounts": ["account_open_date"],
    "transactions": ["transaction_timestamp"],
    "device_sessions": ["session_timestamp"],
    "aml_watchlist": ["created_date"],
}
