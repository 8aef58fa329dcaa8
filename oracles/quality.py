"""Oracle SQL for sources, sinks and data validation."""

from .base import sql
from .rules import ALERTS, SUMMARY

# Columns of the six tables.
COLUMNS = {
    "customers": [
        "customer_id", "first_name", "last_name", "date_of_birth", "age_band", "country",
        "customer_segment", "employment_status", "annual_income_band", "onboarding_date",
        "kyc_status", "pep_flag", "sanctions_screening_status", "customer_risk_rating",
    ],
    "accounts": [
        "account_id", "customer_id", "account_type", "account_open_date", "account_status",
        "currency", "branch_region", "average_monthly_balance_band",
    ],
    "transactions": [
        "transaction_id", "account_id", "customer_id", "transaction_timestamp", "transaction_type",
        "channel", "merchant_category", "merchant_country", "amount", "currency",
        "is_cross_border", "transaction_status", "device_id", "session_id",
    ],
    "device_sessions": [
        "session_id", "customer_id", "device_id", "session_timestamp", "ip_country", "device_type",
        "operating_system", "login_success", "authentication_method", "session_risk_signal",
    ],
    "fraud_labels": [
        "transaction_id", "fraud_label", "fraud_typology", "label_confidence", "label_source",
    ],
    "aml_watchlist": [
        "watchlist_id", "customer_id", "watchlist_type", "alert_reason", "alert_severity",
        "created_date", "review_status",
    ],
}
KEYS = {
    "customers": ["customer_id"], "accounts": ["account_id", "customer_id"],
    "transactions": ["transaction_id", "account_id", "customer_id", "session_id"],
    "device_sessions": ["session_id", "customer_id", "device_id"],
    "fraud_labels": ["transaction_id", "fraud_label"], "aml_watchlist": ["watchlist_id", "customer_id"],
    "doc_quality": ["doc_id", "quality"],
}
PRIMARY = {"customers": "customer_id", "accounts": "account_id", "transactions": "transaction_id",
           "device_sessions": "session_id", "fraud_labels": "transaction_id",
           "aml_watchlist": "watchlist_id", "lineitem": "l_orderkey"}
FOREIGN = [
    ("accounts", "customer_id", "customers", "customer_id"),
    ("transactions", "account_id", "accounts", "account_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("transactions", "session_id", "device_sessions", "session_id"),
    ("device_sessions", "customer_id", "customers", "customer_id"),
    ("fraud_labels", "transaction_id", "transactions", "transaction_id"),
    ("aml_watchlist", "customer_id", "customers", "customer_id"),
    ("transactions", "device_id", "device_sessions", "device_id"),
]
TIMES = {"customers": ["date_of_birth", "onboarding_date"], "accounts": ["account_open_date"],
         "transactions": ["transaction_timestamp"], "device_sessions": ["session_timestamp"],
         "aml_watchlist": ["created_date"], "events": ["ts", "props"]}
DOMAINS = {
    ("customers", "kyc_status"): ["Verified", "Pending Review", "Enhanced Due Diligence"],
    ("customers", "sanctions_screening_status"): ["Clear", "Potential Match", "Escalated"],
    ("customers", "customer_risk_rating"): ["Low", "Medium", "High"],
    ("accounts", "account_type"): ["Current", "Savings", "Credit", "Business"],
    ("accounts", "account_status"): ["Active", "Dormant", "Restricted"],
    ("transactions", "transaction_status"): ["Approved", "Declined", "Reversed"],
    ("transactions", "transaction_type"): ["Card Purchase", "Bank Transfer", "Cash Withdrawal", "Direct Debit"],
    ("device_sessions", "device_type"): ["Mobile", "Desktop", "Tablet"],
    ("device_sessions", "session_risk_signal"): ["Low", "Medium", "Elevated"],
    ("fraud_labels", "fraud_label"): ["0", "1"],
    ("fraud_labels", "fraud_typology"): ["Not Fraud", "Account Takeover", "Card Not Present Fraud",
                                         "Synthetic Identity Pattern", "Mule Account Activity", "Unauthorized Transfer"],
    ("aml_watchlist", "alert_severity"): ["Low", "Medium", "High"],
    ("aml_watchlist", "review_status"): ["Open", "In Review", "Closed - No Issue", "Escalated"],
    ("transactions", "channel"): ["ATM", "POS"],
}


def _check(name, dataset, passed, good, bad, category):
    return (f"SELECT '{name}' AS name, '{dataset}' AS dataset, CASE WHEN {passed} THEN 'passed' ELSE 'failed' END AS status, "
            f"'critical' AS severity, CASE WHEN {passed} THEN '{good}' ELSE {bad} END AS message, '{category}' AS category")


def _union(parts):
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def _required(name):
    return _check("required_columns", name, "TRUE", "All required columns are present.", "''", "schema")


def _nulls(name, label=None):
    counts = ", ".join(f"COUNT(*) FILTER ({k} IS NULL) AS {k}" for k in KEYS[name])
    texts = ", ".join("CASE WHEN %s > 0 THEN '''%s'': ' || %s END" % (k, k, k) for k in KEYS[name])
    none = " AND ".join(f"{k} = 0" for k in KEYS[name])
    return _check("key_field_nulls", label or name, none, "No null values found in key fields.",
                  f"'Null values found in key fields: {{' || concat_ws(', ', {texts}) || '}}'",
                  "completeness") + f" FROM (SELECT {counts} FROM {name})"


def _duplicates(name):
    key = PRIMARY[name]
    return _check("duplicate_primary_key", name, "n = 0", "Primary key values are unique.",
                  "'Found ' || n || ' duplicate primary key values.'", "uniqueness") + \
        f" FROM (SELECT COUNT(*) - COUNT(DISTINCT {key}) AS n FROM {name})"


def _foreign(child, column, parent, parent_column):
    return _check(f"{column}_references_{parent}", child, "n = 0",
                  f"{child}.{column} values all exist in {parent}.{parent_column}.",
                  "'Found ' || n || ' invalid references. Examples: [''' || array_to_string(list_slice(v, 1, 5), ''', ''') || ''']'",
                  "relationship") + f""" FROM (SELECT COUNT(*) AS n, list_sort(list(v)) AS v FROM (
                SELECT DISTINCT CAST({column} AS VARCHAR) AS v FROM {child} WHERE {column} IS NOT NULL
                EXCEPT SELECT CAST({parent_column} AS VARCHAR) FROM {parent}))"""


def _amounts(source, label):
    return "SELECT *, '%s' AS source FROM (%s FROM (SELECT COUNT(*) FILTER (amount IS NULL OR amount <= 0) AS n FROM %s))" % (
        label, _check("transaction_amount_positive", "transactions", "n = 0",
                      "All transaction amounts are numeric and positive.",
                      "'Found ' || n || ' transactions with invalid amounts.'", "validity"), source)


def _times(name):
    return [_check(f"{c}_timestamp_parseable", name, "n = 0", f"All values in {c} are parseable.",
                   f"'Found ' || n || ' unparseable values in {c}.'", "validity")
            + f" FROM (SELECT COUNT(*) FILTER (TRY_CAST(CAST({c} AS VARCHAR) AS TIMESTAMP) IS NULL) AS n FROM {name})"
            for c in TIMES[name]]


def _domain(table, column):
    allowed = ", ".join(f"'{v}'" for v in DOMAINS[table, column])
    return _check(f"{column}_allowed_values", table, "n = 0", f"All values in {column} are within the expected domain.",
                  f"'Unexpected values in {column}: [''' || array_to_string(v, ''', ''') || ''']'", "validity") + \
        f""" FROM (SELECT COUNT(*) AS n, list_sort(list(v)) AS v FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS v
             FROM {table} WHERE {column} IS NOT NULL AND CAST({column} AS VARCHAR) NOT IN ({allowed})))"""


def _unexpected(table, column):
    allowed = ", ".join(f"'{v}'" for v in DOMAINS[table, column])
    return f"""SELECT '{table}' AS dataset, '{column}' AS "column", CAST({column} AS VARCHAR) AS value, COUNT(*) AS "rows"
        FROM {table} WHERE {column} IS NOT NULL AND CAST({column} AS VARCHAR) NOT IN ({allowed}) GROUP BY ALL"""


DOC_QUALITY = "\ndoc_quality AS (SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id))"
_TABLES = list(COLUMNS)
_REPORT = []
for _t in _TABLES:
    _REPORT += [_required(_t), _nulls(_t), _duplicates(_t)]
    _REPORT += _times(_t) if _t in TIMES else []
    _REPORT += [_domain(*k) for k in DOMAINS if k[0] == _t and k[1] != "channel"]
_REPORT += [_foreign(*f) for f in FOREIGN[:7]]
_REPORT.append("SELECT * EXCLUDE (source) FROM (" + _amounts("transactions", "events") + ")")


def _text_ids(columns, ids, times=()):
    out = []
    for c in columns:
        if c in ids:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c in times:
            out.append(f"strftime({c}, '{times[c]}') AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS dataset, COUNT(*) AS rows FROM {t}" for t in _TABLES)

SQL = {
    "io_scan_csv": sql(select="SELECT " + _text_ids(COLUMNS["accounts"], {"account_id", "customer_id"},
                                                    {"account_open_date": "%Y-%m-%d"}) + ", 'n' AS branch_note FROM accounts"),
    "io_scan_jsonl": sql(select="SELECT " + _text_ids(
        COLUMNS["transactions"], {"transaction_id", "account_id", "customer_id", "device_id", "session_id"},
        {"transaction_timestamp": "%Y-%m-%d %H:%M:%S.%f"}) + " FROM transactions"),
    "io_normalise_columns": sql(select="SELECT " + _text_ids(COLUMNS["fraud_labels"], {"transaction_id"}) + ", 'x' AS extra FROM fraud_labels"),
    "io_load_all": sql(select=_COUNTS),
    "io_require_inputs": sql(ALERTS, select="""SELECT 'transaction_features' AS dataset, COUNT(*) AS rows FROM transactions
        UNION ALL SELECT 'aml_alerts', COUNT(*) FROM alerts"""),
    "io_sink_csv": sql(SUMMARY, select="SELECT * FROM aml_summary"),
    "io_sink_jsonl": sql(ALERTS, select="""SELECT transaction_id, MIN(customer_id) AS customer_id, COUNT(*) AS alerts,
        CAST(SUM(risk_points) AS BIGINT) AS points, MIN(rule_id) AS first_rule FROM alerts GROUP BY transaction_id"""),
    "dq_required_columns": sql(select=_union([_required(t) for t in _TABLES] + [
        _check("required_columns", "accounts_file", "FALSE", "", "'Missing required columns: [''currency'']'", "schema"),
        _check("required_columns", "events", "FALSE", "",
               "'Missing required columns: [''transaction_timestamp'']'", "schema")])),
    "dq_key_nulls": sql(DOC_QUALITY, select=_union([_nulls(t) for t in _TABLES] + [_nulls("doc_quality", "documents")])),
    "dq_duplicate_pk": sql(select=_union([_duplicates(t) for t in PRIMARY])),
    "dq_foreign_key": sql(select=_union([_foreign(*f) for f in FOREIGN])),
    "dq_positive_amount": sql("\nbalances AS (SELECT c_acctbal AS amount FROM customer)", select=_union(
        [_amounts("transactions", "events"), _amounts("balances", "balances")])),
    "dq_timestamp_parse": sql(select=_union([c for t in TIMES for c in _times(t)])),
    "dq_allowed_values": sql(select=_union([_domain(*k) for k in DOMAINS])),
    "dq_unexpected_values": sql(select=_union([_unexpected(*k) for k in DOMAINS])),
    "dq_report": sql(select=f"SELECT status, severity, category, COUNT(*) AS checks FROM ({_union(_REPORT)}) GROUP BY ALL"),
    "dq_gate": sql(select=f"""SELECT CASE WHEN COUNT(*) FILTER (status = 'failed') > 0 THEN 'failed' ELSE 'passed' END AS overall_status,
        COUNT(*) FILTER (status = 'passed') AS passed_checks, COUNT(*) FILTER (status = 'failed') AS failed_checks,
        0 AS warnings, COUNT(*) FILTER (category = 'relationship') AS relationship_checks FROM ({_union(_REPORT)})"""),
    "dq_cardinality_join": sql(select="""SELECT transaction_id, t.customer_id, country FROM transactions t
        LEFT JOIN customers c ON c.customer_id = t.customer_id"""),
    "dq_dedup_lookup": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) = 1""",
}
