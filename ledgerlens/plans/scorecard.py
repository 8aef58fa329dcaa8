"""A linear scorecard with fixed weights.

A trained model cannot be repeated by a SQL oracle; this one can.  It has the same form as a
trained model (scaled numbers, one-hot levels), so scoring, thresholds, explanations and everything
downstream run through the same operators.
"""

from ..operators.model import LinearModel, fit_terms

# Fixed values.
NUMERIC = {
    "amount": 0.9,
    "amount_vs_customer_average": 0.2,
    "transaction_velocity_score": -0.15,
    "distinct_countries_customer_7d": 0.1,
    "country_mismatch_flag": 0.05,
    "is_night_transaction": -0.05,
}
CHANNEL = {"ATM": 0.2, "Branch": -0.1, "Mobile App": 0.05, "Online Banking": 0.1, "POS": -0.2}
INTERCEPT = -1.2


def scorecard(train) -> LinearModel:
    shape = fit_terms(train, [*NUMERIC, "channel"])
    weights = {f"numeric__{c}": w for c, w in NUMERIC.items()}
    weights |= {t.name: CHANNEL.get(t.level, 0.0) for t in shape.terms if t.level is not None}
    return shape.with_coefficients(weights, INTERCEPT)
