"""The customer relation: types, domains and the business constants."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, categories and constants every result depends on.
# ---------------------------------------------------------------------------

# Header of the raw CSV -> column of the customer relation.
COLUMN_MAP = {
    "customerID": "customer_id",
    "gender": "gender",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "tenure": "tenure_months",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "Contract": "contract_type",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "Churn": "churn",
}

YES_NO_COLUMNS = ["partner", "dependents", "phone_service", "paperless_billing", "churn"]

_LINES = ["Yes", "No", "No phone service"]
_ADD_ON = ["Yes", "No", "No internet service"]

# Allowed categories of each text column.
DOMAINS = {
    "gender": ["Male", "Female"],
    "multiple_lines": _LINES,
    "internet_service": ["DSL", "Fiber optic", "No"],
    "online_security": _ADD_ON,
    "online_backup": _ADD_ON,
    "device_protection": _ADD_ON,
    "tech_support": _ADD_ON,
    "streaming_tv": _ADD_ON,
    "streaming_movies": _ADD_ON,
    "contract_type": ["Month-to-month", "One year", "Two year"],
    "payment_method": [
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ],
}
TEXT_COLUMNS = list(DOMAINS)

# Longest text each column may hold.
MAX_LENGTHS = {
    "customer_id": 20,
    "gender": 10,
    "multiple_lines": 20,
    "internet_service": 20,
    "online_security": 20,
    "online_backup": 20,
    "device_protection": 20,
    "tech_support": 20,
    "streaming_tv": 20,
    "streaming_movies": 20,
    "contract_type": 20,
    "payment_method": 30,
}

REQUIRED_COLUMNS = [
    "customer_id",
    "gender",
    "senior_citizen",
    "partner",
    "dependents",
    "tenure_months",
    "phone_service",
    "contract_type",
    "paperless_billing",
    "payment_method",
    "monthly_charges",
    "churn",
]
NON_NEGATIVE_COLUMNS = ["tenure_months", "monthly_charges", "total_charges"]
NUMBER_TYPES = {"tenure_months": "int", "monthly_charges": "decimal(8,2)", "total_charges": "decimal(10,2)"}
NUMBER_COLUMNS = list(NUMBER_TYPES)

# Add-on services counted by service_count, and the four whose churn effect is reported.
SERVICE_ADD_ONS = [
    "multiple_lines",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
]
PROTECTIVE_ADD_ONS = ["online_security", "tech_support", "online_backup", "device_protection"]

AUTOPAY_METHODS = ["Bank transfer (automatic)", "Credit card (automatic)"]
ANNUAL_CONTRACTS = ["One year", "Two year"]

# Upper edges (inclusive) of the tenure buckets; above the last one: TENURE_TOP.
TENURE_BUCKETS = [(12, "0-12 months"), (24, "13-24 months"), (48, "25-48 months")]
TENURE_TOP = "49+ months"
REVENUE_LABELS = ["Low", "Medium", "High"]

# Model input columns.
CATEGORICAL_FEATURES = [
    "gender",
    "multiple_lines",
    "internet_service",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
    "contract_type",
    "payment_method",
    "tenure_group",
    "revenue_category",
]
BOOLEAN_FEATURES = [
    "senior_citizen",
    "partner",
    "dependents",
    "phone_service",
    "paperless_billing",
    "high_value_customer",
    "premium_customer",
    "autopay_customer",
]
NUMERIC_FEATURES = ["tenure_months", "monthly_charges", "total_charges", "service_count"]

# Retention economics: offer cost, share of churners an offer saves, months of value.
OFFER_COST = Decimal("20")
OFFER_SUCCESS_RATE = Decimal("0.25")
EXPECTED_MONTHS = 12

# Candidate thresholds are i / 100 for i in this inclusive range.
GRID_FIRST, GRID_LAST = 5, 95
# No probability reaches this threshold, so nobody is flagged.
NOBODY_FLAGGED = 1.01

RECOMMENDATION_COLUMNS = [
    "customer_id",
    "churn_probability",
    "monthly_charges",
    "clv",
    "revenue_at_risk",
    "retention_offer_cost",
    "expected_net_benefit",
    "recommended_action",
]

# Texts a CSV reader takes for a missing value.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Characters stripped from both ends of a text (all Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# ---------------------------------------------------------------------------
# Typed schemas
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(8, 2)
BILLED = T.DecimalType(10, 2)

_TYPES = {
    **{c: T.StringType() for c in COLUMN_MAP.values()},
    **{c: T.BooleanType() for c in ["senior_citizen", *YES_NO_COLUMNS]},
    "tenure_months": T.IntegerType(),
    "monthly_charges": MONEY,
    "total_charges": BILLED,
}

CUSTOMER_COLUMNS = list(COLUMN_MAP.values())

CUSTOMERS_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES[c], c not in REQUIRED_COLUMNS) for c in CUSTOMER_COLUMNS]
)

FEATURES_SCHEMA = T.StructType(
    CUSTOMERS_SCHEMA.fields
    + [
        T.StructField("tenure_group", T.StringType()),
        T.StructField("service_count", T.IntegerType()),
        T.StructField("high_value_customer", T.BooleanType()),
        T.StructField("premium_customer", T.BooleanType()),
        T.StructField("autopay_customer", T.BooleanType()),
        T.StructField("revenue_category", T.StringType()),
    ]
)

RECOMMENDATIONS_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("monthly_charges", MONEY),
        T.StructField("clv", T.DecimalType(12, 2)),
        T.StructField("revenue_at_risk", T.DoubleType()),
        T.StructField("retention_offer_cost", T.DoubleType()),
        T.StructField("expected_net_benefit", T.DoubleType()),
        T.StructField("recommended_action", T.StringType()),
    ]
)
