"""Fixed values of the data contract.

These must equal the contract's values for results to be right, so they are
stated here once, in their natural order, and used everywhere else.
"""

# --- fixed values: vocabularies ------------------------------------------- #
MERCHANT_CATEGORIES = (
    "grocery",
    "restaurant",
    "travel",
    "electronics",
    "fashion",
    "fuel",
    "entertainment",
    "health",
    "utilities",
    "cash_withdrawal",
    "online_services",
    "gambling",
)
CHANNELS = ("ONLINE", "POS", "ATM", "MOBILE")
COUNTRIES = ("PL", "DE", "FR", "ES", "IT", "NL", "SK", "GB", "US", "CZ", "UA", "CN")
CURRENCIES = ("CNY", "CZK", "EUR", "GBP", "PLN", "UAH", "USD")
HOME_COUNTRY = "PL"

# --- fixed values: exchange rates to PLN ---------------------------------- #
FX_RATES_TO_PLN = {
    "PLN": "1.00",
    "EUR": "4.30",
    "USD": "3.95",
    "GBP": "5.05",
    "CZK": "0.17",
    "UAH": "0.10",
    "CNY": "0.55",
}

# --- fixed values: record layouts ----------------------------------------- #
WIRE_FIELDS = (
    "transaction_id",
    "timestamp",
    "account_id",
    "amount",
    "currency",
    "merchant_category",
    "country",
    "channel",
    "device_id",
    "is_fraud_label",
)
BRONZE_COLUMNS = (
    "key",
    "value",
    "source_topic",
    "_partition",
    "_offset",
    "_kafka_timestamp",
    "data",
    "ingestion_time",
    "ingestion_date",
)
SILVER_COLUMNS = (
    "transaction_id",
    "event_time",
    "event_date",
    "account_id",
    "amount",
    "currency",
    "fx_rate_to_pln",
    "amount_pln",
    "merchant_category",
    "country",
    "channel",
    "device_id",
    "is_fraud_label",
    "ingestion_time",
    "_offset",
)
GOLD_TABLES = (
    "daily_volume_by_country",
    "merchant_category_kpi",
    "account_velocity",
    "fraud_signals",
    "scored_transactions",
)

# --- fixed values: bounds and thresholds ---------------------------------- #
AMOUNT_MIN_EXCLUSIVE = 0.0
AMOUNT_MAX_INCLUSIVE = 1_000_000.0
HIGH_AMOUNT_PLN = 5000.0
NIGHT_ENDS_HOUR = 6
NIGHT_STARTS_HOUR = 22
HIGH_RISK_CATEGORIES = ("cash_withdrawal", "gambling", "electronics", "online_services", "travel")
HORIZON_DAYS = 2
MAX_QUARANTINE_RATIO = 0.05
FRAUD_THRESHOLD = 0.5
PSI_BUCKETS = 10
PSI_EPSILON = 1e-6
PSI_STABLE_BELOW = 0.1
PSI_MODERATE_BELOW = 0.2
DRIFT_FEATURES = ("fraud_score", "amount_pln")
RETRAIN_BANDS = ("significant",)
MIN_LIVE_SAMPLES = 200
HOLDOUT_SHARE = 0.25

# --- fixed values: heuristic fraud model ---------------------------------- #
FEATURE_NAMES = (
    "log_amount_pln",
    "hour",
    "is_night",
    "is_online",
    "is_atm",
    "is_high_risk_category",
    "is_foreign",
)
HEURISTIC_INTERCEPT = -4.2
HEURISTIC_WEIGHTS = {
    "log_amount_pln": 0.25,
    "is_night": 0.4,
    "is_online": 1.0,
    "is_atm": 0.5,
    "is_high_risk_category": 1.3,
    "is_foreign": 0.9,
}

# --- fixed values: record of a trained model ------------------------------ #
MODEL_METADATA = """
    kind STRING, estimator STRING, feature_names ARRAY<STRING>, threshold DOUBLE, trained_at STRING,
    n_samples BIGINT, n_fraud BIGINT, roc_auc DOUBLE, pr_auc DOUBLE, heuristic_pr_auc DOUBLE,
    holdout_positive_rate DOUBLE, holdout_n BIGINT,
    reference_quantiles STRUCT<fraud_score: ARRAY<DOUBLE>, amount_pln: ARRAY<DOUBLE>>
"""
BOOSTING_ROUNDS = 100

# --- fixed values: quality report ----------------------------------------- #
QUALITY_COUNTERS = (
    "row_count",
    "quarantined_count",
    "duplicate_ids",
    "null_transaction_id",
    "null_account_id",
    "null_amount",
    "null_amount_pln",
)
QUALITY_CHECKS = (
    "no_null_transaction_id",
    "no_null_account_id",
    "no_null_amount",
    "no_null_amount_pln",
    "transaction_id_unique",
    "amount_within_bounds",
)
