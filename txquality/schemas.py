"""Fixed schemas, value domains and exchange rates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T


def _nullable(strings_and_types: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in strings_and_types])


# --- Fixed values: column names and types of the two raw entities -----------
TRANSACTION_COLUMNS = (
    "transaction_id", "customer_id", "transaction_type", "amount", "currency",
    "status", "counterparty", "reference_number", "transaction_date",
    "settlement_date", "description", "fee_amount", "fee_currency",
    "source_system", "batch_id", "created_at", "updated_at",
)
TRANSACTION_DOUBLES = ("amount", "fee_amount")
CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "country_code",
    "account_type", "risk_rating", "created_at", "is_active",
)

TRANSACTIONS = _nullable(
    [
        (name, T.DoubleType() if name in TRANSACTION_DOUBLES else T.StringType())
        for name in TRANSACTION_COLUMNS
    ]
)
CUSTOMERS = _nullable([(name, T.StringType()) for name in CUSTOMER_COLUMNS])

_AUDIT = [
    ("_ingestion_timestamp", T.TimestampType()),
    ("_source_file", T.StringType()),
    ("_pipeline_layer", T.StringType()),
    ("_pipeline_version", T.StringType()),
    ("_run_id", T.StringType()),
]

TRANSACTION_FLAGS = (
    "dq_null_transaction_id", "dq_null_customer_id", "dq_null_amount",
    "dq_negative_amount", "dq_invalid_currency", "dq_invalid_status",
    "dq_has_issues",
)
CUSTOMER_FLAGS = ("dq_null_customer_id", "dq_null_email", "dq_has_issues")

BRONZE_TRANSACTIONS = _nullable(
    [(f.name, f.dataType) for f in TRANSACTIONS]
    + [
        ("transaction_date_ts", T.TimestampType()),
        ("settlement_date_ts", T.TimestampType()),
        ("created_at_ts", T.TimestampType()),
        ("partition_year", T.IntegerType()),
        ("partition_month", T.IntegerType()),
        ("partition_day", T.IntegerType()),
    ]
    + [(name, T.BooleanType()) for name in TRANSACTION_FLAGS]
    + _AUDIT
)
BRONZE_CUSTOMERS = _nullable(
    [(f.name, f.dataType) for f in CUSTOMERS]
    + [(name, T.BooleanType()) for name in CUSTOMER_FLAGS]
    + _AUDIT
)

# --- Fixed values: domains --------------------------------------------------
CURRENCIES = ("USD", "GBP", "EUR", "JPY", "CHF", "AUD", "CAD", "HKD")
STATUSES = ("COMPLETED", "PENDING", "FAILED", "CANCELLED", "PROCESSING")
TRANSACTION_TYPES = (
    "PAYMENT", "TRANSFER", "WITHDRAWAL", "DEPOSIT", "FX_TRADE", "SETTLEMENT",
)
ACCOUNT_TYPES = ("RETAIL", "INSTITUTIONAL", "PRIVATE_BANKING")
RISK_RATINGS = ("LOW", "MEDIUM", "HIGH")
FAILED_STATUSES = ("FAILED", "CANCELLED")

# --- Fixed values: units of USD per unit of currency (exact decimals) -------
FX_TO_USD = {
    "USD": Decimal("1"),
    "GBP": Decimal("1.27"),
    "EUR": Decimal("1.08"),
    "JPY": Decimal("0.0067"),
    "CHF": Decimal("1.11"),
    "AUD": Decimal("0.65"),
    "CAD": Decimal("0.74"),
    "HKD": Decimal("0.13"),
}

# --- Fixed values: audit constants of the bronze layer ----------------------
BRONZE_LAYER = "bronze"
PIPELINE_VERSION = "1.0.0"

# --- Fixed values: cell texts that mean NULL --------------------------------
# raw table load
LOAD_NULL_TOKENS = ("", "NULL", "None", "nan")
# folder read for validation: the default missing-value texts of a data-frame CSV reader
FRAME_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- Fixed values: column orders of Silver and keys of Gold ----------------------------------------------------
SILVER_KEY = "transaction_id"
SILVER_COLUMNS = (
    "transaction_id", "customer_id", "transaction_type", "amount", "currency",
    "status", "counterparty", "reference_number", "source_system", "batch_id",
    "fee_amount", "fee_currency", "amount_usd", "fee_amount_clean",
    "total_with_fees", "is_completed", "is_failed", "transaction_date",
    "settlement_date", "created_at", "transaction_day", "transaction_month",
    "settlement_days", "_silver_loaded_at", "_bronze_ingested_at",
)
GOLD_KEYS = (
    "transaction_day", "transaction_month", "currency", "transaction_type",
    "status", "source_system",
)
