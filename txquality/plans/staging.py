"""Staging view: typed and normalised transactions, 28 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality import schemas
from txquality.functions import dates, money, text
from txquality.sinks import as_view

STAGING_VIEW = "stg_transactions"


def staging(bronze: DataFrame) -> DataFrame:
    columns = {
        "transaction_id": F.col("transaction_id"),
        "customer_id": F.col("customer_id"),
        "transaction_type": text.code("transaction_type"),
        "amount": money.as_amount("amount"),
        "currency": text.code("currency"),
        "status": text.code("status"),
        "counterparty": text.code("counterparty"),
        "reference_number": text.trimmed("reference_number"),
        "source_system": text.code("source_system"),
        "batch_id": text.trimmed("batch_id"),
        "fee_amount": money.as_fee("fee_amount"),
        "fee_currency": text.code("fee_currency"),
        "transaction_date": F.col("transaction_date_ts"),
        "settlement_date": F.col("settlement_date_ts"),
        "created_at": F.col("created_at_ts"),
        "transaction_day": dates.day_start("transaction_date_ts"),
        "transaction_month": dates.month_start("transaction_date_ts"),
    }
    columns |= {name: F.col(name) for name in schemas.TRANSACTION_FLAGS}
    columns |= {
        name: F.col(name)
        for name in ("_ingestion_timestamp", "_pipeline_layer", "_pipeline_version", "_run_id")
    }
    return bronze.select(*(column.alias(name) for name, column in columns.items()))


def staging_view(bronze: DataFrame, name: str = STAGING_VIEW) -> DataFrame:
    return as_view(staging(bronze), name)
