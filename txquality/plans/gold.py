"""Gold layer: daily aggregate of Silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality import schemas
from txquality.functions.money import ratio
from txquality.sinks import publish

GOLD_TABLE = "gold_daily_transactions"


def gold(silver_rows: DataFrame, loaded_at: datetime) -> DataFrame:
    """Counts, amounts and rates per day, currency, type, status and source.

    Sums are partial before the shuffle, so rows sent per task are bounded by
    the groups it saw, however large a group is.
    """
    rows = F.count(F.lit(1))
    completed = F.count_if(F.col("is_completed"))
    return silver_rows.groupBy(*schemas.GOLD_KEYS).agg(
        rows.alias("total_transactions"),
        completed.alias("completed_count"),
        F.count_if(F.col("is_failed")).alias("failed_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.sum("amount_usd").alias("total_amount_usd"),
        F.sum("fee_amount_clean").alias("total_fees"),
        ratio(completed, rows).alias("success_rate"),
        F.avg("settlement_days").alias("avg_settlement_days"),
        F.lit(loaded_at).alias("_gold_loaded_at"),
    )


def run_gold(
    silver_rows: DataFrame,
    location: str,
    loaded_at: datetime,
    snapshot_id: str,
    table: str = GOLD_TABLE,
) -> DataFrame:
    """Replace the Gold table by the aggregate of the current Silver table."""
    return publish(gold(silver_rows, loaded_at), table, location, snapshot_id)
