"""Silver layer: valid transactions, newest version of each, in USD, merged by key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txquality import schemas
from txquality.functions import dates, money
from txquality.operators.dedup import newest_per_key
from txquality.operators.merge import merge
from txquality.session import require_utc
from txquality.sinks import publish, published, published_buckets

SILVER_TABLE = "silver_transactions"


def is_valid() -> Column:
    """Keys, amount and date present, amount positive, codes in their domains."""
    return (
        F.col("transaction_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("amount").isNotNull()
        & (F.col("amount") > 0)
        & F.col("currency").isin(*schemas.CURRENCIES)
        & F.col("status").isin(*schemas.STATUSES)
        & F.col("transaction_date").isNotNull()
    )


def valid_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(is_valid())


def newest_versions(valid: DataFrame) -> DataFrame:
    """Newest load wins, then the version created last.

    Runs after the validity filter: an invalid newer version must not displace
    a valid older one. A missing load time ranks as newest.
    """
    order = [F.col("_ingestion_timestamp").desc_nulls_first(), F.col("created_at").desc_nulls_last()]
    return newest_per_key(valid, [schemas.SILVER_KEY], order)


def enriched(newest: DataFrame, loaded_at: datetime) -> DataFrame:
    fee = money.fee_or_zero(F.col("fee_amount"))
    derived = {
        "amount_usd": money.to_usd(F.col("amount"), F.col("currency")),
        "fee_amount_clean": fee,
        "total_with_fees": F.col("amount") + fee,
        "is_completed": F.when(F.col("status") == "COMPLETED", True).otherwise(False),
        "is_failed": F.when(F.col("status").isin(*schemas.FAILED_STATUSES), True).otherwise(False),
        "transaction_day": dates.day_start("transaction_date"),
        "transaction_month": dates.month_start("transaction_date"),
        "settlement_days": dates.calendar_days("transaction_date", "settlement_date"),
        "_silver_loaded_at": F.lit(loaded_at),
        "_bronze_ingested_at": F.col("_ingestion_timestamp"),
    }
    return newest.select(
        *(derived.get(name, F.col(name)).alias(name) for name in schemas.SILVER_COLUMNS)
    )


# staging columns Silver does not keep, or derives again after the shuffle
NOT_SHUFFLED = (
    *schemas.TRANSACTION_FLAGS, "_pipeline_layer", "_pipeline_version", "_run_id",
    "transaction_day", "transaction_month",
)


def silver(staged: DataFrame, loaded_at: datetime) -> DataFrame:
    """Silver rows of a staged load. One shuffle, on the transaction id."""
    return enriched(newest_versions(valid_rows(staged.drop(*NOT_SHUFFLED))), loaded_at)


def run_silver(
    spark: SparkSession,
    staged: DataFrame,
    location: str,
    loaded_at: datetime,
    snapshot_id: str,
    table: str = SILVER_TABLE,
    buckets: int | None = None,
) -> DataFrame:
    """Merge a load into the Silver table and return the new snapshot.

    The first run creates the table. Keys absent from the load stay. The number
    of buckets is the table's: it is chosen at the first run (``buckets``, or the
    session's shuffle partitions; take the bytes expected in the table over a few
    hundred MB) and kept by all later ones. The load is shuffled by key for its
    newest versions, and its remaining rows once more only where the session's
    shuffle partitions are not the table's buckets, so the table itself is never
    shuffled.
    """
    require_utc(spark)
    load = silver(staged, loaded_at)
    current = published(spark, table, location)
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    session = int(initial or spark.conf.get("spark.sql.shuffle.partitions"))
    kept = published_buckets(spark, location)
    if kept and buckets and buckets != kept:
        raise ValueError(f"{table} has {kept} buckets; another number takes a rewrite of the table")
    buckets = kept or buckets or session
    if buckets != session:
        load = load.repartition(buckets, schemas.SILVER_KEY)
    rows = load if current is None else merge(current, load, schemas.SILVER_KEY, source_is_unique=True)
    return publish(rows, table, location, snapshot_id, schemas.SILVER_KEY, buckets)
