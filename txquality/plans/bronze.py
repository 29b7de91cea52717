"""Bronze layer: raw rows, parsed dates, fault flags and audit columns.

Every row of a delivery is kept; faults are flagged, not removed. Deliveries are
stored either as replacements (each is a whole export of its months) or side by
side under a delivery id; see ``run_bronze``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txquality import schemas
from txquality.functions import dates, quality
from txquality.operators.profile import dq_summary, issue_counts, observed_summary
from txquality.session import path_exists, require_utc
from txquality.sinks import write_partitioned, write_plain
from txquality.sources.files import customers_csv, if_present, transactions_csv, union_all
from txquality.units import Units

PARTITION_COLUMNS = ("partition_year", "partition_month")
DELIVERY_COLUMN = "_delivery_id"


def new_run() -> tuple[datetime, str]:
    """Ingestion time and run id, fixed once so that every task and rerun agrees."""
    now = datetime.now(timezone.utc)
    return now, f"{now.strftime('%Y%m%d_%H%M%S_%f')}_{uuid.uuid4().hex[:6]}"


def with_audit(df: DataFrame, source_file: str, ingested_at: datetime, run_id: str) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": F.lit(ingested_at),
            "_source_file": F.lit(source_file),
            "_pipeline_layer": F.lit(schemas.BRONZE_LAYER),
            "_pipeline_version": F.lit(schemas.PIPELINE_VERSION),
            "_run_id": F.lit(run_id),
        }
    )


def with_dates(raw: DataFrame) -> DataFrame:
    """Parsed timestamps and the calendar parts the table is partitioned by."""
    parsed = raw.withColumns(
        {
            f"{name}_ts": dates.timestamp_or_null(name)
            for name in ("transaction_date", "settlement_date", "created_at")
        }
    )
    return parsed.withColumns(dates.partition_parts("transaction_date_ts"))


def flag_transactions(raw: DataFrame) -> DataFrame:
    """Raw transactions with dates and seven flags, lazily and in one projection."""
    return with_dates(raw).withColumns(quality.transaction_flags())


def flag_customers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(quality.customer_flags())


def bronze_transactions(
    spark: SparkSession, path: str, ingested_at: datetime, run_id: str
) -> DataFrame:
    return with_audit(flag_transactions(transactions_csv(spark, path)), path, ingested_at, run_id)


def bronze_customers(
    spark: SparkSession, path: str, ingested_at: datetime, run_id: str
) -> DataFrame:
    return with_audit(flag_customers(customers_csv(spark, path)), path, ingested_at, run_id)


def deliveries(bronze_dir: str) -> Units:
    """Transactions kept delivery by delivery."""
    return Units(f"{bronze_dir}/transactions", DELIVERY_COLUMN)


def read_bronze_transactions(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """All stored rows, of every delivery; the delivery id is left out."""
    return _stored_transactions(spark, bronze_dir).select(*schemas.BRONZE_TRANSACTIONS.fieldNames())


def read_deliveries(spark: SparkSession, bronze_dir: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Rows of the deliveries (all by default) as last delivered, with their id as it was given."""
    return deliveries(bronze_dir).read(spark, schemas.BRONZE_TRANSACTIONS, ids)


def _stored_transactions(spark: SparkSession, bronze_dir: str) -> DataFrame:
    if deliveries(bronze_dir).entries(spark) is not None:
        return read_deliveries(spark, bronze_dir)
    return spark.read.schema(schemas.BRONZE_TRANSACTIONS).parquet(f"{bronze_dir}/transactions")


def read_bronze_customers(spark: SparkSession, bronze_dir: str) -> DataFrame:
    return spark.read.schema(schemas.BRONZE_CUSTOMERS).parquet(f"{bronze_dir}/customers")


def refuse_other_layout(spark: SparkSession, bronze_dir: str, delivery_id: str | None) -> None:
    units = deliveries(bronze_dir)
    by_delivery = path_exists(spark, units.manifest)
    if by_delivery != (delivery_id is not None) and path_exists(spark, units.root):
        raise ValueError("this Bronze folder is filled the other way: whole exports, or deliveries with an id")


def run_bronze(
    spark: SparkSession,
    source_dir: str,
    bronze_dir: str,
    ingested_at: datetime | None = None,
    run_id: str | None = None,
    rebalance: bool = True,
    delivery_id: str | None = None,
) -> DataFrame | None:
    """Ingest both entities and return their summaries; an absent file is skipped.

    Without a ``delivery_id`` the source is taken as a whole export: each month
    it has rows of (and the rows without a date) replaces what is stored of that
    month. With one, its rows are stored beside all others, and delivering it
    again replaces all of them, whatever months it had or has; Silver's
    newest-version rule takes care of rows that come in more than one delivery. A
    Bronze folder is filled in one way or the other. ``rebalance=False`` saves the
    shuffle by month where files come laid out by date.

    Source text is parsed once, by the write, which also counts the rows of a whole
    export's summary. A delivery's summary is read as its readers will see it: two
    small columns of its own folder.
    """
    require_utc(spark)
    if delivery_id is not None and not re.fullmatch(r"\w[\w.-]*", delivery_id):
        raise ValueError("a delivery id holds letters, digits, dots, dashes and underscores only")
    now, now_id = new_run()
    ingested_at, run_id = ingested_at or now, run_id or now_id
    summaries = []

    path = f"{source_dir}/transactions.csv"
    transactions = if_present(lambda: bronze_transactions(spark, path, ingested_at, run_id))
    if transactions is not None:
        refuse_other_layout(spark, bronze_dir, delivery_id)
        if delivery_id is None:
            seen = Observation()
            write_partitioned(transactions, f"{bronze_dir}/transactions", PARTITION_COLUMNS, rebalance, (seen, issue_counts()))
            summaries.append(observed_summary(spark, seen.get, "Transactions"))
        else:
            deliveries(bronze_dir).replace(transactions, delivery_id, PARTITION_COLUMNS, rebalance)
            own = read_deliveries(spark, bronze_dir, [delivery_id])
            summaries.append(dq_summary(own.filter(F.col(DELIVERY_COLUMN) == delivery_id), "Transactions"))

    customer_path = f"{source_dir}/customers.csv"
    customers = if_present(lambda: bronze_customers(spark, customer_path, ingested_at, run_id))
    if customers is not None:
        seen = Observation()
        write_plain(customers, f"{bronze_dir}/customers", (seen, issue_counts()))
        summaries.append(observed_summary(spark, seen.get, "Customers"))

    return union_all(*summaries) if summaries else None
