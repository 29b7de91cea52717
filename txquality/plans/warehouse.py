"""Raw tables to tested Silver and Gold tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txquality import schemas
from txquality.operators.table_tests import run_table_tests
from txquality.plans.bronze import new_run
from txquality.plans.gold import GOLD_TABLE, run_gold
from txquality.plans.silver import SILVER_TABLE, run_silver
from txquality.plans.staging import STAGING_VIEW, staging_view
from txquality.session import require_utc
from txquality.sinks import has_snapshot, is_current, published
from txquality.sources.files import if_present, row_count, union_all
from txquality.sources.raw_load import load_table, raw_table


@dataclass(frozen=True)
class Names:
    """Names the layers get in the session's catalog."""

    staging: str = STAGING_VIEW
    silver: str = SILVER_TABLE
    gold: str = GOLD_TABLE


@dataclass(frozen=True)
class Refined:
    silver: DataFrame
    gold: DataFrame
    tests: DataFrame


def run_raw_load(
    spark: SparkSession, csv_dir: str, raw_dir: str, load_id: str, pattern: str = "*.csv", multi_line: bool = False
) -> DataFrame:
    """Load both entities' CSV files into raw tables, each file once; report per file of this load."""
    return union_all(
        *(
            load_table(spark, f"{csv_dir}/{name}", schema, f"{raw_dir}/{name}", load_id, pattern, multi_line, once=True)
            for name, schema in (("transactions", schemas.BRONZE_TRANSACTIONS), ("customers", schemas.BRONZE_CUSTOMERS))
        )
    )


def verify_load(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """Rows in each raw table there is."""
    counts = []
    for name, schema in (
        ("transactions", schemas.BRONZE_TRANSACTIONS),
        ("customers", schemas.BRONZE_CUSTOMERS),
    ):
        rows = if_present(lambda: raw_table(spark, f"{raw_dir}/{name}", schema))
        if rows is not None:
            counts.append(row_count(rows).select(F.lit(name).alias("table_name"), "row_count"))
    return union_all(*counts) if counts else None


def raw_tables(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        raw_table(spark, f"{raw_dir}/transactions", schemas.BRONZE_TRANSACTIONS),
        raw_table(spark, f"{raw_dir}/customers", schemas.BRONZE_CUSTOMERS),
    )


def _resumed_silver(
    spark: SparkSession, silver_dir: str, gold_dir: str, snapshot_id: str, names: Names
) -> DataFrame | None:
    if not is_current(spark, silver_dir, snapshot_id) or has_snapshot(spark, gold_dir, snapshot_id):
        return None
    return published(spark, names.silver, silver_dir)


def run_refinement(
    spark: SparkSession,
    raw_transactions: DataFrame,
    raw_customers: DataFrame,
    warehouse_dir: str,
    loaded_at: datetime | None = None,
    snapshot_id: str | None = None,
    names: Names = Names(),
) -> Refined:
    """Staging view, Silver merge, Gold replacement, then the table tests.

    Run again with the snapshot id of a run whose Silver step had succeeded, it
    goes on with Gold from that snapshot, which must be Silver's current one.
    """
    require_utc(spark)
    now, now_id = new_run()
    loaded_at, snapshot_id = loaded_at or now, snapshot_id or now_id
    staged = staging_view(raw_transactions, names.staging)
    silver = _resumed_silver(spark, f"{warehouse_dir}/silver", f"{warehouse_dir}/gold", snapshot_id, names)
    if silver is None:
        silver = run_silver(spark, staged, f"{warehouse_dir}/silver", loaded_at, snapshot_id, names.silver)
    gold = run_gold(silver, f"{warehouse_dir}/gold", loaded_at, snapshot_id, names.gold)
    tests = run_table_tests(
        {
            "raw.transactions": raw_transactions,
            "raw.customers": raw_customers,
            "silver.transactions": silver,
        }
    )
    return Refined(silver, gold, tests)
