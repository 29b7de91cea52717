"""Validation of the bronze layer by its two standard suites."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from txquality import schemas
from txquality.operators import expectations as ex
from txquality.plans.bronze import DELIVERY_COLUMN, deliveries, read_bronze_customers, read_bronze_transactions
from txquality.sources.files import if_present, read_csv_folder, union_all
from txquality.units import ATTEMPT_COLUMN, Units, tasks_for


def validate_transactions(df: DataFrame) -> DataFrame:
    return ex.run_suite(df, ex.TRANSACTION_SUITE_NAME, ex.TRANSACTION_SUITE)


def validate_customers(df: DataFrame) -> DataFrame:
    return ex.run_suite(df, ex.CUSTOMER_SUITE_NAME, ex.CUSTOMER_SUITE)


def validate(transactions: DataFrame | None, customers: DataFrame | None) -> DataFrame:
    """Results of both suites. Transactions must be there; customers may be absent."""
    if transactions is None:
        raise FileNotFoundError("no bronze transactions to validate")
    results = validate_transactions(transactions)
    return results if customers is None else union_all(results, validate_customers(customers))


def run_validation(spark: SparkSession, bronze_dir: str, as_csv: bool = False) -> DataFrame:
    """Results per check; see ``summarise`` and ``verdict`` for totals.

    ``as_csv`` reads a Bronze layer kept as folders of CSV files.
    """
    if as_csv:
        transactions = lambda: read_csv_folder(spark, f"{bronze_dir}/transactions", schemas.BRONZE_TRANSACTIONS)
        customers = lambda: read_csv_folder(spark, f"{bronze_dir}/customers", schemas.BRONZE_CUSTOMERS)
    else:
        transactions = lambda: read_bronze_transactions(spark, bronze_dir)
        customers = lambda: read_bronze_customers(spark, bronze_dir)
    return validate(if_present(transactions), if_present(customers))


WRITE_COLUMN = "_of_write"


def validate_deliveries(
    spark: SparkSession,
    bronze_dir: str,
    suite: str = ex.TRANSACTION_SUITE_NAME,
    checks: Sequence[ex.Check] = ex.TRANSACTION_SUITE,
) -> DataFrame:
    """Results of a suite over all deliveries; only those that are new or were replaced are scanned.

    The suite's counts for each delivery (and, for uniqueness, its rows by value) are
    kept beside Bronze with the write of the delivery that they were taken of. Counts
    add up, so the results are those of one scan of everything. Another list of
    checks keeps counts of its own.
    """
    data = deliveries(bronze_dir)
    delivered = data.current(spark)
    if not delivered:
        raise FileNotFoundError("no deliveries to validate")
    columns = data.read(spark, schemas.BRONZE_TRANSACTIONS, []).drop(DELIVERY_COLUMN)
    home = f"{bronze_dir}/validation/{hashlib.sha256(repr(tuple(checks)).encode()).hexdigest()[:16]}"
    counts = Units(f"{home}/counts", DELIVERY_COLUMN, together=True)
    values = Units(f"{home}/values", DELIVERY_COLUMN, together=True)

    by = [DELIVERY_COLUMN, WRITE_COLUMN]
    count_schema = ex.partial_counts(_empty(data, spark), checks, by).drop(DELIVERY_COLUMN).schema
    value_rows = ex.partial_values(_empty(data, spark), checks, by)
    value_schema = value_rows.drop(DELIVERY_COLUMN).schema if value_rows is not None else None

    # one row for each delivery
    kept = counts.current(spark)
    known = {r[0]: r[1] for r in counts.read(spark, count_schema).select(*by).collect()}
    empty = {unit for unit, (_, rows) in kept.items() if not rows}
    stale = sorted(u for u, (write, rows) in delivered.items() if known.get(u) != write and not (u in empty and not rows))
    if stale:
        rows = _of_writes(data, spark, stale)
        if value_rows is not None:
            tests = sum(check.kind == "unique" for check in checks)
            at_most = {unit: delivered[unit][1] * tests for unit in stale}
            values.replace_each(ex.partial_values(rows, checks, by), stale, at_most=at_most, spread=["test", "value"])
        # last, as the counts say which deliveries have been scanned
        counts.replace_each(ex.partial_counts(rows, checks, by), stale)
    found = None
    if value_rows is not None:
        # tasks by rows, as they are written: a value comes once from each delivery, so counting before the shuffle saves little
        held = sum(rows for _, rows in values.current(spark).values())
        found = values.read(spark, value_schema).repartition(tasks_for(held), "test", "value")
    return ex.merged_suite(columns, suite, checks, counts.read(spark, count_schema), found)


def _of_writes(data: Units, spark: SparkSession, units: Sequence[str]) -> DataFrame:
    rows = data.read(spark, schemas.BRONZE_TRANSACTIONS, units, with_attempt=True)
    return rows.withColumnRenamed(ATTEMPT_COLUMN, WRITE_COLUMN)


def _empty(data: Units, spark: SparkSession) -> DataFrame:
    return _of_writes(data, spark, [])
