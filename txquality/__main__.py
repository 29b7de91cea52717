"""The layers as jobs, for spark-submit or ``python -m txquality``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from txquality.operators.expectations import CUSTOMER_SUITE, TRANSACTION_SUITE, summarise
from txquality.operators.table_tests import STANDARD_TESTS
from txquality.plans.bronze import read_bronze_customers, read_bronze_transactions, run_bronze
from txquality.plans.validation import run_validation
from txquality.plans.warehouse import raw_tables, run_raw_load, run_refinement, verify_load
from txquality.session import build_session, clear_scratch


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="txquality")
    parser.add_argument("--master", help="default: as the submit command says")
    jobs = parser.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze", help="ingest transactions.csv and customers.csv")
    bronze.add_argument("--source-dir", required=True)
    bronze.add_argument("--bronze-dir", required=True)
    bronze.add_argument("--delivery-id", help="keep this delivery beside all others; without it, a whole export replaces its months")

    validate = jobs.add_parser("validate", help="run both suites; status 1 if a check fails")
    validate.add_argument("--bronze-dir", required=True)
    validate.add_argument("--csv", action="store_true", help="Bronze is kept as CSV folders")

    load = jobs.add_parser("load", help="load folders of CSV files into raw tables")
    load.add_argument("--csv-dir", required=True)
    load.add_argument("--raw-dir", required=True)
    load.add_argument("--load-id", required=True)

    refine = jobs.add_parser("refine", help="staging, Silver, Gold and table tests; status 1 if a test fails")
    source = refine.add_mutually_exclusive_group(required=True)
    source.add_argument("--bronze-dir")
    source.add_argument("--raw-dir", help="tables made by the load job, instead of Bronze")
    refine.add_argument("--warehouse-dir", required=True)
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> int:
    args = _arguments(given)
    spark = build_session(f"txquality-{args.job}", args.master)
    try:
        return _run(spark, args)
    finally:
        clear_scratch(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.job == "bronze":
        summary = run_bronze(spark, args.source_dir, args.bronze_dir, delivery_id=args.delivery_id)
        if summary is not None:
            summary.show(truncate=False)
        return 0
    if args.job == "validate":
        # one row for each check of the suites: collected once, and the status decided on that list
        found = run_validation(spark, args.bronze_dir, args.csv)
        results = found.collect()
        _expect_rows("checks", len(results), (len(TRANSACTION_SUITE), len(TRANSACTION_SUITE) + len(CUSTOMER_SUITE)))
        summarise(spark.createDataFrame(results, found.schema)).show(truncate=False)
        return 0 if all(r["success"] for r in results) else 1
    if args.job == "load":
        run_raw_load(spark, args.csv_dir, args.raw_dir, args.load_id).show(truncate=False)
        counts = verify_load(spark, args.raw_dir)
        if counts is not None:
            counts.show()
        return 0
    if args.raw_dir:
        transactions, customers = raw_tables(spark, args.raw_dir)
    else:
        transactions = read_bronze_transactions(spark, args.bronze_dir)
        customers = read_bronze_customers(spark, args.bronze_dir)
    tests = run_refinement(spark, transactions, customers, args.warehouse_dir).tests
    results = tests.collect()
    _expect_rows("table tests", len(results), (len(STANDARD_TESTS),))
    spark.createDataFrame(results, tests.schema).show(truncate=False)
    return 1 if any(r["should_error"] for r in results) else 0


def _expect_rows(what: str, found: int, wanted: tuple[int, ...]) -> None:
    """A run that has not made all its results must not pass for a good one."""
    if found not in wanted:
        raise RuntimeError(f"{found} results of {what}, not {' or '.join(map(str, wanted))}")


if __name__ == "__main__":
    sys.exit(main())
