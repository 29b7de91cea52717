"""Every operator of the library as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook import fixtures
from txquality import schemas
from txquality.functions import money
from txquality.operators import dedup, merge, profile, table_tests
from txquality.operators import expectations as ex
from txquality.plans import bronze, feed, incremental, silver, staging, validation, warehouse
from txquality.plans.gold import gold
from txquality.session import scratch_path, stored
from txquality.sinks import publish, write_partitioned, write_plain
from txquality.sources import files, raw_load

Query = Callable[[SparkSession, str], DataFrame]

INGESTED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
LATER_INGESTED_AT = datetime(2024, 1, 2, tzinfo=timezone.utc)
FIRST_LOAD_AT = datetime(2024, 1, 3, tzinfo=timezone.utc)
SECOND_LOAD_AT = datetime(2024, 1, 4, tzinfo=timezone.utc)
GOLD_AT = datetime(2024, 1, 5, tzinfo=timezone.utc)
RUN_ID = "20240101_000000"

_REGISTERED: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name, run in UTC, with plain result types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain_types(build(spark, sf_dir))

    _REGISTERED[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def plain_types(df: DataFrame) -> DataFrame:
    """Types that read the same from both engines: decimals and integers that
    may be NULL as double, dates and timestamps zone-free, arrays of text as one text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        nullable_int = isinstance(field.dataType, T.IntegerType) and field.nullable
        if isinstance(field.dataType, T.DecimalType) or nullable_int:
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "; ")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- inputs -------------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.prepared_transactions(spark, sf_dir).select(*schemas.TRANSACTION_COLUMNS)


def bronze_tx(spark: SparkSession, sf_dir: str, first_load_only: bool = False) -> DataFrame:
    """Bronze transactions of two loads, which differ in ingestion time."""
    loads = fixtures.prepared_transactions(spark, sf_dir)
    if first_load_only:
        loads = loads.filter(F.col("copy") == 0)
    flagged = bronze.flag_transactions(loads)
    by_load = F.when(F.col("copy") == 0, F.lit(INGESTED_AT)).otherwise(F.lit(LATER_INGESTED_AT))
    audited = bronze.with_audit(flagged, "orders", INGESTED_AT, RUN_ID)
    return audited.withColumn("_ingestion_timestamp", by_load).drop("k", "copy")


def bronze_cust(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = bronze.flag_customers(fixtures.raw_customers(spark, sf_dir))
    return bronze.with_audit(flagged, "customer", INGESTED_AT, RUN_ID)


def staged(spark: SparkSession, sf_dir: str, first_load_only: bool = False) -> DataFrame:
    return staging.staging(bronze_tx(spark, sf_dir, first_load_only))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver(staged(spark, sf_dir), SECOND_LOAD_AT)


def write_csv(df: DataFrame, path: str, *partitions: str) -> None:
    # without these options the CSV writer would drop the spaces the fixtures test
    writer = df.write.option("header", "true")
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    (writer.partitionBy(*partitions) if partitions else writer).csv(path)


# --- sources ------------------------------------------------------------------


@query
def scan_csv_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions-csv")
    write_csv(raw(spark, sf_dir), path)
    return files.transactions_csv(spark, path)


@query
def scan_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customers-csv")
    write_csv(fixtures.raw_customers(spark, sf_dir), path)
    return files.customers_csv(spark, path)


@query
def scan_jsonl_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions-json")
    raw(spark, sf_dir).write.json(path)
    return files.transactions_json(spark, path)


@query
def scan_folder_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries in folders of their own, each read whole, then united."""
    path = scratch_path(spark, "deliveries")
    loads = fixtures.prepared_transactions(spark, sf_dir).withColumn(
        "delivery", F.when(F.col("copy") == 0, "first").otherwise("later")
    )
    write_csv(loads.select(*schemas.TRANSACTION_COLUMNS, "delivery"), path, "delivery")
    first, later = (
        files.read_csv_folder(spark, f"{path}/delivery={name}", schemas.TRANSACTIONS)
        for name in ("first", "later")
    )
    return files.union_all(first, later)


@query
def scan_folder_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files with line breaks in quoted cells."""
    path = scratch_path(spark, "multi-line")
    broken = F.when(F.col("k") % 13 == 0, F.concat(F.lit("Line,\nbroken "), F.col("k").cast("string"))).otherwise(F.col("description"))
    rows = fixtures.prepared_transactions(spark, sf_dir).withColumn("description", broken)
    write_csv(rows.select(*schemas.TRANSACTION_COLUMNS), path)
    return files.read_csv_folder(spark, path, schemas.TRANSACTIONS, multi_line=True)


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A raw load with NULL texts and cells that are no numbers; table path and report."""
    path = scratch_path(spark, "raw-csv")
    amount = (
        "case when k % 71 = 31 then '12.5.1' when amount is null and k % 2 = 0 then 'None' "
        "when amount is null then 'nan' else cast(amount as string) end as amount"
    )
    group = fixtures.LOAD_GROUP + " as load_group"
    cells = [amount if name == "amount" else name for name in schemas.TRANSACTION_COLUMNS]
    rows = fixtures.prepared_transactions(spark, sf_dir).selectExpr(*cells, group)
    write_csv(rows, path, "load_group")
    write_csv(rows.drop("load_group").limit(0), f"{path}/load_group=none")
    table = scratch_path(spark, "raw-table")
    report = raw_load.load_table(spark, path, schemas.TRANSACTIONS, table, "load-1", "*/*.csv")
    return table, report


def _by_folder(report: DataFrame) -> DataFrame:
    """A report's files added up by folder."""
    folder = F.regexp_extract("file", "load_group=([a-z_]+)", 1)
    names = ("rows_parsed", "rows_loaded", "errors_seen")
    sums = report.groupBy(folder.alias("load_group")).agg(*(F.sum(name).alias(name) for name in names))
    return sums.withColumn("status", raw_load.load_status(F.col("rows_loaded"), F.col("errors_seen")))


@query
def raw_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of a load by folder, one of them with a single file without rows."""
    _, report = _loaded(spark, sf_dir)
    return _by_folder(report)


def _table_row(spark: SparkSession, table: str) -> DataFrame:
    rows = files.row_count(raw_load.raw_table(spark, table, schemas.TRANSACTIONS))
    return rows.select(F.lit("table"), "row_count", "row_count", F.lit(0).cast("long"), F.lit("LOADED"))


@query
def raw_load_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load run again after its files were corrected (and others spoilt): report, ledger and table."""
    table = scratch_path(spark, "raw-table")
    rows = fixtures.prepared_transactions(spark, sf_dir)
    for bad in ("k % 71 = 31", "k % 73 = 5"):
        path = scratch_path(spark, "raw-csv")
        amount = f"case when {bad} then '12.5.1' else cast(amount as string) end as amount"
        cells = [amount if name == "amount" else name for name in schemas.TRANSACTION_COLUMNS]
        write_csv(rows.selectExpr(*cells, fixtures.LOAD_GROUP + " as load_group"), path, "load_group")
        report = raw_load.load_table(spark, path, schemas.TRANSACTIONS, table, "load-1", "*/*.csv", once=True)
    ledger = _by_folder(raw_load.ledger(spark, table))
    whole = ledger.agg(*(F.sum(name).alias(name) for name in ("rows_parsed", "rows_loaded", "errors_seen")))
    of_ledger = whole.select(F.lit("ledger"), "*", F.lit("LOADED"))
    return _by_folder(report).union(of_ledger).union(_table_row(spark, table))


@query
def raw_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder loaded twice under two ids, with new files the second time: each file is in one load."""
    path, table = scratch_path(spark, "raw-csv"), scratch_path(spark, "raw-table")
    rows = fixtures.prepared_transactions(spark, sf_dir)
    for load, chosen in (("first", "copy = 0"), ("second", "copy > 0"), ("third", None)):
        if chosen:
            write_csv(rows.filter(chosen).select(*schemas.TRANSACTION_COLUMNS), f"{path}/{load}")
        raw_load.load_table(spark, path, schemas.TRANSACTIONS, table, load, "*/*.csv", once=True)
    names = ("rows_parsed", "rows_loaded", "errors_seen")
    by_load = raw_load.ledger(spark, table).groupBy(F.col("load_id").alias("load_group")).agg(*(F.sum(name).alias(name) for name in names))
    return by_load.withColumn("status", raw_load.load_status(F.col("rows_loaded"), F.col("errors_seen"))).union(_table_row(spark, table))


@query
def raw_load_verify_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _loaded(spark, sf_dir)
    view = f"raw_transactions_{uuid.uuid4().hex}"
    raw_load.raw_table(spark, table, schemas.TRANSACTIONS).createOrReplaceTempView(view)
    return files.row_count(files.source_table(spark, view))


# --- bronze -------------------------------------------------------------------


@query
def bronze_parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_dates(raw(spark, sf_dir)).select(
        "reference_number", "transaction_date_ts", "settlement_date_ts", "created_at_ts",
        "partition_year", "partition_month", "partition_day",
    )


@query
def bronze_dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = bronze.flag_transactions(raw(spark, sf_dir))
    return flagged.select("reference_number", "created_at", *schemas.TRANSACTION_FLAGS)


@query
def bronze_customer_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = bronze.flag_customers(fixtures.raw_customers(spark, sf_dir))
    return flagged.select(*schemas.CUSTOMER_COLUMNS, *schemas.CUSTOMER_FLAGS)


@query
def bronze_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = bronze.with_audit(raw(spark, sf_dir), "orders", INGESTED_AT, RUN_ID)
    return audited.select("reference_number", "created_at", *(f.name for f in schemas.BRONZE_TRANSACTIONS if f.name.startswith("_")))


@query
def bronze_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    write_partitioned(bronze_tx(spark, sf_dir), f"{path}/transactions", bronze.PARTITION_COLUMNS)
    return bronze.read_bronze_transactions(spark, path)


@query
def bronze_customers_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    write_plain(bronze_cust(spark, sf_dir), f"{path}/customers")
    return bronze.read_bronze_customers(spark, path)


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.union_all(
        profile.dq_summary(bronze_tx(spark, sf_dir), "Transactions"),
        profile.dq_summary(bronze_cust(spark, sf_dir), "Customers"),
    )


@query
def rows_with_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = profile.rows_with_issues(bronze.flag_transactions(raw(spark, sf_dir)))
    return flagged.select("reference_number", "created_at", *schemas.TRANSACTION_FLAGS)


@query
def issue_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.issue_profile(raw(spark, sf_dir))


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ingest job, from source files to stored Bronze and its summary."""
    source = scratch_path(spark, "source")
    write_csv(raw(spark, sf_dir), f"{source}/transactions.csv")
    write_csv(fixtures.raw_customers(spark, sf_dir), f"{source}/customers.csv")
    return bronze.run_bronze(spark, source, scratch_path(spark, "bronze"), INGESTED_AT, RUN_ID)


@query
def bronze_ingest_without_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job where one entity's file is absent."""
    source = scratch_path(spark, "source")
    write_csv(raw(spark, sf_dir), f"{source}/transactions.csv")
    return bronze.run_bronze(spark, source, scratch_path(spark, "bronze"), INGESTED_AT, RUN_ID)


@query
def bronze_two_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the same months, both kept; running the second again changes nothing."""
    path = scratch_path(spark, "bronze")
    loads = fixtures.prepared_transactions(spark, sf_dir)
    for delivery, rows in (("first", loads.filter("copy = 0")), ("later", loads.filter("copy > 0"))):
        source = scratch_path(spark, "source")
        write_csv(rows.select(*schemas.TRANSACTION_COLUMNS), f"{source}/transactions.csv")
        for _ in range(1 if delivery == "first" else 2):
            bronze.run_bronze(spark, source, path, INGESTED_AT, RUN_ID, delivery_id=delivery)
    return bronze.read_bronze_transactions(spark, path).select(*schemas.TRANSACTION_COLUMNS, *schemas.TRANSACTION_FLAGS)


@query
def bronze_corrected_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries run again, one with other rows of fewer months and one with none; ids stay as they are."""
    path = scratch_path(spark, "bronze")
    loads = fixtures.prepared_transactions(spark, sf_dir)
    runs = (
        ("007", "copy = 0"), ("1.10", "copy = 1"), ("2024-06-01", "copy = 2"),
        ("007", "copy = 0 and k % 2 = 0 and substr(created_at, 6, 2) <= '06'"), ("2024-06-01", "copy < 0"),
    )
    for delivery, chosen in runs:
        source = scratch_path(spark, "source")
        write_csv(loads.filter(chosen).select(*schemas.TRANSACTION_COLUMNS), f"{source}/transactions.csv")
        bronze.run_bronze(spark, source, path, INGESTED_AT, RUN_ID, delivery_id=delivery)
    stored_rows = bronze.read_deliveries(spark, path)
    return stored_rows.select(F.col(bronze.DELIVERY_COLUMN).alias("delivery_id"), *schemas.TRANSACTION_COLUMNS, *schemas.TRANSACTION_FLAGS)


@query
def bronze_delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of one delivery among others, under an id that looks like a number."""
    path = scratch_path(spark, "bronze")
    loads = fixtures.prepared_transactions(spark, sf_dir)
    for delivery, chosen in (("1.10", "copy > 0"), ("007", "copy = 0")):
        source = scratch_path(spark, "source")
        write_csv(loads.filter(chosen).select(*schemas.TRANSACTION_COLUMNS), f"{source}/transactions.csv")
        summary = bronze.run_bronze(spark, source, path, INGESTED_AT, RUN_ID, delivery_id=delivery)
    return summary


def _fed(spark: SparkSession, sf_dir: str) -> str:
    """A feed run three times: after each of two arrivals of files, some lines cut off, and once more."""
    arriving, path, progress = (scratch_path(spark, label) for label in ("feed", "bronze", "feed-progress"))
    loads = fixtures.prepared_transactions(spark, sf_dir)
    line = F.to_json(F.struct(*schemas.TRANSACTION_COLUMNS))
    cut = F.when(F.col("k") % 97 == 5, F.concat(F.lit('{"transaction_id": "cut '), F.col("k").cast("string"))).otherwise(line)
    for chosen in ("copy = 0", "copy > 0", None):
        if chosen:
            loads.filter(chosen).select(cut.alias("value")).write.mode("append").text(arriving)
        feed.run_feed(spark, arriving, path, progress, ingested_at=INGESTED_AT, run_id=RUN_ID)
    return path


@query
def feed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of a feed of JSON lines, each file taken once."""
    rows = bronze.read_bronze_transactions(spark, _fed(spark, sf_dir))
    return rows.select(*schemas.TRANSACTION_COLUMNS, *schemas.TRANSACTION_FLAGS)


@query
def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the feed that are no transaction."""
    return feed.read_rejects(spark, _fed(spark, sf_dir)).select("line")


@query
def raw_load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job: both raw tables, their counts and what the reports say."""
    source, tables = scratch_path(spark, "csv"), scratch_path(spark, "raw-tables")
    write_csv(bronze_tx(spark, sf_dir).select(*schemas.BRONZE_TRANSACTIONS.fieldNames()), f"{source}/transactions")
    write_csv(bronze_cust(spark, sf_dir).select(*schemas.BRONZE_CUSTOMERS.fieldNames()), f"{source}/customers")
    report = warehouse.run_raw_load(spark, source, tables, "load-1")
    entity = F.regexp_extract("file", "/(transactions|customers)/", 1)
    loaded = report.groupBy(entity.alias("table_name")).agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("errors_seen").alias("errors_seen"))
    return warehouse.verify_load(spark, tables).join(loaded, "table_name")


# --- staging and silver -------------------------------------------------------


@query
def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"stg_transactions_{uuid.uuid4().hex}"
    staging.staging_view(bronze_tx(spark, sf_dir), name)
    return spark.table(name)


@query
def silver_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.valid_rows(staged(spark, sf_dir))


@query
def silver_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.newest_versions(silver.valid_rows(staged(spark, sf_dir)))


@query
def dedup_by_created_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("created_at").desc_nulls_last(), F.col("reference_number").desc_nulls_last()]
    return dedup.newest_per_key(raw(spark, sf_dir), ["transaction_id"], order)


@query
def fx_to_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    usd = money.to_usd(F.col("amount"), F.col("currency"))
    return staged(spark, sf_dir).select(
        "reference_number", "created_at", "currency", "amount", usd.alias("amount_usd")
    )


@query
def fx_to_usd_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    usd = money.to_usd_rounded(F.col("amount"), F.col("currency"))
    return raw(spark, sf_dir).select(
        "reference_number", "created_at", "currency", "amount", usd.alias("amount_usd")
    )


@query
def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rows(spark, sf_dir)


@query
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load creates the table, a recomputation of all loads is merged in."""
    table = f"silver_{uuid.uuid4().hex}"
    location = scratch_path(spark, "silver")
    first, everything = staged(spark, sf_dir, first_load_only=True), staged(spark, sf_dir)
    silver.run_silver(spark, first, location, FIRST_LOAD_AT, "s1", table)
    return silver.run_silver(spark, everything, location, SECOND_LOAD_AT, "s2", table)


@query
def silver_upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the later versions are merged, as a stored batch, into a table without buckets."""
    table = f"silver_{uuid.uuid4().hex}"
    location = scratch_path(spark, "silver")
    first, everything = staged(spark, sf_dir, first_load_only=True), staged(spark, sf_dir)
    target = publish(silver.silver(first, FIRST_LOAD_AT), table, location, "s1")
    later = everything.filter(F.col("_ingestion_timestamp") > F.lit(INGESTED_AT))
    batch = stored(silver.silver(later, SECOND_LOAD_AT), "silver-batch")
    return publish(merge.merge_batch(target, batch, schemas.SILVER_KEY), table, location, "s2")


def _in_parts(spark: SparkSession, sf_dir: str) -> str:
    """Silver in buckets and Gold by day after a first load, later versions of some keys, then those of the others."""
    path = scratch_path(spark, "warehouse")
    rows = staged(spark, sf_dir)
    later = F.col("_ingestion_timestamp") > F.lit(INGESTED_AT)
    some = F.coalesce(F.pmod(F.xxhash64("transaction_id"), F.lit(10)) == 0, F.lit(False))
    first = (staged(spark, sf_dir, first_load_only=True), FIRST_LOAD_AT)
    for number, (load, at) in enumerate((first, (rows.filter(later & some), SECOND_LOAD_AT), (rows.filter(later & ~some), SECOND_LOAD_AT))):
        incremental.merge_load(spark, load, path, at, f"load-{number}")
        incremental.refresh_gold(spark, path, GOLD_AT)
    return path


@query
def silver_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads merged into the buckets that their keys fall into."""
    return incremental.read_silver(spark, _in_parts(spark, sf_dir)).drop("_silver_loaded_at")


@query
def gold_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after only the days that each load changed were aggregated again."""
    rounded = {name: F.round(name, 6) for name in ("avg_amount", "avg_settlement_days")}
    return incremental.read_gold(spark, _in_parts(spark, sf_dir)).withColumns(rounded)


@query
def silver_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.coverage(staged(spark, sf_dir), silver.is_valid())


# --- gold ---------------------------------------------------------------------


@query
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold(silver_rows(spark, sf_dir), GOLD_AT)
    return daily.withColumns(
        {
            "avg_amount": F.round("avg_amount", 6),
            "avg_settlement_days": F.round("avg_settlement_days", 6),
        }
    )


@query
def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as a table: the snapshot of a first load is replaced by that of all loads."""
    rounded = {name: F.round(name, 6) for name in ("avg_amount", "avg_settlement_days")}
    return _refined(spark, sf_dir, twice=True).gold.withColumns(rounded)


@query
def gold_day_currency_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = profile.day_currency_totals(raw(spark, sf_dir))
    return totals.withColumn("total", F.round("total", 4))


@query
def completed_vs_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.completed_vs_other(raw(spark, sf_dir))


@query
def values_per_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(raw(spark, sf_dir), "status")


def _refined(spark: SparkSession, sf_dir: str, twice: bool = False) -> warehouse.Refined:
    tag = uuid.uuid4().hex
    location = scratch_path(spark, "warehouse")
    names = warehouse.Names(f"staging_{tag}", f"silver_{tag}", f"gold_{tag}")
    customers = fixtures.raw_customers(spark, sf_dir)
    if twice:
        warehouse.run_refinement(spark, bronze_tx(spark, sf_dir, True), customers, location, GOLD_AT, "s0", names)
    return warehouse.run_refinement(spark, bronze_tx(spark, sf_dir), customers, location, GOLD_AT, "s1", names)


# --- table tests --------------------------------------------------------------


@query
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_tests.not_null(raw(spark, sf_dir), "transaction_id", "raw.transactions")


@query
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_tests.unique(fixtures.raw_customers(spark, sf_dir), "customer_id", "raw.customers")


@query
def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_tests.accepted_values(raw(spark, sf_dir), "currency", schemas.CURRENCIES, "raw.transactions")


@query
def table_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All standard tests. Silver is stored once, since several tests read it."""
    return table_tests.run_table_tests(
        {
            "raw.transactions": bronze_tx(spark, sf_dir),
            "raw.customers": fixtures.raw_customers(spark, sf_dir),
            "silver.transactions": stored(silver_rows(spark, sf_dir), "silver"),
        }
    )


@query
def refinement_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard tests at the end of the whole refinement job."""
    return _refined(spark, sf_dir).tests


# --- expectations -------------------------------------------------------------


def _check(name: str, *checks: ex.Check) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ex.run_suite(bronze_tx(spark, sf_dir), name, checks)

    build.__name__ = name
    query(build)


_check("expect_column_exists", ex.column_exists("amount"), ex.column_exists("absent"))
_check(
    "expect_no_nulls",
    ex.no_nulls("transaction_id", 0.99), ex.no_nulls("amount", 0.99), ex.no_nulls("absent"),
)


@query
def expect_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also over a column with cells that are not a number, which are no value."""
    score = F.when(F.col("amount") < 0, F.lit(float("nan"))).otherwise(F.col("amount"))
    rows = bronze_tx(spark, sf_dir).withColumn("score", score)
    return ex.run_suite(rows, "expect_unique", [ex.unique("transaction_id"), ex.unique("absent"), ex.unique("score")])


_check(
    "expect_values_in_set",
    ex.values_in_set("currency", schemas.CURRENCIES, 0.97),
    ex.values_in_set("status", schemas.STATUSES, 0.98),
    # members of another type than the column's match nothing
    ex.values_in_set("status", (True, 7)),
    ex.values_in_set("amount", ("USD", False)),
)
_check(
    "expect_values_between",
    ex.values_between("amount", low=0, mostly=0.95),
    ex.values_between("amount", high=400000, mostly=0.95),
    ex.values_between("fee_amount", low=0, high=500, mostly=1.0),
    ex.values_between("currency", low=0),
)
_check("expect_row_count_above", ex.row_count_above(1600), ex.row_count_above(10**9))
_check("expect_not_negative", ex.not_negative("amount", 0.97), ex.not_negative("fee_amount"), ex.not_negative("currency"))


@query
def suite_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_transactions(bronze_tx(spark, sf_dir))


@query
def suite_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_customers(bronze_cust(spark, sf_dir))


@query
def validation_of_stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation job: both suites over Bronze as stored."""
    path = scratch_path(spark, "bronze")
    write_partitioned(bronze_tx(spark, sf_dir), f"{path}/transactions", bronze.PARTITION_COLUMNS)
    write_plain(bronze_cust(spark, sf_dir), f"{path}/customers")
    return validation.run_validation(spark, path)


@query
def validation_by_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite over three deliveries, validated as they come: counts of those seen before are added, not taken again."""
    path = scratch_path(spark, "bronze")
    loads = fixtures.prepared_transactions(spark, sf_dir)
    checks = (*ex.TRANSACTION_SUITE, ex.unique("transaction_id"))
    for delivery, chosen in (("a", "copy = 0"), ("b", "copy = 0"), ("b", "copy > 0"), ("c", "copy < 0")):
        source = scratch_path(spark, "source")
        write_csv(loads.filter(chosen).select(*schemas.TRANSACTION_COLUMNS), f"{source}/transactions.csv")
        bronze.run_bronze(spark, source, path, INGESTED_AT, RUN_ID, delivery_id=delivery)
        results = validation.validate_deliveries(spark, path, ex.TRANSACTION_SUITE_NAME, checks)
    return results


def _both_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.summarise(validation.validate(bronze_tx(spark, sf_dir), bronze_cust(spark, sf_dir)))


@query
def suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_suites(spark, sf_dir)


@query
def validation_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.verdict(_both_suites(spark, sf_dir))
