"""The catalog's queries as SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

from querybook import fixtures

# fixed values, as in the domains of the library
CURRENCIES = "('USD', 'GBP', 'EUR', 'JPY', 'CHF', 'AUD', 'CAD', 'HKD')"
STATUSES = "('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED', 'PROCESSING')"
TYPES = "('PAYMENT', 'TRANSFER', 'WITHDRAWAL', 'DEPOSIT', 'FX_TRADE', 'SETTLEMENT')"
RATE = (
    "(case currency when 'GBP' then 1.27 when 'EUR' then 1.08 when 'JPY' then 0.0067 when 'CHF' then 1.11 "
    "when 'AUD' then 0.65 when 'CAD' then 0.74 when 'HKD' then 0.13 else 1 end)::decimal(5, 4)"
)

# fixed values: the column lists of the layers
TX = (
    "transaction_id, customer_id, transaction_type, amount, currency, status, counterparty, reference_number, "
    "transaction_date, settlement_date, description, fee_amount, fee_currency, source_system, batch_id, "
    "created_at, updated_at"
)
FLAGS = (
    "dq_null_transaction_id, dq_null_customer_id, dq_null_amount, dq_negative_amount, dq_invalid_currency, "
    "dq_invalid_status, dq_has_issues"
)
BRONZE_SELECT = f"""
    select *, n1 or n2 or n3 or neg or badc or bads as dq_has_issues,
        n1 as dq_null_transaction_id, n2 as dq_null_customer_id, n3 as dq_null_amount,
        neg as dq_negative_amount, badc as dq_invalid_currency, bads as dq_invalid_status,
        year(transaction_date_ts) as partition_year, month(transaction_date_ts) as partition_month,
        day(transaction_date_ts) as partition_day,
        'orders' as _source_file, 'bronze' as _pipeline_layer, '1.0.0' as _pipeline_version,
        '20240101_000000' as _run_id
    from (
        select *, transaction_id is null as n1, customer_id is null as n2, amount is null as n3,
            amount < 0 as neg, currency not in {CURRENCIES} as badc, status not in {STATUSES} as bads,
            try_cast(transaction_date as timestamp) as transaction_date_ts,
            try_cast(settlement_date as timestamp) as settlement_date_ts,
            try_cast(created_at as timestamp) as created_at_ts
        from {{source}}
    )"""
STAGED_SELECT = """
    select transaction_id, customer_id, upper(trim(transaction_type)) as transaction_type,
        cast(amount as decimal(18, 4)) as amount, upper(trim(currency)) as currency,
        upper(trim(status)) as status, upper(trim(counterparty)) as counterparty,
        trim(reference_number) as reference_number, upper(trim(source_system)) as source_system,
        trim(batch_id) as batch_id, cast(fee_amount as decimal(18, 6)) as fee_amount,
        upper(trim(fee_currency)) as fee_currency, transaction_date_ts as transaction_date,
        settlement_date_ts as settlement_date, created_at_ts as created_at,
        cast(date_trunc('day', transaction_date_ts) as timestamp) as transaction_day,
        cast(date_trunc('month', transaction_date_ts) as timestamp) as transaction_month,
        dq_null_transaction_id, dq_null_customer_id, dq_null_amount, dq_negative_amount,
        dq_invalid_currency, dq_invalid_status, dq_has_issues,
        _ingestion_timestamp, _pipeline_layer, _pipeline_version, _run_id
    from {source}"""
VALID = (
    "transaction_id is not null and customer_id is not null and amount is not null and amount > 0 "
    f"and currency in {CURRENCIES} and status in {STATUSES} and transaction_date is not null"
)
SILVER_SELECT = f"""
    select transaction_id, customer_id, transaction_type, amount, currency, status, counterparty,
        reference_number, source_system, batch_id, fee_amount, fee_currency,
        amount * {RATE} as amount_usd, coalesce(fee_amount, 0) as fee_amount_clean,
        amount + coalesce(fee_amount, 0) as total_with_fees,
        status = 'COMPLETED' as is_completed, status in ('FAILED', 'CANCELLED') as is_failed,
        transaction_date, settlement_date, created_at, transaction_day, transaction_month,
        datediff('day', transaction_date, settlement_date) as settlement_days,
        timestamp '{{loaded_at}}' as _silver_loaded_at, _ingestion_timestamp as _bronze_ingested_at
    from (select * from {{source}} where {VALID}
        qualify row_number() over (
            partition by transaction_id order by _ingestion_timestamp desc, created_at desc) = 1)"""

SECOND = "2024-01-04 00:00:00"
FIRST = "2024-01-03 00:00:00"


def _chain(select: str) -> str:
    """``select`` over the layers of the whole input."""
    return (
        f"with tx as ({fixtures.raw_transactions_sql()}), cust as ({fixtures.raw_customers_sql()}), "
        f"bronze as ({BRONZE_SELECT.format(source='tx')}), staged as ({STAGED_SELECT.format(source='bronze')}), "
        f"silver as ({SILVER_SELECT.format(source='staged', loaded_at=SECOND)}) {select}"
    )


def _loads_chain(second: str, select: str) -> str:
    """``select`` over Silver of the first load and of ``second``, a source of staged rows."""
    return (
        f"with tx as ({fixtures.raw_transactions_sql()}), tx0 as ({fixtures.raw_transactions_sql(True)}), "
        f"bronze as ({BRONZE_SELECT.format(source='tx')}), bronze0 as ({BRONZE_SELECT.format(source='tx0')}), "
        f"staged as ({STAGED_SELECT.format(source='bronze')}), "
        f"staged0 as ({STAGED_SELECT.format(source='bronze0')}), "
        f"old as ({SILVER_SELECT.format(source='staged0', loaded_at=FIRST)}), "
        f"new as ({SILVER_SELECT.format(source=second, loaded_at=SECOND)}) {select}"
    )


def _doubles(columns: str, decimals: tuple[str, ...]) -> str:
    names = [name.strip() for name in columns.split(",")]
    return ", ".join(f"cast({n} as double) as {n}" if n in decimals else n for n in names)


STAGED_COLUMNS = _doubles(
    "transaction_id, customer_id, transaction_type, amount, currency, status, counterparty, reference_number, "
    "source_system, batch_id, fee_amount, fee_currency, transaction_date, settlement_date, created_at, "
    f"transaction_day, transaction_month, {FLAGS}, _ingestion_timestamp, _pipeline_layer, _pipeline_version, _run_id",
    ("amount", "fee_amount"),
)
SILVER_COLUMNS = _doubles(
    "transaction_id, customer_id, transaction_type, amount, currency, status, counterparty, reference_number, "
    "source_system, batch_id, fee_amount, fee_currency, amount_usd, fee_amount_clean, total_with_fees, "
    "is_completed, is_failed, transaction_date, settlement_date, created_at, transaction_day, transaction_month, "
    "settlement_days, _silver_loaded_at, _bronze_ingested_at",
    ("amount", "fee_amount", "amount_usd", "fee_amount_clean", "total_with_fees", "settlement_days"),
)
MERGED = " union all ".join(
    (
        f"select {SILVER_COLUMNS} from new",
        f"select {SILVER_COLUMNS} from old where transaction_id not in (select transaction_id from new)",
    )
)
CUST_FLAGGED = (
    "select *, customer_id is null as dq_null_customer_id, email is null as dq_null_email, "
    "customer_id is null or email is null as dq_has_issues from cust"
)
CUST_AUDIT = (
    "timestamp '2024-01-01 00:00:00' as _ingestion_timestamp, '{source}' as _source_file, "
    "'bronze' as _pipeline_layer, '1.0.0' as _pipeline_version, '20240101_000000' as _run_id"
)


def _summary(entity: str, source: str) -> str:
    return (
        f"select '{entity}' as entity, total_rows, total_rows - issue_rows as clean_rows, issue_rows, "
        "cast(total_rows - issue_rows as double) / total_rows * 100 as clean_pct, "
        "cast(issue_rows as double) / total_rows * 100 as issue_pct from (select count(*) as total_rows, "
        f"count(*) filter (where dq_has_issues) as issue_rows from {source})"
    )


def _table_test(table: str, test: str, column: str, failures: str) -> str:
    return (
        f"select '{table}' as table_name, '{test}' as test_name, '{column}' as column_name, failures, "
        f"failures <> 0 as should_warn, failures <> 0 as should_error from (select ({failures}) as failures)"
    )


def _null_test(table: str, source: str, column: str) -> str:
    return _table_test(table, "not_null", column, f"select count(*) from {source} where {column} is null")


def _unique_test(table: str, source: str, column: str) -> str:
    return _table_test(
        table, "unique", column,
        f"select count(*) from (select {column} from {source} where {column} is not null "
        f"group by {column} having count(*) > 1)",
    )


def _accepted_test(table: str, source: str, column: str, domain: str) -> str:
    return _table_test(
        table, "accepted_values", column,
        f"select count(*) from (select {column} from {source} where {column} not in {domain} group by {column})",
    )


def _percent(rate: str) -> str:
    return f"printf('%.1f%%', round_even({rate} * 100, 1))"


def _expect(suite: str, position: int, check: str, column: str | None, mostly: float, rest: str) -> str:
    """``rest`` selects observed, detail and success."""
    name = f"'{column}'" if column else "cast(null as varchar)"
    return (
        f"select '{suite}' as suite, {position} as position, '{check}' as check_name, {name} as column_name, "
        f"cast({mostly} as double) as mostly, observed, detail, success from ({rest})"
    )


def _exists(found: bool) -> str:
    return f"select cast(null as double) as observed, '' as detail, {str(found).lower()} as success"


def _absent() -> str:
    return "select cast(null as double) as observed, 'column missing' as detail, false as success"


def _rows(source: str, least: int) -> str:
    return (
        f"select cast(n as double) as observed, 'actual=' || format('{{:,}}', n) as detail, n >= {least} as success "
        f"from (select count(*) as n from {source})"
    )


def _rate(source: str, label: str, rate: str, passes: str, where: str = "true") -> str:
    return (
        f"select r as observed, '{label}=' || coalesce({_percent('r')}, 'nan%') as detail, "
        f"coalesce({passes}, false) as success from (select {rate} as r from {source} where {where})"
    )


def _nulls(source: str, column: str, mostly: float) -> str:
    rate = f"cast(count(*) filter (where {column} is null) as double) / nullif(count(*), 0)"
    return _rate(source, "null_rate", rate, f"(cast(1 as double) - r) >= cast({mostly} as double)")


def _in_set(source: str, column: str, domain: str, mostly: float) -> str:
    rate = f"cast(count(*) filter (where {column} in {domain}) as double) / nullif(count(*), 0)"
    return _rate(source, "valid_rate", rate, f"r >= cast({mostly} as double)")


def _between(source: str, column: str, inside: str, mostly: float) -> str:
    number = f"try_cast({column} as double)"
    rate = (
        f"coalesce(cast(count(*) filter (where {inside.format(x=number)}) as double) / nullif(count({number}), 0), 1)"
    )
    return _rate(source, "valid_rate", rate, f"r >= cast({mostly} as double)")


def _negatives(source: str, column: str, mostly: float) -> str:
    number = f"try_cast({column} as double)"
    rate = f"cast(count(*) filter (where {number} < 0) as double) / nullif(count({number}), 0)"
    return _rate(source, "negative_rate", rate, f"r <= cast(1 as double) - cast({mostly} as double)")


def _duplicates(source: str, column: str) -> str:
    return (
        "select cast(n as double) as observed, printf('duplicates=%d', n) as detail, n = 0 as success "
        f"from (select count({column}) - count(distinct {column}) as n from {source})"
    )


def _all(*parts: str) -> str:
    return " union all ".join(f"({part})" for part in parts)


def _transaction_suite() -> str:
    suite = "bronze_transactions"
    present = (
        "transaction_id", "customer_id", "amount", "currency", "status", "transaction_type",
        "transaction_date", "dq_has_issues", "_ingestion_timestamp", "_pipeline_layer",
    )
    parts = [
        _expect(suite, i, f"column_exists({c})", c, 1.0, _exists(True)) for i, c in enumerate(present, 1)
    ]
    parts += [
        _expect(suite, 11, "row_count_above(100)", None, 1.0, _rows("bronze", 100)),
        _expect(suite, 12, "no_nulls(transaction_id, mostly=0.99)", "transaction_id", 0.99, _nulls("bronze", "transaction_id", 0.99)),
        _expect(suite, 13, "no_nulls(amount, mostly=0.95)", "amount", 0.95, _nulls("bronze", "amount", 0.95)),
        _expect(suite, 14, "values_in_set(currency, mostly=0.97)", "currency", 0.97, _in_set("bronze", "currency", CURRENCIES, 0.97)),
        _expect(suite, 15, "values_in_set(status, mostly=0.98)", "status", 0.98, _in_set("bronze", "status", STATUSES, 0.98)),
        _expect(suite, 16, "values_in_set(transaction_type, mostly=0.99)", "transaction_type", 0.99, _in_set("bronze", "transaction_type", TYPES, 0.99)),
        _expect(suite, 17, "not_negative(amount, mostly=0.97)", "amount", 0.97, _negatives("bronze", "amount", 0.97)),
        _expect(suite, 18, "values_in_set(_pipeline_layer, mostly=1.0)", "_pipeline_layer", 1.0, _in_set("bronze", "_pipeline_layer", "('bronze')", 1.0)),
    ]
    return _all(*parts)


def _customer_suite() -> str:
    suite = "bronze_customers"
    present = ("customer_id", "email", "account_type", "risk_rating", "_pipeline_layer")
    parts = [
        _expect(suite, i, f"column_exists({c})", c, 1.0, _exists(True)) for i, c in enumerate(present, 1)
    ]
    parts += [
        _expect(suite, 6, "row_count_above(10)", None, 1.0, _rows("cust", 10)),
        _expect(suite, 7, "no_nulls(customer_id, mostly=1.0)", "customer_id", 1.0, _nulls("cust", "customer_id", 1.0)),
        _expect(suite, 8, "no_nulls(email, mostly=0.99)", "email", 0.99, _nulls("cust", "email", 0.99)),
        _expect(suite, 9, "values_in_set(account_type, mostly=1.0)", "account_type", 1.0, _in_set("cust", "account_type", "('RETAIL', 'INSTITUTIONAL', 'PRIVATE_BANKING')", 1.0)),
        _expect(suite, 10, "values_in_set(risk_rating, mostly=1.0)", "risk_rating", 1.0, _in_set("cust", "risk_rating", "('LOW', 'MEDIUM', 'HIGH')", 1.0)),
    ]
    return _all(*parts)


def _suite_summary() -> str:
    return (
        "select suite, count(*) as total, count(*) filter (where success) as passed, "
        "count(*) filter (where not success) as failed, bool_and(success) as success, "
        "coalesce(string_agg(check_name || ' — ' || detail, '; ' order by position) filter (where not success), '') as failures, "
        "round_even(cast(count(*) filter (where success) as double) / count(*) * 100, 1) as success_pct "
        f"from ({_all(_transaction_suite(), _customer_suite())}) group by suite"
    )


def _table_test_report() -> str:
    return _chain(
        _all(
            _null_test("raw.transactions", "tx", "transaction_id"),
            _null_test("raw.transactions", "tx", "_ingestion_timestamp"),
            _null_test("raw.customers", "cust", "customer_id"),
            _unique_test("raw.customers", "cust", "customer_id"),
            _null_test("silver.transactions", "silver", "transaction_id"),
            _unique_test("silver.transactions", "silver", "transaction_id"),
            _null_test("silver.transactions", "silver", "amount"),
            _accepted_test("silver.transactions", "silver", "currency", CURRENCIES),
            _accepted_test("silver.transactions", "silver", "status", STATUSES),
            _null_test("silver.transactions", "silver", "is_completed"),
        )
    )


GOLD = """
    select transaction_day, transaction_month, currency, transaction_type, status, source_system,
        count(*) as total_transactions, count(*) filter (where is_completed) as completed_count,
        count(*) filter (where is_failed) as failed_count,
        cast(sum(amount) as double) as total_amount,
        round(cast(sum(amount) as double) / count(*), 6) as avg_amount,
        cast(min(amount) as double) as min_amount, cast(max(amount) as double) as max_amount,
        cast(sum(amount_usd) as double) as total_amount_usd,
        cast(sum(fee_amount_clean) as double) as total_fees,
        cast(count(*) filter (where is_completed) as double) / nullif(count(*), 0) as success_rate,
        round(avg(settlement_days), 6) as avg_settlement_days,
        timestamp '2024-01-05 00:00:00' as _gold_loaded_at
    from silver group by all"""

BAD_CELL = "k % 71 = 31"


def oracle() -> dict[str, str]:
    tx_rows = _chain(f"select {TX} from tx")
    cust_rows = _chain("select * from cust")
    parsed = _doubles(
        "transaction_date_ts, settlement_date_ts, created_at_ts, partition_year, partition_month, partition_day",
        ("partition_year", "partition_month", "partition_day"),
    )
    audit = "_ingestion_timestamp, _source_file, _pipeline_layer, _pipeline_version, _run_id"
    return {
        "scan_csv_transactions": tx_rows,
        "scan_csv_customers": cust_rows,
        "scan_jsonl_transactions": tx_rows,
        "scan_folder_union": tx_rows,
        "raw_load_report": _chain(
            "select load_group, rows_parsed, rows_loaded, errors_seen, case when errors_seen = 0 then 'LOADED' "
            "when rows_loaded = 0 then 'LOAD_FAILED' else 'PARTIALLY_LOADED' end as status "
            f"from (select {fixtures.LOAD_GROUP} as load_group, count(*) as rows_parsed, "
            f"count(*) filter (where not ({BAD_CELL})) as rows_loaded, "
            f"count(*) filter (where {BAD_CELL}) as errors_seen from tx group by 1) "
            "union all select 'none', 0, 0, 0, 'LOADED'"
        ),
        "scan_folder_multiline": _chain(
            "select "
            + TX.replace(
                "description,",
                "case when k % 13 = 0 then 'Line,' || chr(10) || 'broken ' || cast(k as varchar) else description end as description,",
            )
            + " from tx"
        ),
        "bronze_ingest_without_customers": _chain(_summary("Transactions", "bronze")),
        "bronze_two_deliveries": _chain(f"select {TX}, {FLAGS} from bronze"),
        "feed_transactions": _chain(f"select {TX}, {FLAGS} from bronze where k % 97 <> 5"),
        "feed_rejects": _chain("select '{\"transaction_id\": \"cut ' || cast(k as varchar) as line from tx where k % 97 = 5"),
        "bronze_corrected_delivery": _chain(
            f"select '007' as delivery_id, {TX}, {FLAGS} from bronze where copy = 0 and k % 2 = 0 and substr(created_at, 6, 2) <= '06' "
            f"union all select '1.10', {TX}, {FLAGS} from bronze where copy = 1"
        ),
        "bronze_delivery_summary": _chain(_summary("Transactions", "(select * from bronze where copy = 0)")),
        "raw_load_corrected": _chain(
            "select load_group, rows_parsed, rows_loaded, errors_seen, case when errors_seen = 0 then 'LOADED' "
            "when rows_loaded = 0 then 'LOAD_FAILED' else 'PARTIALLY_LOADED' end as status "
            f"from (select {fixtures.LOAD_GROUP} as load_group, count(*) as rows_parsed, "
            "count(*) filter (where k % 73 <> 5) as rows_loaded, count(*) filter (where k % 73 = 5) as errors_seen from tx group by 1) "
            "union all select 'ledger', count(*), count(*) filter (where k % 73 <> 5), count(*) filter (where k % 73 = 5), 'LOADED' from tx "
            "union all select 'table', count(*), count(*), 0, 'LOADED' from tx where k % 73 <> 5"
        ),
        "raw_load_twice": _chain(
            "select case when copy = 0 then 'first' else 'second' end as load_group, count(*) as rows_parsed, count(*) as rows_loaded, "
            "0 as errors_seen, 'LOADED' as status from tx group by 1 union all select 'table', count(*), count(*), 0, 'LOADED' from tx"
        ),
        "raw_load_job": _chain(
            "select 'transactions' as table_name, count(*) as row_count, count(*) as rows_loaded, 0 as errors_seen from tx "
            "union all select 'customers', count(*), count(*), 0 from cust"
        ),
        "raw_load_verify_count": _chain(f"select count(*) as row_count from tx where not ({BAD_CELL})"),
        "bronze_parse_timestamps": _chain(
            f"select reference_number, {parsed} from bronze"
        ),
        "bronze_dq_flags": _chain(f"select reference_number, created_at, {FLAGS} from bronze"),
        "bronze_customer_flags": _chain(CUST_FLAGGED),
        "bronze_audit_columns": _chain(
            f"select reference_number, created_at, {CUST_AUDIT.format(source='orders')} from tx"
        ),
        "bronze_partitioned_roundtrip": _chain(f"select {TX}, {parsed}, {FLAGS}, {audit} from bronze"),
        "bronze_customers_roundtrip": _chain(
            f"select *, {CUST_AUDIT.format(source='customer')} from ({CUST_FLAGGED})"
        ),
        "dq_summary": _chain(_all(_summary("Transactions", "bronze"), _summary("Customers", f"({CUST_FLAGGED})"))),
        "bronze_ingest": _chain(_all(_summary("Transactions", "bronze"), _summary("Customers", f"({CUST_FLAGGED})"))),
        "rows_with_issues": _chain(
            f"select reference_number, created_at, {FLAGS} from bronze where dq_has_issues"
        ),
        "issue_profile": _chain(
            "select *, cast(null_amounts as double) / total_rows * 100 as null_amount_pct, "
            "cast(negative_amounts as double) / total_rows * 100 as negative_amount_pct, "
            "cast(null_customers as double) / total_rows * 100 as null_customer_pct from ("
            "select count(*) as total_rows, count(*) filter (where amount is null) as null_amounts, "
            "count(*) filter (where coalesce(amount, 0) < 0) as negative_amounts, "
            "count(*) filter (where customer_id is null) as null_customers from tx)"
        ),
        "staging_view": _chain(f"select {STAGED_COLUMNS} from staged"),
        "silver_filter": _chain(f"select {STAGED_COLUMNS} from staged where {VALID}"),
        "silver_dedup_latest": _chain(
            f"select {STAGED_COLUMNS} from (select * from staged where {VALID} qualify row_number() over ("
            "partition by transaction_id order by _ingestion_timestamp desc, created_at desc) = 1)"
        ),
        "dedup_by_created_at": _chain(
            f"select {TX} from tx qualify row_number() over (partition by transaction_id "
            "order by created_at desc, reference_number desc) = 1"
        ),
        "fx_to_usd": _chain(
            "select reference_number, created_at, currency, cast(amount as double) as amount, "
            f"cast(amount * {RATE} as double) as amount_usd from staged"
        ),
        "fx_to_usd_rounded": _chain(
            "select reference_number, created_at, currency, amount, "
            f"cast(round(cast(amount as decimal(28, 10)) * {RATE}, 4) as double) as amount_usd from tx"
        ),
        "silver_enriched": _chain(f"select {SILVER_COLUMNS} from silver"),
        "silver_buckets": _chain(f"select * exclude (_silver_loaded_at) from (select {SILVER_COLUMNS} from silver)"),
        "silver_upsert": _loads_chain("staged", MERGED),
        "silver_upsert_batch": _loads_chain(
            "(select * from staged where _ingestion_timestamp > timestamp '2024-01-01 00:00:00')", MERGED
        ),
        "silver_coverage": _chain(
            f"select count(*) as total_rows, count(*) filter (where {VALID}) as kept_rows, "
            f"cast(count(*) filter (where {VALID}) as double) / nullif(count(*), 0) as coverage from staged"
        ),
        "gold_daily": _chain(GOLD),
        "gold_table": _chain(GOLD),
        "gold_changed_days": _chain(GOLD),
        "gold_day_currency_totals": _chain(
            "select date_trunc('day', transaction_date_ts)::timestamp as transaction_day, currency, "
            "round(coalesce(sum(amount), 0), 4) as total from bronze "
            "where transaction_date_ts is not null and currency is not null group by 1, 2"
        ),
        "completed_vs_other": _chain(
            "select count(*) filter (where status = 'COMPLETED') as completed_rows, "
            "count(*) filter (where status is distinct from 'COMPLETED') as other_rows, "
            "count(*) as total_rows from tx"
        ),
        "values_per_status": _chain("select status as value_field, count(*) as n_records from tx group by status"),
        "test_not_null": _chain(_null_test("raw.transactions", "tx", "transaction_id")),
        "test_unique": _chain(_unique_test("raw.customers", "cust", "customer_id")),
        "test_accepted_values": _chain(_accepted_test("raw.transactions", "tx", "currency", CURRENCIES)),
        "table_test_report": _table_test_report(),
        "refinement_tests": _table_test_report(),
        **_expectation_queries(),
        "suite_transactions": _chain(_transaction_suite()),
        "suite_customers": _chain(_customer_suite()),
        "validation_of_stored_bronze": _chain(_all(_transaction_suite(), _customer_suite())),
        "validation_by_delivery": _chain(
            _all(
                _transaction_suite(),
                _expect("bronze_transactions", 19, "unique(transaction_id)", "transaction_id", 1.0, _duplicates("bronze", "transaction_id")),
            )
        ),
        "suite_summary": _chain(_suite_summary()),
        "validation_verdict": _chain(
            f"select count(*) as suites, bool_and(success) as success from ({_suite_summary()})"
        ),
    }


def _expectation_queries() -> dict[str, str]:
    def checks(name: str, *specs: tuple[str, str | None, float, str]) -> str:
        return _chain(_all(*(_expect(name, i, *spec) for i, spec in enumerate(specs, 1))))

    listed = (
        "columns=[''transaction_id'', ''customer_id'', ''transaction_type'', ''amount'', ''currency'', ''status'', "
        "''counterparty'', ''reference_number'', ''transaction_date'', ''settlement_date'', ''description'', "
        "''fee_amount'', ''fee_currency'', ''source_system'', ''batch_id'', ''created_at'', ''updated_at'', "
        "''_ingestion_timestamp'', ''transaction_date_ts'', ''settlement_date_ts'', ''created_at_ts'', "
        "''partition_year'', ''partition_month'', ''partition_day'', ''dq_null_transaction_id'', "
        "''dq_null_customer_id'', ''dq_null_amount'', ''dq_negative_amount'', ''dq_invalid_currency'', "
        "''dq_invalid_status'', ''dq_has_issues'', ''_source_file'', ''_pipeline_layer'', ''_pipeline_version'', "
        "''_run_id'']"
    )
    unfound = f"select cast(null as double) as observed, '{listed}' as detail, false as success"
    return {
        "expect_column_exists": checks(
            "expect_column_exists",
            ("column_exists(amount)", "amount", 1.0, _exists(True)),
            ("column_exists(absent)", "absent", 1.0, unfound),
        ),
        "expect_no_nulls": checks(
            "expect_no_nulls",
            ("no_nulls(transaction_id, mostly=0.99)", "transaction_id", 0.99, _nulls("bronze", "transaction_id", 0.99)),
            ("no_nulls(amount, mostly=0.99)", "amount", 0.99, _nulls("bronze", "amount", 0.99)),
            ("no_nulls(absent)", "absent", 1.0, _absent()),
        ),
        "expect_unique": checks(
            "expect_unique",
            ("unique(transaction_id)", "transaction_id", 1.0, _duplicates("bronze", "transaction_id")),
            ("unique(absent)", "absent", 1.0, _absent()),
            ("unique(score)", "score", 1.0, _duplicates("(select case when amount >= 0 then amount end as score from bronze)", "score")),
        ),
        "expect_values_in_set": checks(
            "expect_values_in_set",
            ("values_in_set(currency, mostly=0.97)", "currency", 0.97, _in_set("bronze", "currency", CURRENCIES, 0.97)),
            ("values_in_set(status, mostly=0.98)", "status", 0.98, _in_set("bronze", "status", STATUSES, 0.98)),
            ("values_in_set(status, mostly=1.0)", "status", 1.0, _in_set("bronze", "status", "('none of them')", 1.0)),
            ("values_in_set(amount, mostly=1.0)", "amount", 1.0, _in_set("bronze", "cast(amount as varchar)", "('none of them')", 1.0)),
        ),
        "expect_values_between": checks(
            "expect_values_between",
            ("values_between(amount, min=0, max=None)", "amount", 0.95, _between("bronze", "amount", "{x} >= 0", 0.95)),
            ("values_between(amount, min=None, max=400000)", "amount", 0.95, _between("bronze", "amount", "{x} <= 400000", 0.95)),
            ("values_between(fee_amount, min=0, max=500)", "fee_amount", 1.0, _between("bronze", "fee_amount", "{x} between 0 and 500", 1.0)),
            ("values_between(currency, min=0, max=None)", "currency", 1.0, _between("bronze", "currency", "{x} >= 0", 1.0)),
        ),
        "expect_row_count_above": checks(
            "expect_row_count_above",
            ("row_count_above(1600)", None, 1.0, _rows("bronze", 1600)),
            ("row_count_above(1000000000)", None, 1.0, _rows("bronze", 10**9)),
        ),
        "expect_not_negative": checks(
            "expect_not_negative",
            ("not_negative(amount, mostly=0.97)", "amount", 0.97, _negatives("bronze", "amount", 0.97)),
            ("not_negative(fee_amount, mostly=1.0)", "fee_amount", 1.0, _negatives("bronze", "fee_amount", 1.0)),
            ("not_negative(currency, mostly=1.0)", "currency", 1.0, _negatives("bronze", "currency", 1.0)),
        ),
    }
