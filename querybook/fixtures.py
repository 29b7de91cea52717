"""Raw transactions and customers derived from the test tables.

The expressions are those of FIXTURES.md: modular arithmetic on the key, valid
as written in Spark SQL and in the oracle's SQL, so both engines see the same
rows. ``k`` is the order key, ``d`` its date, ``copy`` the version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txquality import schemas
from txquality.session import scratch_path
from txquality.sources.files import if_present

HOUR_MINUTE = (
    "'T' || lpad(cast(k % 24 as string), 2, '0') || ':' || lpad(cast(k % 60 as string), 2, '0') || ':00'"
)
VERSION_TIME = "cast(d as string) || 'T' || lpad(cast(copy as string), 2, '0') || ':00:00'"

TRANSACTION = {
    "transaction_id": "case when k % 211 = 3 then null else 'tx-' || lpad(cast(k as string), 9, '0') end",
    "customer_id": "case when k % 50 = 7 then null else cast(o_custkey as string) end",
    "transaction_type": (
        "case k % 6 when 0 then 'PAYMENT' when 1 then 'TRANSFER' when 2 then 'WITHDRAWAL' "
        "when 3 then 'DEPOSIT' when 4 then 'FX_TRADE' else 'SETTLEMENT' end"
    ),
    "amount": (
        "case when k % 33 = 5 then null when k % 50 = 9 then -o_totalprice "
        "when copy = 1 and k % 40 = 0 then -o_totalprice else o_totalprice + copy end"
    ),
    "currency": (
        "case when k % 101 = 11 then 'XXX' when k % 97 = 13 then null when k % 89 = 17 then ' usd ' "
        "else case k % 8 when 0 then 'USD' when 1 then 'GBP' when 2 then 'EUR' when 3 then 'JPY' "
        "when 4 then 'CHF' when 5 then 'AUD' when 6 then 'CAD' else 'HKD' end end"
    ),
    "status": (
        "case when k % 103 = 19 then 'INVALID' "
        "when o_orderstatus = 'F' and k % 7 = 0 then 'FAILED' "
        "when o_orderstatus = 'F' and k % 7 = 1 then 'CANCELLED' "
        "when o_orderstatus = 'P' and k % 5 = 0 then 'PROCESSING' "
        "when o_orderstatus = 'P' and k % 5 = 1 then 'PENDING' else 'COMPLETED' end"
    ),
    "counterparty": "case k % 3 when 0 then ' Barclays ' when 1 then 'HSBC' else 'ubs' end",
    "reference_number": "' REF' || lpad(cast(k as string), 10, '0')",
    "transaction_date": f"case when k % 199 = 23 then 'not-a-date' else cast(d as string) || {HOUR_MINUTE} end",
    "settlement_date": (
        f"case when k % 197 = 29 then null else cast(d + cast(k % 3 as int) as string) || {HOUR_MINUTE} end"
    ),
    "description": "'Transaction ' || cast(k as string)",
    "fee_amount": "case when k % 10 = 4 then null else o_totalprice * cast(0.001 as double) end",
    "fee_currency": "case k % 2 when 0 then 'USD' else ' gbp' end",
    "source_system": "case k % 3 when 0 then 'CORE_BANKING' when 1 then 'TRADING_PLATFORM' else 'mobile_app' end",
    "batch_id": "'BATCH_' || replace(cast(d as string), '-', '') || '_01'",
    "created_at": VERSION_TIME,
    "updated_at": VERSION_TIME,
}
INGESTED = "case when copy = 0 then timestamp '2024-01-01 00:00:00' else timestamp '2024-01-02 00:00:00' end"

CUSTOMER = {
    "customer_id": "cast(c_custkey as string)",
    "first_name": "'First' || cast(c_custkey % 999 + 1 as string)",
    "last_name": "'Last' || cast(c_custkey % 997 + 1 as string)",
    "email": (
        "case when c_custkey % 150 = 3 then null "
        "else 'user' || cast(c_custkey as string) || '@example.com' end"
    ),
    "country_code": (
        "case c_nationkey % 5 when 0 then 'GB' when 1 then 'US' when 2 then 'DE' when 3 then 'FR' else 'SG' end"
    ),
    "account_type": (
        "case c_mktsegment when 'BUILDING' then 'RETAIL' when 'MACHINERY' then 'INSTITUTIONAL' "
        "when 'AUTOMOBILE' then 'PRIVATE_BANKING' else 'RETAIL' end"
    ),
    "risk_rating": "case when c_acctbal < 1000 then 'HIGH' when c_acctbal < 5000 then 'MEDIUM' else 'LOW' end",
    "created_at": "'2023-01-01T00:00:00'",
    "is_active": "case when c_custkey % 4 = 3 then 'False' else 'True' end",
}

# versions of each order, as an array so that one scan yields them all
COPIES = "case when k % 60 = 0 then array(0, 1, 2) when k % 20 = 0 then array(0, 1) else array(0) end"


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """17 raw columns, ``_ingestion_timestamp``, and the key ``k`` and ``copy``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "*", "o_orderkey as k", "cast(o_orderdate as date) as d"
    )
    return orders.selectExpr("*", f"explode({COPIES}) as copy").selectExpr(
        *(f"{expression} as {name}" for name, expression in TRANSACTION.items()),
        f"{INGESTED} as _ingestion_timestamp",
        "k",
        "copy",
    )


PREPARED = T.StructType(
    list(schemas.TRANSACTIONS.fields)
    + [
        T.StructField("_ingestion_timestamp", T.TimestampType()),
        T.StructField("k", T.LongType()),
        T.StructField("copy", T.IntegerType()),
    ]
)
_PREPARED: dict[tuple[str, str], str] = {}


def prepared_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived rows as a stored table, made once per session and folder.

    Queries then read a raw table as they would in use. The orders file is one
    split, so rows are spread by key for the tables that are read from here.
    """
    made_in = (spark.sparkContext.applicationId, sf_dir)
    path = _PREPARED.get(made_in)
    found = if_present(lambda: spark.read.schema(PREPARED).parquet(path)) if path else None
    if found is None:
        path = scratch_path(spark, "raw-transactions")
        raw_transactions(spark, sf_dir).repartition("k").write.parquet(path)
        _PREPARED[made_in] = path
        found = spark.read.schema(PREPARED).parquet(path)
    return found


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "*", "explode(case when c_custkey % 500 = 1 then array(0, 1) else array(0) end) as copy"
    )
    return customers.selectExpr(*(f"{expression} as {name}" for name, expression in CUSTOMER.items()))


def raw_transactions_sql(first_load_only: bool = False) -> str:
    keyed = "select *, o_orderkey as k, cast(o_orderdate as date) as d from orders"
    versions = f"select *, 0 as copy from ({keyed})"
    if not first_load_only:
        versions += (
            f" union all select *, 1 as copy from ({keyed}) where k % 20 = 0"
            f" union all select *, 2 as copy from ({keyed}) where k % 60 = 0"
        )
    columns = ", ".join(f"{expression} as {name}" for name, expression in TRANSACTION.items())
    return f"select {columns}, {INGESTED} as _ingestion_timestamp, k, copy from ({versions})"


def raw_customers_sql() -> str:
    columns = ", ".join(f"{expression} as {name}" for name, expression in CUSTOMER.items())
    return (
        f"select {columns} from customer union all "
        f"select {columns} from customer where c_custkey % 500 = 1"
    )

# folder of a delivery: one with only bad rows, one with some, one with none
LOAD_GROUP = (
    "case when k % 71 = 31 and k % 2 = 0 then 'all_bad' when k % 3 = 0 or k % 71 = 31 then 'mixed' "
    "else 'clean' end"
)
