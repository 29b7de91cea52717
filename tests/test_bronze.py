import uuid

import pytest
from pyspark.sql import functions as F

from querybook.catalog import write_csv
from tests.helpers import AT, CLEAN, FAULTS, bronze_of, clean_rows, dirty_rows, one, plan, raw
from txquality import schemas
from txquality.operators import profile
from txquality.plans import bronze
from txquality.sinks import write_partitioned


@pytest.mark.parametrize("flag", FAULTS)
def test_each_fault_sets_its_flag_alone(spark, flag):
    row = one(bronze.flag_transactions(raw(spark, FAULTS[flag])))
    assert row[flag] is True
    others = [f for f in schemas.TRANSACTION_FLAGS if f not in (flag, "dq_has_issues")]
    assert not any(row[f] for f in others)
    assert row["dq_has_issues"] is True


def test_clean_rows_have_no_issue(spark):
    flagged = bronze.flag_transactions(raw(spark, *clean_rows()))
    assert flagged.filter("dq_has_issues = false").count() == CLEAN


def test_flags_are_three_valued(spark):
    rows = raw(
        spark,
        {"currency": None},
        {"currency": None, "customer_id": None},
        {"status": None},
        {"amount": 0.0},
    )
    flagged = bronze.flag_transactions(rows).collect()
    assert [r["dq_has_issues"] for r in flagged] == [None, True, None, False]
    assert flagged[0]["dq_invalid_currency"] is None
    summary = one(profile.dq_summary(bronze.flag_transactions(rows), "x"))
    assert (summary["total_rows"], summary["clean_rows"], summary["issue_rows"]) == (4, 3, 1)


def test_flags_look_at_text_as_it_came(spark):
    row = one(bronze.flag_transactions(raw(spark, {"currency": " usd "})))
    assert row["dq_invalid_currency"] is True


def test_bad_dates_become_null(spark):
    row = one(bronze.with_dates(raw(spark, {"transaction_date": "not-a-date", "settlement_date": None})))
    assert row["transaction_date_ts"] is None and row["settlement_date_ts"] is None
    assert row["partition_year"] is None and row["created_at_ts"] is not None


def test_layer_schemas(spark):
    flagged = bronze_of(raw(spark, {}))
    assert len(flagged.columns) == 35
    assert {(f.name, f.dataType) for f in flagged.schema} == {
        (f.name, f.dataType) for f in schemas.BRONZE_TRANSACTIONS
    }
    assert len(schemas.BRONZE_CUSTOMERS) == 17


def test_summary_of_nothing(spark):
    summary = one(profile.dq_summary(bronze.flag_transactions(raw(spark)), "x"))
    assert summary["total_rows"] == 0 and summary["clean_pct"] is None


def test_issue_profile(spark):
    found = one(profile.issue_profile(raw(spark, *clean_rows()[:4], *dirty_rows())))
    assert (found["null_amounts"], found["negative_amounts"], found["null_customers"]) == (1, 1, 1)
    assert found["null_amount_pct"] == pytest.approx(10.0)


def test_rewrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "tx")
    may = {"transaction_date": "2024-05-01T00:00:00"}
    june = {"transaction_date": "2024-06-01T00:00:00"}
    undated = {"transaction_date": "never"}
    first = raw(spark, {**may, "transaction_id": "m1"}, {**june, "transaction_id": "j1"}, {**undated, "transaction_id": "u1"})
    write_partitioned(bronze_of(first), path, bronze.PARTITION_COLUMNS)
    write_partitioned(bronze_of(raw(spark, {**june, "transaction_id": "j2"})), path, bronze.PARTITION_COLUMNS)
    stored = spark.read.parquet(path)
    assert {r[0] for r in stored.select("transaction_id").collect()} == {"m1", "j2", "u1"}
    kept = stored.filter("transaction_id = 'u1'")
    assert one(kept)["partition_year"] is None


def test_month_filter_reads_one_partition(spark, tmp_path):
    months = [{"transaction_date": f"2024-{m:02d}-03T00:00:00", "transaction_id": f"t{m}"} for m in range(1, 7)]
    write_partitioned(bronze_of(raw(spark, *months)), f"{tmp_path}/transactions", bronze.PARTITION_COLUMNS)
    stored = bronze.read_bronze_transactions(spark, str(tmp_path))
    june = stored.filter((F.col("partition_year") == 2024) & (F.col("partition_month") == 6))
    assert len({r[0] for r in june.select("_metadata.file_path").collect()}) == 1
    assert june.count() == 1


def test_run_bronze(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    header = ",".join(schemas.TRANSACTION_COLUMNS)
    lines = [
        "t1,c1,PAYMENT,10.5,USD,COMPLETED,A,R1,2024-06-01T10:00:00,,d,0.1,USD,S,B,2024-06-01T10:00:00,",
        "t2,,PAYMENT,-1,USD,COMPLETED,A,R1,2024-05-01T10:00:00,,d,,USD,S,B,2024-06-01T10:00:00,",
        "t3,c3,PAYMENT,oops,USD,COMPLETED,A,R1,broken,,d,,USD,S,B,2024-06-01T10:00:00,",
    ]
    (source / "transactions.csv").write_text("\n".join([header, *lines]) + "\n")
    summaries = bronze.run_bronze(spark, str(source), str(target), AT, "run-1")
    assert [(r["entity"], r["total_rows"], r["issue_rows"]) for r in summaries.collect()] == [("Transactions", 3, 2)]

    (source / "customers.csv").write_text(
        ",".join(schemas.CUSTOMER_COLUMNS) + "\nc1,A,B,a@x,GB,RETAIL,LOW,2023-01-01T00:00:00,True\nc2,A,B,,GB,RETAIL,LOW,2023-01-01T00:00:00,True\n"
    )
    summaries = bronze.run_bronze(spark, str(source), str(target), AT, "run-2")
    found = {r["entity"]: (r["total_rows"], r["clean_rows"]) for r in summaries.collect()}
    assert found == {"Transactions": (3, 1), "Customers": (2, 1)}
    stored = bronze.read_bronze_transactions(spark, str(target))
    assert stored.count() == 3
    assert {r[0] for r in stored.select("_run_id").distinct().collect()} == {"run-2"}


def test_run_bronze_without_files(spark, tmp_path):
    assert bronze.run_bronze(spark, str(tmp_path), str(tmp_path / "out")) is None


def test_hot_month_is_split_among_files(spark, tmp_path):
    """Two thirds of the rows share a month; it is written by several tasks."""
    month = F.when(F.col("id") % 3 < 2, 6).otherwise(F.col("id") % 12 + 1).cast("int")
    rows = spark.range(0, 60000, 1, 6).select(
        F.lit(2024).alias("y"), month.alias("m"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "512k")
    try:
        write_partitioned(rows, f"{tmp_path}/t", ["y", "m"])
    finally:
        spark.conf.set(size, before)
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.count() == 60000
    files = stored.select("m", "_metadata.file_path").distinct().groupBy("m").count().collect()
    per_month = {r["m"]: r["count"] for r in files}
    assert per_month[6] > 2
    # the other months are not written in pieces by every task
    assert min(per_month.values()) == 1 and sum(per_month.values()) < 6 * len(per_month)


def _deliver(spark, folder, target, delivery, *rows):
    write_csv(raw(spark, *rows), f"{folder}/{delivery}/transactions.csv")
    return bronze.run_bronze(spark, f"{folder}/{delivery}", str(target), AT, delivery_id=delivery)


def test_deliveries_of_one_month_are_all_kept(spark, tmp_path):
    late = {"transaction_date": "2024-05-30T01:00:00"}
    _deliver(spark, tmp_path / "a", tmp_path / "bronze", "d1", {"transaction_id": "a"}, {"transaction_id": "b", **late})
    for _ in range(2):  # the same delivery again replaces itself
        summary = _deliver(spark, tmp_path / uuid.uuid4().hex, tmp_path / "bronze", "d2", {"transaction_id": "c"}, {"transaction_id": "d", "transaction_date": None, **late})
    assert one(summary)["total_rows"] == 2
    stored = bronze.read_bronze_transactions(spark, str(tmp_path / "bronze"))
    assert sorted(r["transaction_id"] for r in stored.collect()) == ["a", "b", "c", "d"]
    assert stored.schema == schemas.BRONZE_TRANSACTIONS
    with pytest.raises(ValueError, match="filled the other way"):
        bronze.run_bronze(spark, f"{tmp_path}/a/d1", str(tmp_path / "bronze"), AT)


def test_a_delivery_s_summary_reads_its_partitions_alone(spark, tmp_path):
    _deliver(spark, tmp_path / "a", tmp_path / "bronze", "d1", {"transaction_id": "a"})
    summary = _deliver(spark, tmp_path / "a", tmp_path / "bronze", "d2", {"transaction_id": "b"})
    filters = plan(summary).split("PartitionFilters: [")[1].split("]")[0]
    assert "_delivery_id" in filters


def test_run_ids_differ_within_a_second():
    assert len({bronze.new_run()[1] for _ in range(50)}) == 50
