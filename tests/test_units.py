"""Deliveries and loads replaced as a whole; files loaded once; summaries taken by the write."""

import os
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from querybook.catalog import write_csv
from tests.helpers import one, raw
from txquality import schemas
from txquality.plans import bronze
from txquality.plans.warehouse import run_raw_load
from txquality.sources import raw_load
from txquality.units import Units

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
MAY, JUNE = {"transaction_date": "2024-05-31T01:00:00"}, {"transaction_date": "2024-06-01T01:00:00"}


def deliver(spark, tmp_path, delivery, *rows):
    source = tmp_path / uuid.uuid4().hex
    write_csv(raw(spark, *rows) if rows else raw(spark, {}).limit(0), f"{source}/transactions.csv")
    return bronze.run_bronze(spark, str(source), f"{tmp_path}/bronze", AT, "run", delivery_id=delivery)


def ids(df):
    return sorted(r["transaction_id"] for r in df.select("transaction_id").collect())


def test_a_corrected_delivery_leaves_no_stale_rows(spark, tmp_path):
    deliver(spark, tmp_path, "d1", {"transaction_id": "a", **MAY}, {"transaction_id": "b", **JUNE})
    deliver(spark, tmp_path, "d2", {"transaction_id": "c", **MAY})
    summary = deliver(spark, tmp_path, "d1", {"transaction_id": "a", **JUNE}, {"transaction_id": "b", **JUNE})
    stored = bronze.read_bronze_transactions(spark, f"{tmp_path}/bronze")
    assert ids(stored) == ["a", "b", "c"] and one(summary)["total_rows"] == 2
    assert {r["partition_month"] for r in stored.filter("transaction_id = 'a'").collect()} == {6}
    # nothing of the first run is opened
    assert not any(month_of(f) == 5 and "_delivery_id=d1/" in f for f in stored.inputFiles())

    assert one(deliver(spark, tmp_path, "d1"))["total_rows"] == 0
    assert ids(bronze.read_bronze_transactions(spark, f"{tmp_path}/bronze")) == ["c"]
    assert one(deliver(spark, tmp_path, "d2"))["total_rows"] == 0
    empty = bronze.read_bronze_transactions(spark, f"{tmp_path}/bronze")
    assert empty.count() == 0 and empty.schema == schemas.BRONZE_TRANSACTIONS


def month_of(path):
    return int(path.split("partition_month=")[1].split("/")[0])


@pytest.mark.parametrize("delivery", ["007", "1.10", "2024-06-01", "1e5", "true", "null_1"])
def test_ids_are_kept_as_they_are(spark, tmp_path, delivery):
    summary = deliver(spark, tmp_path, delivery, {"transaction_id": "a", "amount": None}, {"transaction_id": "b"})
    assert (one(summary)["total_rows"], one(summary)["issue_rows"]) == (2, 1)
    assert {r["_delivery_id"] for r in bronze.read_deliveries(spark, f"{tmp_path}/bronze").collect()} == {delivery}
    assert ids(bronze.read_deliveries(spark, f"{tmp_path}/bronze", ["other"])) == []


def test_a_write_that_fails_leaves_what_was_there(spark, tmp_path):
    table = Units(str(tmp_path / "t"), "unit")
    table.replace(spark.range(3), "u")
    broken = spark.range(5).filter(F.when(F.col("id") < 4, True).otherwise(F.raise_error(F.lit("broken")).cast("boolean")))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken, "u")
    assert table.read(spark, spark.range(1).schema).count() == 3
    assert table.drop_replaced(spark) == 0
    table.replace(spark.range(2), "u")
    assert table.drop_replaced(spark) == 1 and table.read(spark, spark.range(1).schema).count() == 2
    assert len([n for n in os.listdir(tmp_path / "t/unit=u") if n in {a for a, _ in table.current(spark).values()} or n.endswith(table.current(spark)["u"][0])]) == 1
    with pytest.raises(ValueError, match="letters"):
        table.replace(spark.range(1), "../u")


def test_a_summary_of_a_whole_export_reads_nothing(spark, tmp_path):
    write_csv(raw(spark, {"transaction_id": "a"}, {"amount": None}), f"{tmp_path}/in/transactions.csv")
    summary = bronze.run_bronze(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", AT, "run")
    assert summary.inputFiles() == [] and "FileScan" not in summary._jdf.queryExecution().toString()
    assert (one(summary)["total_rows"], one(summary)["issue_rows"], one(summary)["clean_pct"]) == (2, 1, 50.0)


def test_a_shuffled_write_counts_each_row_once(spark, tmp_path):
    """The counts are taken where files are written, above the shuffle by month."""
    rows = [{"transaction_id": f"t{i}", "transaction_date": f"2024-{i % 12 + 1:02d}-01T00:00:00", "amount": None if i % 5 else 1.0} for i in range(300)]
    write_csv(raw(spark, *rows), f"{tmp_path}/in/transactions.csv")
    summary = bronze.run_bronze(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", AT, "run")
    assert (one(summary)["total_rows"], one(summary)["issue_rows"]) == (300, 240)


HEADER = ",".join(schemas.TRANSACTION_COLUMNS)


def line(name, amount="10.5"):
    return f"{name},c1,PAYMENT,{amount},USD,COMPLETED,A,R1,2024-06-01T10:00:00,,d,0.1,USD,S,B,2024-06-01T10:00:00,"


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")


def load(spark, tmp_path, load_id, once=True):
    report = raw_load.load_table(spark, f"{tmp_path}/in", schemas.TRANSACTIONS, f"{tmp_path}/raw", load_id, once=once)
    found = {r["file"].rsplit("/", 1)[-1]: (r["rows_parsed"], r["rows_loaded"], r["errors_seen"], r["status"]) for r in report.collect()}
    return found, ids(raw_load.raw_table(spark, f"{tmp_path}/raw", schemas.TRANSACTIONS))


def test_a_corrected_load_replaces_rows_and_rejects(spark, tmp_path):
    put(tmp_path / "in/a.csv", line("a1"), line("a2", "oops"))
    assert load(spark, tmp_path, "L1") == ({"a.csv": (2, 1, 1, "PARTIALLY_LOADED")}, ["a1"])
    put(tmp_path / "in/a.csv", line("a1"), line("a2"))
    assert load(spark, tmp_path, "L1") == ({"a.csv": (2, 2, 0, "LOADED")}, ["a1", "a2"])
    put(tmp_path / "in/a.csv", line("a1", "oops"), line("a2", "oops"))
    assert load(spark, tmp_path, "L1") == ({"a.csv": (2, 0, 2, "LOAD_FAILED")}, [])
    assert [tuple(r)[0:1] + (r["status"],) for r in raw_load.ledger(spark, f"{tmp_path}/raw").collect()] == [("L1", "LOAD_FAILED")]


def test_a_file_is_loaded_once(spark, tmp_path):
    put(tmp_path / "in/a.csv", line("a1"))
    put(tmp_path / "in/bad.csv", line("b1", "oops"))
    assert load(spark, tmp_path, "L1")[1] == ["a1"]
    put(tmp_path / "in/new [1] {x}.csv", line("n1"))
    # of the bad file nothing was loaded, so it is tried again
    assert load(spark, tmp_path, "L2") == ({"new%20%5B1%5D%20%7Bx%7D.csv": (1, 1, 0, "LOADED"), "bad.csv": (1, 0, 1, "LOAD_FAILED")}, ["a1", "n1"])
    put(tmp_path / "in/bad.csv", line("b1", "1.25"))
    assert load(spark, tmp_path, "L3") == ({"bad.csv": (1, 1, 0, "LOADED")}, ["a1", "b1", "n1"])
    assert load(spark, tmp_path, "L4") == ({}, ["a1", "b1", "n1"])
    # a load run again takes its own files again, and only those
    assert load(spark, tmp_path, "L1") == ({"a.csv": (1, 1, 0, "LOADED")}, ["a1", "b1", "n1"])
    counted = raw_load.ledger(spark, f"{tmp_path}/raw").groupBy("load_id").agg(F.sum("rows_loaded").alias("n")).collect()
    assert {r["load_id"]: r["n"] for r in counted} == {"L1": 1, "L2": 1, "L3": 1}
    assert load(spark, tmp_path, "L5", once=False)[1] == ["a1", "a1", "b1", "b1", "n1", "n1"]


def test_the_load_job_takes_each_file_once(spark, tmp_path):
    header = ",".join(f.name for f in schemas.BRONZE_CUSTOMERS)
    folder = tmp_path / "csv/customers"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(header + "\nc1,A,B,a@x,GB,RETAIL,LOW,2023,True,False,False,False,2024-06-01 10:00:00,f,bronze,1.0.0,r\n")
    assert run_raw_load(spark, str(tmp_path / "csv"), str(tmp_path / "raw"), "l1").count() == 1
    assert run_raw_load(spark, str(tmp_path / "csv"), str(tmp_path / "raw"), "l2").count() == 0
    assert raw_load.raw_table(spark, f"{tmp_path}/raw/customers", schemas.BRONZE_CUSTOMERS).count() == 1
