import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from querybook.catalog import write_csv
from tests.helpers import AT, CLEAN, bronze_of, clean_rows, raw
from txquality import schemas
from txquality.__main__ import _expect_rows, main
from txquality.session import clear_scratch, stored
from txquality.plans.bronze import flag_customers, run_bronze, with_audit


def _forget(spark):
    """Views of another test's warehouse, whose names this one takes."""
    spark.sql("DROP VIEW IF EXISTS silver_transactions")
    spark.sql("DROP VIEW IF EXISTS gold_daily_transactions")


def test_jobs_from_files_to_gold(spark, tmp_path):
    source, bronze, warehouse = tmp_path / "raw", tmp_path / "bronze", tmp_path / "warehouse"
    rows = [{**r, "transaction_id": f"{r['transaction_id']}-{i}"} for i in range(14) for r in clean_rows()]
    write_csv(raw(spark, *rows, {**rows[0], "amount": None}), f"{source}/transactions.csv")
    customers = [(f"c{i}", "A", "B", "a@x", "GB", "RETAIL", "LOW", "2023-01-01T00:00:00", "True") for i in range(12)]
    write_csv(spark.createDataFrame(customers, schemas.CUSTOMERS), f"{source}/customers.csv")

    assert main(["bronze", "--source-dir", str(source), "--bronze-dir", str(bronze)]) == 0
    assert main(["validate", "--bronze-dir", str(bronze)]) == 0
    refine = ["refine", "--bronze-dir", str(bronze), "--warehouse-dir", str(warehouse)]
    _forget(spark)
    assert main(refine) == 0
    assert spark.table("silver_transactions").count() == 14 * CLEAN
    assert spark.table("gold_daily_transactions").agg({"total_transactions": "sum"}).first()[0] == 14 * CLEAN


def test_failed_checks_set_the_status(spark, tmp_path):
    write_csv(raw(spark, *clean_rows()), f"{tmp_path}/raw/transactions.csv")
    main(["bronze", "--source-dir", f"{tmp_path}/raw", "--bronze-dir", f"{tmp_path}/bronze"])
    assert main(["validate", "--bronze-dir", f"{tmp_path}/bronze"]) == 1


def test_load_and_refine_from_raw_tables(spark, tmp_path):
    """CSV as another tool may have written Bronze, loaded and refined."""
    bronze_rows = bronze_of(raw(spark, *clean_rows())).withColumns(
        {name: F.col(name).cast("string") for name in ("dq_has_issues", "_ingestion_timestamp")}
    )
    write_csv(bronze_rows, f"{tmp_path}/csv/transactions")
    customers = spark.createDataFrame([("c1",) + ("x",) * 8], schemas.CUSTOMERS)
    write_csv(with_audit(flag_customers(customers), "f", AT, "r"), f"{tmp_path}/csv/customers")
    load = ["load", "--csv-dir", f"{tmp_path}/csv", "--raw-dir", f"{tmp_path}/raw", "--load-id", "l1"]
    assert main(load) == 0
    _forget(spark)
    assert main(["refine", "--raw-dir", f"{tmp_path}/raw", "--warehouse-dir", f"{tmp_path}/w"]) == 0
    assert spark.table("silver_transactions").count() == CLEAN


def test_another_zone_is_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="needs UTC"):
            run_bronze(spark, str(tmp_path), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_too_few_results_are_no_success():
    with pytest.raises(RuntimeError):
        _expect_rows("checks", 0, (18, 28))


def test_submit_settings_win_and_clusters_need_a_shared_folder(tmp_path):
    code = (
        "from txquality.session import build_session, scratch_path\n"
        "s = build_session('t', 'local[1]')\n"
        "print([s.conf.get(k) for k in ('spark.sql.parquet.compression.codec', 'spark.sql.adaptive.advisoryPartitionSizeInBytes', 'spark.sql.session.timeZone')])\n"
        "class Far:\n"
        "    conf = {}\n"
        "    class sparkContext: master = 'yarn'\n"
        "try: scratch_path(Far, 'x')\n"
        "except ValueError as e: print('refused')\n"
    )
    submit = "--conf spark.sql.parquet.compression.codec=snappy --conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.ui.enabled=false pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": submit, "PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
    said = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240).stdout
    assert "['snappy', '256m', 'UTC']" in said.replace("268435456b", "256m") and "refused" in said


def test_scratch_is_cleared(spark):
    kept = stored(spark.range(3), "kept")
    files = kept.inputFiles()
    assert files and all(Path(f.removeprefix("file://")).exists() for f in files)
    clear_scratch(spark)
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)
