"""Loads that rewrite only what they touch: Silver's buckets, Gold's days, a suite's counts by delivery."""

import glob
import os
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from querybook.catalog import write_csv
from tests.helpers import AT, clean_rows, dirty_rows, one, plan, raw, staged_of
from txquality import schemas, units
from txquality.operators import expectations as ex
from txquality.plans import bronze, incremental, validation
from txquality.plans.gold import gold
from txquality.plans.silver import silver
from txquality.units import Units

LATER = AT + timedelta(days=1)


def load(spark, where, name, *rows, at=AT, buckets=8):
    staged = staged_of(raw(spark, *rows) if rows else raw(spark, {}).limit(0), at)
    return incremental.merge_load(spark, staged, where, at, name, buckets)


def keyed(df, *names):
    return {r["transaction_id"]: tuple(r[n] for n in names) for r in df.collect()}


def day(number):
    return {"transaction_date": f"2024-06-{number:02d}T10:00:00", "created_at": f"2024-06-{number:02d}T10:00:00"}


def history(spark, where):
    rows = [{"transaction_id": f"t{i}", "amount": 1.0 + i, **day(1 + i % 5)} for i in range(40)]
    load(spark, where, "first", *rows)
    return rows


def files(spark, where):
    return {f for f in incremental.read_silver(spark, where).inputFiles()}


def test_one_key_writes_one_bucket(spark, tmp_path):
    where = str(tmp_path)
    history(spark, where)
    before = files(spark, where)
    assert len(load(spark, where, "second", {"transaction_id": "t7", "amount": 99.0, **day(3)}, at=LATER)) == 1
    after = files(spark, where)
    # one bucket's file is new, one is gone, the others are the same files
    assert len(after - before) == 1 and len(before - after) == 1 and len(before) <= 8
    found = keyed(incremental.read_silver(spark, where), "amount", "_silver_loaded_at")
    assert len(found) == 40 and float(found["t7"][0]) == 99.0 and float(found["t8"][0]) == 9.0


def test_gold_reads_and_writes_changed_days_only(spark, tmp_path):
    where = str(tmp_path)
    history(spark, where)
    assert len(incremental.refresh_gold(spark, where, AT.replace(tzinfo=None))) == 5
    load(spark, where, "other", {"transaction_id": "july", "transaction_date": "2024-07-01T10:00:00"})
    assert incremental.refresh_gold(spark, where, AT.replace(tzinfo=None)) == ["2024-07-01"]
    before = set(incremental.read_gold(spark, where).inputFiles())
    # t7 moves from day 3 to day 9
    load(spark, where, "second", {"transaction_id": "t7", **day(9)}, at=LATER)
    assert incremental.refresh_gold(spark, where, LATER.replace(tzinfo=None)) == ["2024-06-03", "2024-06-09"]
    rows = incremental.read_gold(spark, where)
    kept = set(rows.inputFiles()) & before
    assert len(kept) == 1 and "_month=2024-07" in kept.pop()
    whole = gold(incremental.read_silver(spark, where), AT)
    without_time = lambda df: sorted(repr(r) for r in df.drop("_gold_loaded_at").collect())
    assert without_time(rows) == without_time(whole)
    stamps = {r["transaction_day"].day: r["_gold_loaded_at"].day for r in rows.filter("month(transaction_day) = 6").collect()}
    assert stamps == {1: AT.day, 2: AT.day, 3: LATER.day, 4: AT.day, 5: AT.day, 9: LATER.day}
    assert incremental.refresh_gold(spark, where, LATER.replace(tzinfo=None)) == []


def test_a_day_that_loses_its_last_row_is_empty(spark, tmp_path):
    where = str(tmp_path)
    load(spark, where, "first", {"transaction_id": "a", **day(1)}, {"transaction_id": "b", **day(2)})
    incremental.refresh_gold(spark, where, AT.replace(tzinfo=None))
    load(spark, where, "second", {"transaction_id": "a", **day(2)}, at=LATER)
    assert incremental.refresh_gold(spark, where, AT.replace(tzinfo=None)) == ["2024-06-01", "2024-06-02"]
    assert [r["total_transactions"] for r in incremental.read_gold(spark, where).collect()] == [2]


def test_days_of_loads_between_two_refreshes_are_all_taken(spark, tmp_path):
    where = str(tmp_path)
    history(spark, where)
    load(spark, where, "second", {"transaction_id": "t1", **day(8)}, at=LATER)
    load(spark, where, "third", {"transaction_id": "t1", **day(9)}, at=LATER + timedelta(days=1))
    days = incremental.refresh_gold(spark, where, AT.replace(tzinfo=None))
    assert days == [f"2024-06-{n:02d}" for n in (1, 2, 3, 4, 5, 8, 9)]
    assert one(incremental.read_gold(spark, where).agg(F.sum("total_transactions").alias("n")))["n"] == 40


def test_loads_without_valid_rows_change_nothing(spark, tmp_path):
    where = str(tmp_path)
    assert load(spark, where, "none") == []
    assert incremental.read_silver(spark, where).count() == 0 and incremental.read_gold(spark, where).count() == 0
    load(spark, where, "first", *clean_rows())
    assert load(spark, where, "bad", {"transaction_id": None}, {"currency": "euro"}, at=LATER) == []
    assert incremental.read_silver(spark, where).count() == len(clean_rows())
    with pytest.raises(ValueError, match="8 buckets"):
        load(spark, where, "more", *clean_rows(), buckets=9)


def test_equal_to_the_whole_merge(spark, tmp_path):
    where = str(tmp_path)
    loads = [(clean_rows() + dirty_rows(), AT), ([{"transaction_id": "pay/EUR/2", "amount": 3.0}, {"transaction_id": "new"}], LATER)]
    for number, (rows, at) in enumerate(loads):
        load(spark, where, f"load-{number}", *rows, at=at)
    staged = staged_of(raw(spark, *loads[0][0]), AT).unionByName(staged_of(raw(spark, *loads[1][0]), LATER))
    names = [n for n in schemas.SILVER_COLUMNS if n != "_silver_loaded_at"]
    assert keyed(incremental.read_silver(spark, where), *names) == keyed(silver(staged, AT), *names)


def test_units_replaced_together(spark, tmp_path):
    units = Units(str(tmp_path), "part", together=True)
    rows = spark.createDataFrame([(i, str(i % 3)) for i in range(9)], "n long, part string")
    schema = rows.select("n").schema
    units.replace_each(rows, ["0", "1", "2"], sort=["n"])
    units.replace_each(rows.filter("part = '1' and n > 4"), ["1", "2"])
    held = {(r["n"], r["part"]) for r in units.read(spark, schema).collect()}
    assert held == {(0, "0"), (3, "0"), (6, "0"), (7, "1")}
    assert {u: n for u, (_, n) in units.current(spark).items()} == {"0": 3, "1": 1, "2": 0}
    with pytest.raises(Exception, match="another part"):
        units.replace_each(rows, ["0"])
    with pytest.raises(ValueError):
        units.replace_each(rows, ["a/b"])
    with pytest.raises(ValueError):
        units.replace(rows, "0")
    assert {(r["n"], r["part"]) for r in units.read(spark, schema).collect()} == held
    assert units.drop_replaced(spark) == 2 and units.read(spark, schema).count() == 4


# --- validation by delivery -----------------------------------------------------


def deliver(spark, tmp_path, delivery, *rows):
    source = tmp_path / uuid.uuid4().hex
    write_csv(raw(spark, *rows) if rows else raw(spark, {}).limit(0), f"{source}/transactions.csv")
    bronze.run_bronze(spark, str(source), f"{tmp_path}/bronze", datetime(2024, 1, 1, tzinfo=timezone.utc), "run", delivery_id=delivery)


CHECKS = (*ex.TRANSACTION_SUITE, ex.unique("transaction_id"), ex.unique("amount"), ex.unique("absent"), ex.no_nulls("absent"), ex.values_between("amount", low=0))


def both(spark, tmp_path, checks=CHECKS):
    parts = validation.validate_deliveries(spark, f"{tmp_path}/bronze", "s", checks)
    whole = ex.run_suite(bronze.read_bronze_transactions(spark, f"{tmp_path}/bronze"), "s", checks)
    rows = lambda df: sorted(tuple(r) for r in df.drop("detail").fillna(-1.0).collect())
    return rows(parts), rows(whole)


def test_partial_results_add_up_to_a_whole_scan(spark, tmp_path):
    deliver(spark, tmp_path, "a", *clean_rows(), *dirty_rows())
    deliver(spark, tmp_path, "b", *clean_rows()[:3])
    parts, whole = both(spark, tmp_path)
    assert parts == whole
    deliver(spark, tmp_path, "c", {"transaction_id": "z", "amount": None})
    deliver(spark, tmp_path, "b", *clean_rows()[2:4])
    parts, whole = both(spark, tmp_path)
    assert parts == whole
    deliver(spark, tmp_path, "a")
    parts, whole = both(spark, tmp_path)
    assert parts == whole
    parts, whole = both(spark, tmp_path, ex.TRANSACTION_SUITE[:12])
    assert parts == whole


def test_only_new_deliveries_are_scanned(spark, tmp_path):
    counts = lambda: {
        u: a for p in sorted(os.listdir(f"{tmp_path}/bronze/validation"))
        for u, (a, _) in Units(f"{tmp_path}/bronze/validation/{p}/counts", "_delivery_id", together=True).current(spark).items()
    }
    deliver(spark, tmp_path, "a", *clean_rows())
    deliver(spark, tmp_path, "empty")
    both(spark, tmp_path)
    first = counts()
    deliver(spark, tmp_path, "b", *clean_rows())
    both(spark, tmp_path)
    second = counts()
    assert set(second) == {"a", "b", "empty"} and second["a"] == first["a"] and second["empty"] == first["empty"]
    results = validation.validate_deliveries(spark, f"{tmp_path}/bronze", "s", CHECKS)
    assert counts() == second
    # the verdict reads the kept counts, none of Bronze
    assert "/bronze/transactions" not in plan(results) and not any("/transactions/" in f for f in results.inputFiles())


def test_without_deliveries_there_is_nothing_to_validate(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        validation.validate_deliveries(spark, f"{tmp_path}/bronze")


def test_rows_by_value_are_written_and_added_up_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    """Rows are a few bytes each as shuffled, so tasks are sized by rows, whatever their bytes."""
    monkeypatch.setattr(units, "ROWS_PER_TASK", 50)
    many = [{"transaction_id": f"t{i}", "amount": 1.0 + i % 7} for i in range(400)]
    deliver(spark, tmp_path, "large", *many)
    for name in ("s1", "s2", "s3"):
        deliver(spark, tmp_path, name, *many[:5], {"transaction_id": name})
    checks = (ex.unique("transaction_id"), ex.no_nulls("amount"))
    parts, whole = both(spark, tmp_path, checks)
    assert parts == whole and [r[5] for r in parts if r[1] == 1] == [15.0]
    (home,) = os.listdir(f"{tmp_path}/bronze/validation")
    files = spark.read.parquet(*glob.glob(f"{tmp_path}/bronze/validation/{home}/values/_attempt=*")).groupBy(F.input_file_name().alias("file")).count().collect()
    of = lambda name: [r["count"] for r in files if f"_delivery_id={name}/" in r["file"]]
    # the large delivery is split, a small one is not
    assert len(of("large")) == 8 and max(of("large")) < 100 and sum(of("large")) == 400
    assert [of(name) for name in ("s1", "s2", "s3")] == [[6]] * 3
    assert "REPARTITION_BY_NUM" in plan(validation.validate_deliveries(spark, f"{tmp_path}/bronze", "s", checks))
