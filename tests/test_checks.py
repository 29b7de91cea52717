import uuid

import pytest
from pyspark.sql import functions as F

from tests.helpers import AT, CLEAN, bronze_of, clean_rows, dirty_rows, one, plan, raw
from txquality import schemas
from txquality.operators import expectations as ex
from txquality.operators import table_tests
from txquality.plans import bronze, silver, validation, warehouse
from txquality.plans.warehouse import run_refinement


def _outcome(df, check):
    return one(ex.run_suite(df, "s", [check]))


def _numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x string")


# --- expectations -------------------------------------------------------------


@pytest.mark.parametrize(
    ("check", "success"),
    [
        (ex.column_exists("x"), True),
        (ex.column_exists("y"), False),
        (ex.no_nulls("x", 0.75), True),
        (ex.no_nulls("x", 0.76), False),
        (ex.values_in_set("x", ("1", "2"), 0.5), True),
        (ex.values_in_set("x", ("1", "2"), 0.51), False),
        (ex.not_negative("x", 0.6), True),
        (ex.not_negative("x", 0.7), False),
        (ex.values_between("x", 1, 2, 0.6), True),
        (ex.values_between("x", 1, 1), False),
        (ex.values_between("x"), True),
        (ex.row_count_above(4), True),
        (ex.row_count_above(5), False),
        (ex.unique("x"), True),
        (ex.unique("y"), False),
    ],
)
def test_rates_and_limits(spark, check, success):
    found = _outcome(_numbers(spark, "1", "2", None, "-3"), check)
    assert found["success"] is success
    if check.column == "y" and check.kind != "column_exists":
        assert found["detail"] == "column missing"


@pytest.mark.parametrize(
    ("check", "success", "detail"),
    [
        (ex.no_nulls("x", 0.0), False, "null_rate=nan%"),
        (ex.values_in_set("x", ("1",), 0.0), False, "valid_rate=nan%"),
        (ex.not_negative("x", 0.0), False, "negative_rate=nan%"),
        (ex.values_between("x", 0, 1), True, "valid_rate=100.0%"),
        (ex.row_count_above(0), True, "actual=0"),
        (ex.unique("x"), True, "duplicates=0"),
    ],
)
def test_empty_table(spark, check, success, detail):
    found = _outcome(_numbers(spark).limit(0), check)
    assert (found["success"], found["detail"]) == (success, detail)


def test_text_that_is_no_number_is_left_out(spark):
    found = _outcome(_numbers(spark, "1", "-1", "abc", "NaN", "5d", ""), ex.not_negative("x", 0.5))
    assert found["observed"] == 0.5 and found["success"] is True


def test_nan_is_missing(spark):
    doubles = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert _outcome(doubles, ex.no_nulls("x"))["observed"] == 0.5


def test_unique_counts_rows_beyond_the_first(spark):
    found = _outcome(_numbers(spark, "1", "1", "1", "2", "2", None, None), ex.unique("x"))
    assert (found["success"], found["observed"], found["detail"]) == (False, 3.0, "duplicates=3")


def test_unique_cuts_a_hot_value_before_the_shuffle(spark):
    text = plan(ex.run_suite(_numbers(spark, "1"), "s", [ex.unique("x")]))
    assert text.index("Exchange hashpartitioning") < text.rindex("HashAggregate")


def test_tolerance_is_compared_in_double(spark):
    # 3 of 100 negative: the limit 1 - 0.97 is a little above 0.03
    rows = spark.range(100).select((F.when(F.col("id") < 3, -1).otherwise(1)).alias("x"))
    assert _outcome(rows, ex.not_negative("x", 0.97))["success"] is True


def test_suites_have_18_and_10_checks(spark):
    assert (len(ex.TRANSACTION_SUITE), len(ex.CUSTOMER_SUITE)) == (18, 10)


def test_suite_needs_one_scan(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze_of(raw(spark, *clean_rows())).write.parquet(path)
    results = validation.validate_transactions(spark.read.parquet(path))
    assert plan(results).count("FileScan") == 1
    assert "counterparty" not in plan(results).split("ReadSchema")[1]
    assert [r["position"] for r in results.collect()] == list(range(1, 19))


def test_summary_and_verdict(spark):
    rows = [{**r, "transaction_id": f"{r['transaction_id']}-{i}"} for i in range(20) for r in clean_rows()]
    results = validation.validate_transactions(bronze_of(raw(spark, *rows)))
    summary = one(ex.summarise(results))
    assert (summary["total"], summary["passed"], summary["success"]) == (18, 18, True)
    assert summary["success_pct"] == 100.0 and summary["failures"] == []

    failing = validation.validate_transactions(bronze_of(raw(spark, *dirty_rows())).drop("status"))
    summary = one(ex.summarise(failing))
    assert summary["failures"][0].startswith("column_exists(status) — columns=['transaction_id'")
    assert "values_in_set(status, mostly=0.98) — column missing" not in summary["failures"]
    assert "values_in_set(status) — column missing" in summary["failures"]
    assert "row_count_above(100) — actual=6" in summary["failures"]
    assert "no_nulls(amount, mostly=0.95) — null_rate=16.7%" in summary["failures"]
    both = ex.summarise(results).unionByName(ex.summarise(failing))
    assert one(ex.verdict(both))["success"] is False


def test_run_validation(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        validation.run_validation(spark, str(tmp_path))
    bronze_of(raw(spark, *clean_rows())).write.parquet(f"{tmp_path}/transactions")
    results = validation.run_validation(spark, str(tmp_path))
    assert {r["suite"] for r in results.collect()} == {"bronze_transactions"}


# --- table tests --------------------------------------------------------------


def test_counts_are_of_distinct_values(spark):
    rows = _numbers(spark, "1", "1", "1", "2", "2", "3", None, None)
    assert one(table_tests.unique(rows, "x"))["failures"] == 2
    assert one(table_tests.accepted_values(rows, "x", ("3",)))["failures"] == 2
    found = one(table_tests.not_null(rows, "x", "t"))
    assert (found["table_name"], found["failures"], found["should_warn"], found["should_error"]) == ("t", 2, True, True)
    assert one(table_tests.not_null(rows.filter("x is not null"), "x"))["should_error"] is False


def test_unaccepted_values_are_filtered_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    _numbers(spark, "1", "2").write.parquet(path)
    text = plan(table_tests.unaccepted_values(spark.read.parquet(path), "x", ("1",)))
    assert text.index("Exchange") < text.index("Filter")


def test_standard_tests(spark):
    assert len(table_tests.STANDARD_TESTS) == 10
    with pytest.raises(ValueError):
        table_tests.run_table_tests({"t": _numbers(spark, "1")}, [table_tests.TableTest("t", "other", "x")])


def test_refinement_passes_its_tests(spark, tmp_path):
    rows = bronze_of(raw(spark, *clean_rows(), *clean_rows()))
    customers = bronze.flag_customers(
        spark.createDataFrame([("c1",) + ("x",) * 8, ("c2",) + ("x",) * 8], schemas.CUSTOMERS)
    )
    done = run_refinement(spark, rows, customers, str(tmp_path), AT, "r1")
    assert done.silver.count() == CLEAN and done.gold.count() == 4
    tests = done.tests.collect()
    assert len(tests) == 10 and not any(r["should_error"] for r in tests)
    assert spark.table("stg_transactions").count() == 2 * CLEAN

    again = run_refinement(spark, bronze_of(raw(spark, *clean_rows()[:1])), customers, str(tmp_path), AT, "r2")
    assert again.silver.count() == CLEAN
    assert spark.table(silver.SILVER_TABLE).count() == CLEAN


def test_suites_at_the_edges(spark):
    odd = spark.createDataFrame([(1.0, "a"), (float("nan"), "a"), (float("nan"), None)], "`x.y` double, z string")
    assert ex.run_suite(odd, "none", []).count() == 0
    assert table_tests.run_table_tests({"t": odd}, []).count() == 0
    checks = [ex.unique("x.y"), ex.no_nulls("x.y"), ex.values_in_set("x.y", ("a", True)), ex.values_between("x.y", low=0), ex.not_negative("x.y"), ex.values_in_set("z", (1, False))]
    found = {r["check_name"].split("(")[0] + r["column_name"]: (r["success"], r["observed"]) for r in ex.run_suite(odd, "s", checks).collect()}
    assert found["uniquex.y"] == (True, 0.0) and found["values_in_setx.y"] == (False, 0.0) and found["values_in_setz"] == (False, 0.0)
    assert found["no_nullsx.y"][1] == pytest.approx(2 / 3) and found["values_betweenx.y"][0]
    assert one(table_tests.unique(odd, "x.y"))["failures"] == 1 and one(table_tests.not_null(odd, "x.y"))["failures"] == 0


def test_a_refinement_whose_gold_step_failed_resumes(spark, tmp_path, monkeypatch):
    names = warehouse.Names(*(f"{n}_{uuid.uuid4().hex}" for n in ("stg", "silver", "gold")))
    rows, customers = bronze_of(raw(spark, *clean_rows())), spark.createDataFrame([("c",) + ("x",) * 8], schemas.CUSTOMERS)
    gold_step = warehouse.run_gold
    monkeypatch.setattr(warehouse, "run_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_refinement(spark, rows, customers, str(tmp_path), AT, "r1", names)
    monkeypatch.setattr(warehouse, "run_gold", gold_step)
    assert run_refinement(spark, rows, customers, str(tmp_path), AT, "r1", names).gold.count() == 4
    with pytest.raises(ValueError, match="already has"):
        run_refinement(spark, rows, customers, str(tmp_path), AT, "r1", names)


def test_all_tests_of_a_table_share_a_scan_and_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"), F.when(F.col("id") > 3, 1.5).alias("c")).write.parquet(path)
    tests = [
        table_tests.TableTest("t", "unique", "a"), table_tests.TableTest("t", "unique", "b"), table_tests.TableTest("t", "not_null", "c"),
        table_tests.TableTest("t", "accepted_values", "b", ("1", "2")), table_tests.TableTest("t", "unique", "c"),
    ]
    found = table_tests.run_table_tests({"t": spark.read.parquet(path)}, tests)
    text = plan(found)
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert [r["failures"] for r in found.collect()] == [0, 7, 4, 5, 1]


def test_values_are_equal_as_their_types_say(spark):
    """One zero, NaN as one value, times by instant, texts as they are; arrays too."""
    rows = spark.sql(
        "select * from values (0.0D, timestamp'2024-01-01 00:00:00', 'a', array(1)), (-0.0D, timestamp'2024-01-01 00:00:00.000001', 'A', array(1)), "
        "(double('nan'), null, 'a ', array(2)), (double('nan'), null, null, null) as t(x, at, s, l)"
    )
    failures = {c: one(table_tests.unique(rows, c))["failures"] for c in ("x", "at", "s", "l")}
    assert failures == {"x": 2, "at": 0, "s": 0, "l": 1}


def test_uniqueness_checks_of_a_suite_share_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).select("id", (F.col("id") % 5).alias("g"), F.lit("x").alias("s")).write.parquet(path)
    found = ex.run_suite(spark.read.parquet(path), "s", [ex.unique("id"), ex.unique("g"), ex.no_nulls("s"), ex.unique("s")])
    assert plan(found).count("FileScan") == 2
    assert {r["position"]: r["observed"] for r in found.collect() if "unique" in r["check_name"]} == {1: 0.0, 2: 45.0, 4: 49.0}
