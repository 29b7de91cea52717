import uuid
from datetime import timedelta
from decimal import Decimal

import pytest

from tests.helpers import AT, plan, raw, staged_of
from txquality import schemas
from txquality.operators.merge import merge, merge_batch
from txquality.plans import silver
from txquality.sinks import _registered, publish, published, published_buckets

SCHEMA = "k string, v int"


def _rows(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


@pytest.fixture(params=[merge, merge_batch])
def merging(request):
    return request.param


def test_matched_rows_are_replaced_and_others_stay(spark, merging):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], SCHEMA)
    source = spark.createDataFrame([("b", 20), ("d", 40), ("c", 3), ("a", None)], SCHEMA)
    assert sorted(map(str, _rows(merging(target, source.filter("k != 'a'"), "k")))) == sorted(
        map(str, [("a", 1), ("b", 20), ("c", 3), ("d", 40)])
    )
    replaced_by_null = merging(target, source.filter("k = 'a'"), "k").filter("k = 'a'")
    assert _rows(replaced_by_null) == [("a", None)]


def test_empty_sides(spark, merging):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([("a", 1)], SCHEMA)
    assert _rows(merging(empty, some, "k")) == _rows(merging(some, empty, "k")) == [("a", 1)]


@pytest.mark.parametrize("keys", [["a", "a"], ["a", None]])
def test_bad_source_keys_are_refused(spark, merging, keys):
    target = spark.createDataFrame([("z", 0)], SCHEMA)
    source = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], SCHEMA)
    with pytest.raises(Exception, match="merge source"):
        merging(target, source, "k").collect()


def test_silver_merge_shuffles_the_load_once_and_the_table_never(spark, tmp_path):
    table = f"silver_{uuid.uuid4().hex}"
    assert published(spark, table, str(tmp_path)) is None
    load = staged_of(raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"}))
    silver.run_silver(spark, load, str(tmp_path), AT, "s1", table)

    newer = staged_of(raw(spark, {"transaction_id": "b", "amount": 5.0}, {"transaction_id": "c"}), AT + timedelta(days=1))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge(spark.table(table), silver.silver(newer, AT), "transaction_id", source_is_unique=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange") == 1
    assert "Bucketed: true" in text

    merged = silver.run_silver(spark, newer, str(tmp_path), AT, "s2", table)
    assert sorted((r["transaction_id"], r["amount"]) for r in merged.collect()) == [
        ("a", Decimal("100.0000")), ("b", Decimal("5.0000")), ("c", Decimal("100.0000")),
    ]
    # the snapshot before is still whole
    assert spark.table(_registered(table, str(tmp_path), "s1")).count() == 2
    assert spark.table(table).count() == 3


def test_failed_merge_leaves_the_table(spark, tmp_path):
    table = f"silver_{uuid.uuid4().hex}"
    silver.run_silver(spark, staged_of(raw(spark, {})), str(tmp_path), AT, "s1", table)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        silver.run_silver(spark, staged_of(raw(spark, {"amount": 1e15})), str(tmp_path), AT, "s2", table)
    assert spark.table(table).count() == 1


def test_a_session_without_the_table_finds_it(spark, tmp_path):
    table = f"silver_{uuid.uuid4().hex}"
    load = staged_of(raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"}))
    silver.run_silver(spark, load, str(tmp_path), AT, "s1", table)
    spark.sql(f"DROP VIEW {table}")
    spark.sql(f"DROP TABLE {_registered(table, str(tmp_path), 's1')}")

    found = published(spark, table, str(tmp_path))
    assert found.count() == 2 and list(found.columns) == list(schemas.SILVER_COLUMNS)
    assert "Bucketed: true" in plan(found.groupBy("transaction_id").count())
    later = staged_of(raw(spark, {"transaction_id": "c"}), AT + timedelta(days=1))
    assert silver.run_silver(spark, later, str(tmp_path), AT, "s2", table).count() == 3
    with pytest.raises(ValueError):
        silver.run_silver(spark, later, str(tmp_path), AT, "s2", table)


def test_one_name_under_two_locations(spark, tmp_path):
    """The other location's rows are never read or merged; the clash of names is an error."""
    here, there = str(tmp_path / "here"), str(tmp_path / "there")
    name = f"silver_{uuid.uuid4().hex}"
    publish(spark.createDataFrame([(1,)], "a int"), name, here, "s1")
    with pytest.raises(ValueError, match="another location"):
        publish(spark.createDataFrame([(2,)], "a int"), name, there, "s1")
    with pytest.raises(ValueError, match="another location"):
        published(spark, name, there)
    spark.sql(f"DROP VIEW {name}")
    assert published(spark, name, there) is None
    publish(spark.createDataFrame([(2,)], "a int"), name, there, "s1")
    assert [r["a"] for r in published(spark, name, there).collect()] == [2]
    spark.sql(f"DROP VIEW {name}")
    assert [r["a"] for r in published(spark, name, here).collect()] == [1]


def test_a_listed_snapshot_id_is_refused(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    for number in ("s1", "s2"):
        publish(spark.createDataFrame([(number,)], "a string"), name, str(tmp_path), number)
    for number in ("s1", "s2"):
        with pytest.raises(ValueError, match="already has"):
            publish(spark.createDataFrame([("x",)], "a string"), name, str(tmp_path), number)
    assert spark.table(_registered(name, str(tmp_path), "s1")).first()["a"] == "s1"


def test_the_table_keeps_its_buckets_and_is_never_shuffled(spark, tmp_path):
    table = f"silver_{uuid.uuid4().hex}"
    rows = [{"transaction_id": f"t{i}"} for i in range(20)]
    silver.run_silver(spark, staged_of(raw(spark, *rows)), str(tmp_path), AT, "s1", table, buckets=3)
    later = staged_of(raw(spark, *rows[:5], {"transaction_id": "new"}), AT + timedelta(days=1))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        load = silver.silver(later, AT).repartition(3, "transaction_id")
        text = plan(merge(published(spark, table, str(tmp_path)), load, "transaction_id", source_is_unique=True))
        scan = text.index("Bucketed: true")
        join = text[text.index("SortMergeJoin") : scan]
        assert "Exchange" not in join[join.rindex("+- Sort") :]
        assert silver.run_silver(spark, later, str(tmp_path), AT, "s2", table).count() == 21
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    assert published_buckets(spark, str(tmp_path)) == 3
    with pytest.raises(ValueError, match="has 3 buckets"):
        silver.run_silver(spark, later, str(tmp_path), AT, "s3", table, buckets=4)


def test_a_null_key_vouched_for_keeps_its_row(spark):
    source = spark.createDataFrame([(None, "n"), ("b", "new")], "key string, v string")
    target = spark.createDataFrame([("a", "old"), ("b", "old")], "key string, v string")
    found = merge(target, source, "key", source_is_unique=True).collect()
    assert sorted(map(repr, map(tuple, found))) == ["('a', 'old')", "('b', 'new')", "(None, 'n')"]
