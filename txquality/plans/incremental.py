"""Silver and Gold for loads that touch a small part of a large history.

Silver lies in buckets by key, each a unit that is replaced as a whole: a load reads and
writes the buckets that its keys fall into, and all others are carried over as they are.
The merge also leaves the days of the old and the new versions of the keys it touched;
Gold, whose units are months, aggregates those days again and carries the other days of
their months over as they are; other months are not touched. For loads that touch most buckets
``run_silver`` and ``run_gold`` do the same with less shuffling.

One writer at a time. The days are stored before Silver changes and are only taken off the
list after Gold has been written, so a run that stops half-way costs a day that is
aggregated once more, never one that is missed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality import schemas
from txquality.operators.merge import merge
from txquality.plans.gold import gold
from txquality.plans.silver import silver
from txquality.plans.staging import staging
from txquality.session import clear_scratch, require_utc, scratch_made, stored
from txquality.units import Units

BUCKET_COLUMN = "_bucket"
MONTH_COLUMN = "_month"
DAY_COLUMN = "_day"
LOAD_COLUMN = "_load"
# rows of a bucket lie by day, so that a read of few days skips most of its pages
DAY = "transaction_day"
_DAYS = T.StructType([T.StructField(DAY_COLUMN, T.StringType())])
_NO_TIME = datetime(1970, 1, 1)


def silver_buckets(warehouse_dir: str) -> Units:
    return Units(f"{warehouse_dir}/silver", BUCKET_COLUMN, together=True)


def gold_months(warehouse_dir: str) -> Units:
    return Units(f"{warehouse_dir}/gold", MONTH_COLUMN, together=True)


def changed_days(warehouse_dir: str) -> Units:
    """By load, the days whose Silver rows it changed; empty once Gold has them."""
    return Units(f"{warehouse_dir}/changed_days", LOAD_COLUMN, together=True)


def _silver_schema(spark: SparkSession) -> T.StructType:
    return silver(staging(spark.createDataFrame([], schemas.BRONZE_TRANSACTIONS)), _NO_TIME).schema


def _gold_schema(spark: SparkSession) -> T.StructType:
    return gold(spark.createDataFrame([], _silver_schema(spark)), _NO_TIME).schema


def read_silver(spark: SparkSession, warehouse_dir: str) -> DataFrame:
    return silver_buckets(warehouse_dir).read(spark, _silver_schema(spark)).drop(BUCKET_COLUMN)


def read_gold(spark: SparkSession, warehouse_dir: str) -> DataFrame:
    return gold_months(warehouse_dir).read(spark, _gold_schema(spark)).drop(MONTH_COLUMN)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(schemas.SILVER_KEY), F.lit(buckets)).cast("string")


def _day_id() -> Column:
    return F.date_format(DAY, "yyyy-MM-dd")


def merge_load(
    spark: SparkSession,
    staged: DataFrame,
    warehouse_dir: str,
    loaded_at: datetime,
    load_id: str,
    buckets: int | None = None,
) -> list[str]:
    """Merge a staged load into Silver's buckets; returns the buckets that were written.

    The first load makes the table, with ``buckets`` buckets (by default the session's
    shuffle partitions), which later loads keep. A load without a valid row changes nothing.
    """
    require_utc(spark)
    table, made = silver_buckets(warehouse_dir), scratch_made()
    have = len(table.current(spark))
    if have and buckets and buckets != have:
        raise ValueError(f"the table has {have} buckets; another number takes a rewrite of it")
    count = have or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    load = stored(silver(staged, loaded_at).withColumn(BUCKET_COLUMN, _bucket(count)), "silver-load")
    # at most one row for each bucket
    touched = sorted(r[0] for r in load.select(BUCKET_COLUMN).distinct().collect())
    if touched:
        before = table.read(spark, _silver_schema(spark), touched)
        old = before.select(schemas.SILVER_KEY, DAY).join(load.select(schemas.SILVER_KEY), schemas.SILVER_KEY, "left_semi")
        days = load.select(_day_id().alias(DAY_COLUMN)).union(old.select(_day_id())).distinct()
        changed_days(warehouse_dir).replace_each(days.withColumn(LOAD_COLUMN, F.lit(load_id)), [load_id])
        merged = merge(before.drop(BUCKET_COLUMN), load.drop(BUCKET_COLUMN), schemas.SILVER_KEY, source_is_unique=True)
        written = touched if have else [str(i) for i in range(count)]
        table.replace_each(merged.withColumn(BUCKET_COLUMN, _bucket(count)), written, sort=[DAY])
    clear_scratch(spark, made)
    return touched


def refresh_gold(spark: SparkSession, warehouse_dir: str, loaded_at: datetime) -> list[str]:
    """Aggregate again the days that loads have changed since Gold was last written; returns them.

    Other days keep their rows and the time they were loaded at; a day whose rows are all
    gone becomes empty.
    """
    require_utc(spark)
    pending = changed_days(warehouse_dir)
    loads = sorted(load for load, (_, rows) in pending.current(spark).items() if rows)
    if not loads:
        return []
    # bounded by the calendar
    days = sorted(r[0] for r in pending.read(spark, _DAYS, loads).select(DAY_COLUMN).distinct().collect())
    chosen = F.col(DAY).isin([datetime.strptime(day, "%Y-%m-%d") for day in days])
    table, months = gold_months(warehouse_dir), sorted({day[:7] for day in days})
    again = gold(read_silver(spark, warehouse_dir).filter(chosen), loaded_at)
    kept = table.read(spark, again.schema, months).drop(MONTH_COLUMN).filter(~chosen)
    rows = again.unionByName(kept).withColumn(MONTH_COLUMN, F.date_format(DAY, "yyyy-MM"))
    table.replace_each(rows, months, sort=[DAY])
    nothing = spark.createDataFrame([], _DAYS).withColumn(LOAD_COLUMN, F.lit(None).cast("string"))
    pending.replace_each(nothing, loads)
    return days
