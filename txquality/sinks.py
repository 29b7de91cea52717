"""Writes: partitioned and plain Parquet, views, and tables published by snapshot."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from txquality.sources.files import if_present


# an observation and the aggregates by name that it takes of the rows as they are written
Observed = tuple[Observation, dict[str, Column]]


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], rebalance: bool = True, observed: Observed | None = None
) -> None:
    """Write by partition; a rerun replaces the partitions it holds and no others.

    Rows without a partition value keep a partition of their own. Rebalancing
    shuffles rows by partition so that each gets few large files; a partition
    far above the advisory size is split among tasks, and small ones share a
    task. Pass ``rebalance=False`` where the input is already laid out by
    partition to save the shuffle.

    ``observed`` aggregates are taken by the tasks that write, above the shuffle,
    so a task that fails and runs again counts once.
    """
    laid_out = df.hint("rebalance", *columns) if rebalance and columns else df
    writer = _watched(laid_out, observed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def write_plain(df: DataFrame, path: str, observed: Observed | None = None) -> None:
    _watched(df, observed).write.mode("overwrite").parquet(path)


def _watched(df: DataFrame, observed: Observed | None) -> DataFrame:
    if observed is None:
        return df
    observation, aggregates = observed
    return df.observe(observation, *(column.alias(name) for name, column in aggregates.items()))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy table under a name for the session."""
    df.createOrReplaceTempView(name)
    return df


def publish(
    df: DataFrame,
    name: str,
    location: str,
    snapshot_id: str,
    key: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write a new snapshot of table ``name`` under ``location`` and make it current.

    Readers see the snapshot before until the write has succeeded, and a failed
    write leaves it in place. Old snapshots stay until their owner drops them.
    With ``key`` and ``buckets`` rows are bucketed, so the next merge by that key
    reads this table without shuffling it. That wants rows laid out by key (by a
    window or join on it) in as many partitions as there are buckets: then each
    bucket is one file. One writer per table at a time.

    A table is known by its name and its location. A snapshot id that the
    location's list holds is refused, whether it is the last one or not, and so
    is a name whose view shows a table of another location.
    """
    if not re.fullmatch(r"\w+", snapshot_id):
        raise ValueError("a snapshot id holds letters, digits and underscores only")
    spark = df.sparkSession
    _refuse_foreign_view(spark, name, location)
    last = _last_snapshot(spark, location)
    if last and has_snapshot(spark, location, snapshot_id):
        raise ValueError(f"{name} already has a snapshot {snapshot_id}")
    writer = (
        df.write.format("parquet")
        .mode("overwrite")
        .option("path", f"{location.rstrip('/')}/{snapshot_id}")
    )
    if key and buckets:
        writer = writer.bucketBy(buckets, key)
    table = _registered(name, location, snapshot_id)
    writer.saveAsTable(table)
    entry = spark.range(1).select(
        F.lit(last["number"] + 1 if last else 1).alias("number"),
        F.lit(snapshot_id).alias("snapshot_id"),
        F.lit(key).alias("key"),
        F.lit(buckets).alias("buckets"),
    )
    entry.coalesce(1).write.mode("append").json(_log(location))
    return _point(spark, name, table, location)


def published(spark: SparkSession, name: str, location: str) -> DataFrame | None:
    """The current snapshot of a published table, None before its first one.

    The list of snapshots lies with the data, so a session whose catalog does
    not know the table yet (a new one without a shared metastore) registers it,
    buckets included, under a name that the location is part of.
    """
    _refuse_foreign_view(spark, name, location)
    last = _last_snapshot(spark, location)
    if last is None:
        return None
    table, path = _registered(name, location, last["snapshot_id"]), f"{location.rstrip('/')}/{last['snapshot_id']}"
    if not spark.catalog.tableExists(table):
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema
        )
        clustered = ""
        if last["buckets"]:
            clustered = f"CLUSTERED BY (`{last['key']}`) INTO {last['buckets']} BUCKETS"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {clustered} LOCATION '{path}'")
    return _point(spark, name, table, location)


def published_buckets(spark: SparkSession, location: str) -> int | None:
    """The number of buckets that the current snapshot has."""
    last = _last_snapshot(spark, location)
    return last["buckets"] if last else None


def has_snapshot(spark: SparkSession, location: str, snapshot_id: str) -> bool:
    entries = _snapshots(spark, location)
    return entries is not None and bool(entries.filter(F.col("snapshot_id") == snapshot_id).head(1))


def is_current(spark: SparkSession, location: str, snapshot_id: str) -> bool:
    last = _last_snapshot(spark, location)
    return last is not None and last["snapshot_id"] == snapshot_id


LOCATION_PROPERTY = "txquality.location"


def _home(location: str) -> str:
    return hashlib.sha256(location.rstrip("/").encode()).hexdigest()[:16]


def _registered(name: str, location: str, snapshot_id: str) -> str:
    return f"{name}__{snapshot_id}__{_home(location)}"


def _refuse_foreign_view(spark: SparkSession, name: str, location: str) -> None:
    if not spark.catalog.tableExists(name):
        return
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if known.get(LOCATION_PROPERTY) != _home(location):
        raise ValueError(f"{name} is in use for a table of another location than {location}")


def _point(spark: SparkSession, name: str, table: str, location: str) -> DataFrame:
    home = f"TBLPROPERTIES ('{LOCATION_PROPERTY}' = '{_home(location)}')"
    spark.sql(f"CREATE OR REPLACE VIEW {name} {home} AS SELECT * FROM {table}")
    return spark.table(name)


SNAPSHOT = "number long, snapshot_id string, key string, buckets int"


def _log(location: str) -> str:
    return f"{location.rstrip('/')}/_snapshots"


def _snapshots(spark: SparkSession, location: str) -> DataFrame | None:
    return if_present(lambda: spark.read.schema(SNAPSHOT).json(_log(location)))


def _last_snapshot(spark: SparkSession, location: str) -> Row | None:
    """The newest entry of a table's list, which has one small row per run."""
    entries = _snapshots(spark, location)
    return None if entries is None else entries.orderBy(F.col("number").desc()).first()
