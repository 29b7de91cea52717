"""Session defaults and shared scratch space."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ZONE, UTC = "spark.sql.session.timeZone", "UTC"
UTC_NAMES = (UTC, "Etc/UTC", "Z", "+00:00", "GMT")

# Dates are compared and truncated in UTC. Adaptive execution coalesces small
# shuffle partitions, splits skewed ones and sizes the files of rebalanced writes.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "txquality", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's defaults.

    Whatever the submit command or ``settings`` names wins over a default, but
    for the zone, which is always UTC; sizes that depend on the cluster
    (executors, shuffle partitions) are left to it. All defaults are settings
    that can be made once the session runs, when what was given is known.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in SESSION_DEFAULTS.items():
        if not given.contains(key) and key not in settings:
            spark.conf.set(key, value)
    spark.conf.set(ZONE, UTC)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Dates are parsed, cut and compared in the session's zone, so every job holds it to UTC."""
    zone = spark.conf.get(ZONE)
    if zone not in UTC_NAMES:
        raise ValueError(f"the session's zone is {zone}; this job needs {UTC}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any file system Spark reads; nothing in it is listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset and all runs on one machine (a test) a temporary
    folder is made, and removed when the process ends. On a cluster the folder
    must be named: other machines don't see this one's temporary folders.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="txquality-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    _MADE.append(f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


_MADE: list[str] = []


def scratch_made() -> int:
    """How many scratch tables there are; ``clear_scratch`` can begin after them."""
    return len(_MADE)


def clear_scratch(spark: SparkSession, after: int = 0, keep_last: bool = False) -> None:
    """Delete what this process has put into scratch space, once no table that is read from it is needed.

    Only what was made after the first ``after`` tables goes, and with ``keep_last`` not the last one.
    """
    last = [_MADE.pop()] if keep_last and len(_MADE) > after else []
    while len(_MADE) > after:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _MADE.extend(last)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in scratch space and read back.

    Use where several actions or branches need the same intermediate result:
    the rows are computed once, later reads prune columns, and a lost executor
    costs a re-read rather than a recomputation of the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
