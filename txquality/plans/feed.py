"""A folder that JSON lines keep arriving in, taken into Bronze as deliveries.

Structured Streaming remembers which files it has taken; each micro-batch becomes one
delivery under the batch's number, replaced as a unit. A batch that is run again after a
failure therefore replaces itself, and a run that finds no new file adds nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality import schemas
from txquality.plans.bronze import (
    DELIVERY_COLUMN,
    PARTITION_COLUMNS,
    deliveries,
    flag_transactions,
    new_run,
    refuse_other_layout,
    with_audit,
)
from txquality.session import require_utc
from txquality.units import Units

REJECTED = T.StructType([T.StructField("line", T.StringType()), T.StructField("source_file", T.StringType())])
_BAD, _FILE = "_bad_line", "_file"


def rejects(bronze_dir: str) -> Units:
    """Lines that are no transaction, by delivery."""
    return Units(f"{bronze_dir}/rejected_transactions", DELIVERY_COLUMN)


def read_rejects(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """(line, source_file, _delivery_id) of all lines that were refused."""
    return rejects(bronze_dir).read(spark, REJECTED)


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Transactions of (value, _file), with the line itself where it does not parse.

    A line is bad if it is no JSON object or a field does not fit its type. Fields a line
    does not name are NULL, others that it names are ignored, and blank lines are no record.
    """
    with_bad = T.StructType([*schemas.TRANSACTIONS.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    whole = lines.filter(F.trim("value") != "").select(F.from_json("value", with_bad, options).alias("row"), "value", _FILE)
    # an array of objects gives no row of its own
    bad = F.when(F.col("row").isNull() | F.col(f"row.{_BAD}").isNotNull(), F.col("value"))
    return whole.select(*(F.col(f"row.{name}") for name in schemas.TRANSACTION_COLUMNS), bad.alias(_BAD), _FILE)


def run_feed(
    spark: SparkSession,
    feed_dir: str,
    bronze_dir: str,
    checkpoint_dir: str,
    feed: str = "feed",
    ingested_at: datetime | None = None,
    run_id: str | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Take all files that have arrived since the last run, then stop; returns how many batches there were.

    ``checkpoint_dir`` holds the feed's progress and lies on storage that all machines
    share. ``files_per_batch`` bounds a delivery's size. Files must appear whole, by a move.
    Lines that do not parse go to the rejects of the same delivery (``read_rejects``).
    """
    require_utc(spark)
    now, now_id = new_run()
    ingested_at, run_id = ingested_at or now, run_id or now_id
    refuse_other_layout(spark, bronze_dir, feed)
    done = []

    def take(lines: DataFrame, number: int) -> None:
        delivery = f"{feed}-{number:010d}"
        rows = parsed_lines(lines)
        refused = rows.filter(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"), F.col(_FILE).alias("source_file"))
        rejects(bronze_dir).replace(refused, delivery)
        good = rows.filter(F.col(_BAD).isNull()).select(*schemas.TRANSACTION_COLUMNS)
        flagged = with_audit(flag_transactions(good), feed_dir, ingested_at, run_id)
        deliveries(bronze_dir).replace(flagged, delivery, PARTITION_COLUMNS)
        done.append(number)

    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else spark.readStream
    lines = reader.text(feed_dir).select("value", F.col("_metadata.file_path").alias(_FILE))
    stream = lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    stream.awaitTermination()
    return len(done)
