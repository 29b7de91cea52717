"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; NULL keys form one group.

    All other columns break ties, so a task that is run again keeps the same
    row. The planner limits groups to one row per task before the shuffle and
    once more after it, so a key with very many versions never meets in one task.
    """
    rest = [F.col(name).desc_nulls_last() for name in df.columns if name not in keys]
    window = Window.partitionBy(*keys).orderBy(*newest_first, *rest)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def newest_created(df: DataFrame) -> DataFrame:
    """One row per transaction id, the last created."""
    return newest_per_key(df, ["transaction_id"], [F.col("created_at").desc_nulls_last()])
