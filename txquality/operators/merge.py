"""Insert-or-replace of rows by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(target: DataFrame, source: DataFrame, key: str, source_is_unique: bool = False) -> DataFrame:
    """``source`` rows replace ``target`` rows of the same key; all others stay.

    One full outer join: the source is computed once and each side is shuffled
    at most once, not at all where it is already laid out by key (after a window
    on the key, or read from a table bucketed by it). Keys are unique on both
    sides, so no key is hot.
    """
    target = target.select(*source.columns)
    checked = source if source_is_unique else refuse_bad_keys(source, key)
    # a marker tells the sides apart, as a key vouched for as unique may be NULL once
    new, old = checked.withColumn("_from_new", F.lit(True)).alias("new"), target.alias("old")
    from_new = F.col("new._from_new").isNotNull()
    return new.join(old, F.col(f"new.{key}") == F.col(f"old.{key}"), "full_outer").select(
        *(
            F.when(from_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
            for name in source.columns
        )
    )


def merge_batch(target: DataFrame, batch: DataFrame, key: str, batch_is_unique: bool = False) -> DataFrame:
    """Same result as ``merge``, for a small stored batch and a target without buckets.

    The batch is read twice, so it must be a stored table. If its keys are
    below the session's broadcast threshold the target is not shuffled at all,
    else the anti join shuffles both sides. Against a target bucketed by key
    ``merge`` shuffles the batch alone, whatever its size, and its result can be
    bucketed again as it is.
    """
    checked = batch if batch_is_unique else refuse_bad_keys(batch, key)
    untouched = target.select(*batch.columns).join(batch.select(key), key, "left_anti")
    return checked.unionByName(untouched)


def refuse_bad_keys(df: DataFrame, key: str) -> DataFrame:
    """``df``, failing at run time on a NULL key or one that occurs twice."""
    present = df.filter(_must(F.col(key).isNotNull(), f"merge source has a NULL {key}"))
    by_key = Window.partitionBy(key).orderBy(key)
    numbered = present.withColumn("_occurrence", F.row_number().over(by_key))
    once = _must(F.col("_occurrence") == 1, f"merge source repeats a {key}")
    return numbered.filter(once).drop("_occurrence")


def _must(condition: Column, message: str) -> Column:
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
