"""Summaries of a layer, each in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txquality.functions.dates import calendar_date
from txquality.functions.money import ratio


def _percent(part: str, whole: str) -> Column:
    return ratio(F.col(part), F.col(whole)) * F.lit(100.0)


def dq_summary(df: DataFrame, entity: str) -> DataFrame:
    """Rows with and without issues. NULL is no issue; percentages of nothing are NULL."""
    return _shares(df.agg(*(column.alias(name) for name, column in issue_counts().items())), entity)


def issue_counts() -> dict[str, Column]:
    """The aggregates a summary needs, by name; a write can take them as it goes."""
    return {"total_rows": F.count(F.lit(1)), "issue_rows": F.count_if(F.col("dq_has_issues"))}


def observed_summary(spark: SparkSession, counts: Mapping[str, int], entity: str) -> DataFrame:
    """The summary of counts that a write has taken; nothing is read."""
    return _shares(spark.range(1).select(*(F.lit(counts[name]).cast("long").alias(name) for name in issue_counts())), entity)


def _shares(counts: DataFrame, entity: str) -> DataFrame:
    return counts.select(
        F.lit(entity).alias("entity"),
        "total_rows",
        (F.col("total_rows") - F.col("issue_rows")).alias("clean_rows"),
        "issue_rows",
    ).withColumns(
        {
            "clean_pct": _percent("clean_rows", "total_rows"),
            "issue_pct": _percent("issue_rows", "total_rows"),
        }
    )


def rows_with_issues(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dq_has_issues"))


def issue_profile(df: DataFrame) -> DataFrame:
    """Missing amounts, negative amounts and missing customers of raw transactions."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("amount").isNull()).alias("null_amounts"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customers"),
    )
    return counts.withColumns(
        {
            "null_amount_pct": _percent("null_amounts", "total_rows"),
            "negative_amount_pct": _percent("negative_amounts", "total_rows"),
            "null_customer_pct": _percent("null_customers", "total_rows"),
        }
    )


def coverage(df: DataFrame, kept: Column) -> DataFrame:
    """Share of rows that meet ``kept``; a NULL condition does not."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(kept).alias("kept_rows"),
    )
    return counts.withColumn("coverage", ratio(F.col("kept_rows"), F.col("total_rows")))


def completed_vs_other(df: DataFrame) -> DataFrame:
    """Completed rows, all others (a NULL status is other) and the total."""
    completed = F.col("status").eqNullSafe(F.lit("COMPLETED"))
    return df.agg(
        F.count_if(completed).alias("completed_rows"),
        F.count_if(~completed).alias("other_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def day_currency_totals(df: DataFrame) -> DataFrame:
    """Sum of amount by calendar day (of the date text) and currency.

    Rows without a day or a currency are in no group; a group without any
    amount sums to 0.
    """
    dated = df.withColumn("transaction_day", calendar_date("transaction_date"))
    grouped = dated.filter(F.col("transaction_day").isNotNull() & F.col("currency").isNotNull())
    return grouped.groupBy("transaction_day", "currency").agg(
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total")
    )


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per value of a column, NULL included."""
    return df.groupBy(F.col(name).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
