"""Counts by value of several columns of a table, from one scan and one shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality.functions.text import quoted

ROWS, VALUES, REPEATED, SURPLUS = "rows", "values", "repeated", "surplus"


@dataclass(frozen=True)
class Tested:
    """What to count: the rows that meet a condition, their values, those that repeat, or rows beyond a value's first."""

    measure: str
    condition: Column
    column: str | None = None


def can_group(df: DataFrame, column: str) -> bool:
    """Whether the column's values have a text of their own."""
    plain = (T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(df.schema[column].dataType, plain)


def _as_text(df: DataFrame, column: str | None) -> Column:
    """Text that is equal exactly where values are equal."""
    if column is None:
        return F.lit("")
    kind, value = df.schema[column].dataType, F.col(quoted(column))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(kind)  # one zero
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def count_groups(df: DataFrame, tests: Sequence[Tested], names: Sequence[str]) -> DataFrame:
    """One row with the count of each test under its name."""
    return measured(grouped(df, tests), tests, names)


def grouped(df: DataFrame, tests: Sequence[Tested], by: Sequence[str] = ()) -> DataFrame:
    """(by, test, value, n): rows that meet each test's condition, by value.

    A row yields an entry for each condition that it meets; entries are counted by
    test and value before the shuffle, so a value that fills the table is one row of
    each task, and a test that only counts rows is too. Counts of parts of a table,
    added up by test and value, are those of the whole.
    """
    entries = F.array(
        *(
            F.when(t.condition, F.struct(F.lit(i).alias("test"), _as_text(df, None if t.measure == ROWS else t.column).alias("value")))
            for i, t in enumerate(tests)
        )
    )
    return df.select(*by, F.explode(F.array_compact(entries)).alias("entry")).groupBy(*by, "entry.test", "entry.value").agg(F.count(F.lit(1)).alias("n"))


def measured(groups: DataFrame, tests: Sequence[Tested], names: Sequence[str]) -> DataFrame:
    """One row with the count of each test, from the groups of a whole table."""
    n = F.col("n")
    total = {ROWS: n, VALUES: F.lit(1), REPEATED: (n > 1).cast("int"), SURPLUS: n - 1}
    return groups.agg(
        *(
            F.coalesce(F.sum(F.when(F.col("test") == i, total[t.measure])), F.lit(0)).cast("long").alias(name)
            for i, (t, name) in enumerate(zip(tests, names))
        )
    )
