"""Data tests on tables: not_null, unique and accepted_values.

Each result is one row: table, test, column, failures, should_warn, should_error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txquality import schemas
from txquality.functions.text import quoted
from txquality.operators.profile import value_counts
from txquality.operators.value_groups import REPEATED, ROWS, VALUES, Tested, can_group, count_groups


@dataclass(frozen=True)
class TableTest:
    table: str
    test: str
    column: str
    values: tuple[str, ...] = ()


# The tests on raw and Silver tables
STANDARD_TESTS = (
    TableTest("raw.transactions", "not_null", "transaction_id"),
    TableTest("raw.transactions", "not_null", "_ingestion_timestamp"),
    TableTest("raw.customers", "not_null", "customer_id"),
    TableTest("raw.customers", "unique", "customer_id"),
    TableTest("silver.transactions", "not_null", "transaction_id"),
    TableTest("silver.transactions", "unique", "transaction_id"),
    TableTest("silver.transactions", "not_null", "amount"),
    TableTest("silver.transactions", "accepted_values", "currency", schemas.CURRENCIES),
    TableTest("silver.transactions", "accepted_values", "status", schemas.STATUSES),
    TableTest("silver.transactions", "not_null", "is_completed"),
)


RESULT = "table_name string, test_name string, column_name string, failures long, should_warn boolean, should_error boolean"


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Each value that occurs more than once, with its rows; NULL is not a value."""
    present = df.filter(F.col(quoted(column)).isNotNull())
    return value_counts(present, quoted(column)).filter(F.col("n_records") > 1)


def unaccepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Each value outside ``values``, with its rows; NULL passes.

    The condition is on the grouping key, so it is applied before the shuffle.
    """
    return value_counts(df, quoted(column)).filter(~F.col("value_field").isin(*values))


def not_null(df: DataFrame, column: str, table: str = "") -> DataFrame:
    return run_table_tests({table: df}, [TableTest(table, "not_null", column)])


def unique(df: DataFrame, column: str, table: str = "") -> DataFrame:
    return run_table_tests({table: df}, [TableTest(table, "unique", column)])


def accepted_values(df: DataFrame, column: str, values: Sequence[str], table: str = "") -> DataFrame:
    return run_table_tests({table: df}, [TableTest(table, "accepted_values", column, tuple(values))])


def run_table_tests(
    tables: Mapping[str, DataFrame], tests: Sequence[TableTest] = STANDARD_TESTS
) -> DataFrame:
    """Results of all tests as one table.

    All tests of a table share one scan and one shuffle; only values without a text
    of their own (arrays, structs) are grouped by a branch that reads the table again.
    """
    if not tests:
        return next(iter(tables.values())).sparkSession.createDataFrame([], RESULT)
    parts = []
    for table in dict.fromkeys(t.table for t in tests):
        own = [t for t in tests if t.table == table]
        apart = [t for t in own if t.test == "unique" and not can_group(tables[table], t.column)]
        together = [t for t in own if t not in apart]
        if together:
            parts.append(_counted_together(tables[table], together))
        parts.extend(_repeated(tables[table], t) for t in apart)
    return reduce(DataFrame.unionByName, parts)


def _counted_together(df: DataFrame, tests: Sequence[TableTest]) -> DataFrame:
    names = [f"n{i}" for i in range(len(tests))]
    counted = count_groups(df, [_tested(df, t) for t in tests], names)
    return counted.select(F.inline(F.array(*(_result(t, F.col(name)) for t, name in zip(tests, names)))))


def _tested(df: DataFrame, test: TableTest) -> Tested:
    column = F.col(quoted(test.column))
    if test.test == "not_null":
        return Tested(ROWS, column.isNull())
    if test.test == "unique":
        return Tested(REPEATED, column.isNotNull(), test.column)
    if test.test == "accepted_values":
        return Tested(VALUES, ~column.isin(*test.values), test.column)
    raise ValueError(f"unknown table test: {test.test}")


def _repeated(df: DataFrame, test: TableTest) -> DataFrame:
    counted = repeated_values(df, test.column).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.inline(F.array(_result(test, F.col("n")))))


def _result(test: TableTest, failures: Column) -> Column:
    return F.struct(
        F.lit(test.table).alias("table_name"),
        F.lit(test.test).alias("test_name"),
        F.lit(test.column).alias("column_name"),
        failures.alias("failures"),
        (failures != 0).alias("should_warn"),
        (failures != 0).alias("should_error"),
    )
