"""Expectations with tolerance: declared checks, one aggregation per suite.

Each check adds its aggregates to a single pass over the table; the pass yields
one row that is turned into one result row per check. Uniqueness needs a group
per value, so all such checks share a second, narrow aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality import schemas
from txquality.functions.money import ratio
from txquality.functions.text import number_or_null, quoted
from txquality.operators.value_groups import SURPLUS, Tested, can_group, count_groups, grouped, measured


@dataclass(frozen=True)
class Check:
    """One expectation. ``mostly`` is the least share of rows that must pass."""

    kind: str
    column: str | None = None
    mostly: float = 1.0
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    rows: int = 0

    @property
    def name(self) -> str:
        # fixed values: the labels of checks, which are part of the results
        if self.kind == "row_count_above":
            return f"row_count_above({self.rows})"
        if self.kind == "values_between":
            return f"values_between({self.column}, min={self.low}, max={self.high})"
        if self.kind in ("column_exists", "unique"):
            return self.short_name
        return f"{self.kind}({self.column}, mostly={self.mostly})"

    @property
    def short_name(self) -> str:
        """The name without limits, as reported where the column is absent."""
        return f"{self.kind}({self.column})"


def column_exists(column: str) -> Check:
    return Check("column_exists", column)


def no_nulls(column: str, mostly: float = 1.0) -> Check:
    return Check("no_nulls", column, mostly)


def unique(column: str) -> Check:
    return Check("unique", column)


def values_in_set(column: str, values: Sequence[str], mostly: float = 1.0) -> Check:
    return Check("values_in_set", column, mostly, values=tuple(values))


def values_between(
    column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0
) -> Check:
    return Check("values_between", column, mostly, low=low, high=high)


def row_count_above(rows: int) -> Check:
    return Check("row_count_above", rows=rows)


def not_negative(column: str, mostly: float = 1.0) -> Check:
    return Check("not_negative", column, mostly)


# The two standard suites and their tolerances
TRANSACTION_SUITE = (
    *(
        column_exists(name)
        for name in (
            "transaction_id", "customer_id", "amount", "currency", "status",
            "transaction_type", "transaction_date", "dq_has_issues",
            "_ingestion_timestamp", "_pipeline_layer",
        )
    ),
    row_count_above(100),
    no_nulls("transaction_id", 0.99),
    no_nulls("amount", 0.95),
    values_in_set("currency", schemas.CURRENCIES, 0.97),
    values_in_set("status", schemas.STATUSES, 0.98),
    values_in_set("transaction_type", schemas.TRANSACTION_TYPES, 0.99),
    not_negative("amount", 0.97),
    values_in_set("_pipeline_layer", (schemas.BRONZE_LAYER,), 1.0),
)
CUSTOMER_SUITE = (
    *(
        column_exists(name)
        for name in ("customer_id", "email", "account_type", "risk_rating", "_pipeline_layer")
    ),
    row_count_above(10),
    no_nulls("customer_id", 1.0),
    no_nulls("email", 0.99),
    values_in_set("account_type", schemas.ACCOUNT_TYPES, 1.0),
    values_in_set("risk_rating", schemas.RISK_RATINGS, 1.0),
)
TRANSACTION_SUITE_NAME = "bronze_transactions"
CUSTOMER_SUITE_NAME = "bronze_customers"


@dataclass
class _Compiled:
    """Aggregates a check needs, and its result over them."""

    success: Column
    observed: Column
    detail: Column
    aggregates: dict[str, Column] = field(default_factory=dict)
    name: str | None = None


RESULT = (
    "suite string, position int, check_name string, column_name string, mostly double, observed double, "
    "detail string, success boolean"
)


def run_suite(df: DataFrame, suite: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check, ``position`` giving the order of the suite.

    Columns: suite, position, check_name, column_name, mostly, observed (a rate
    or a count), detail, success. A check on an absent column fails.
    """
    shared: dict[str, Column] = {"_rows": F.count(F.lit(1))}
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT)
    rows = []
    parts = []
    unique_checks = {}
    for position, check in enumerate(checks, start=1):
        if check.kind == "unique" and check.column in df.columns:
            if can_group(df, check.column):
                unique_checks[position] = check
            else:
                parts.append(_unique_result(df, suite, position, check))
            continue
        compiled = _compile(df, check, f"_c{position}")
        shared |= compiled.aggregates
        rows.append(_result(suite, position, check, compiled))
    if rows:
        once = df.agg(*(aggregate.alias(name) for name, aggregate in shared.items()))
        parts.insert(0, once.select(F.inline(F.array(*rows))))
    if unique_checks:
        parts.append(_unique_results(df, suite, unique_checks))
    return reduce(DataFrame.unionByName, parts)


def partial_counts(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """The suite's counts for each group of ``by``: one row that ``merged_suite`` can add to others."""
    return df.groupBy(*by).agg(*(aggregate.alias(name) for name, aggregate in _counts(df, checks).items()))


def partial_values(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame | None:
    """Rows by value for the suite's uniqueness checks, for each group of ``by``; None if it has none."""
    unique_checks = _unique_checks(df, checks)
    return grouped(df, _surplus_tests(df, unique_checks), by) if unique_checks else None


def merged_suite(
    df: DataFrame, suite: str, checks: Sequence[Check], counts: DataFrame, values: DataFrame | None
) -> DataFrame:
    """What ``run_suite`` gives for a table, from the partial results of its parts.

    Of ``df`` only columns and types are looked at. All counts of a suite add up, and
    a value is repeated if its counts of all parts add up to more than one.
    """
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT)
    unique_checks = _unique_checks(df, checks)
    compiled = {i: (c, _compile(df, c, f"_c{i}")) for i, c in enumerate(checks, 1) if i not in unique_checks}
    parts = []
    if compiled:
        whole = counts.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _counts(df, checks)))
        parts.append(whole.select(F.inline(F.array(*(_result(suite, i, c, done) for i, (c, done) in compiled.items())))))
    if unique_checks:
        whole_groups = values.groupBy("test", "value").agg(F.sum("n").alias("n"))
        names = [f"_c{position}" for position in unique_checks]
        row = measured(whole_groups, _surplus_tests(df, unique_checks), names)
        parts.append(row.select(F.inline(F.array(*_unique_rows(suite, unique_checks)))))
    return reduce(DataFrame.unionByName, parts)


def _counts(df: DataFrame, checks: Sequence[Check]) -> dict[str, Column]:
    unique_checks = _unique_checks(df, checks)
    shared: dict[str, Column] = {"_rows": F.count(F.lit(1))}
    for position, check in enumerate(checks, start=1):
        if position not in unique_checks:
            shared |= _compile(df, check, f"_c{position}").aggregates
    return shared


def _unique_checks(df: DataFrame, checks: Sequence[Check]) -> dict[int, Check]:
    found = {i: c for i, c in enumerate(checks, 1) if c.kind == "unique" and c.column in df.columns}
    for check in found.values():
        if not can_group(df, check.column):
            raise ValueError(f"{check.column} holds values that cannot be counted by part")
    return found


def summarise(results: DataFrame) -> DataFrame:
    """Per suite: totals, success, share of checks passed and the failures in order."""
    failure = F.when(
        ~F.col("success"),
        F.struct("position", F.concat_ws(" — ", "check_name", "detail").alias("text")),
    )
    summary = results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
        F.sort_array(F.collect_list(failure)).alias("failures"),
    )
    percent = ratio(F.col("passed"), F.col("total")) * F.lit(100.0)
    return summary.select(
        "suite",
        "total",
        "passed",
        "failed",
        "success",
        F.bround(percent, 1).alias("success_pct"),
        F.col("failures.text").alias("failures"),
    )


def verdict(summaries: DataFrame) -> DataFrame:
    """One row: whether every suite that ran succeeded."""
    return summaries.agg(
        F.count(F.lit(1)).alias("suites"),
        F.bool_and("success").alias("success"),
    )


def _compile(df: DataFrame, check: Check, tag: str) -> _Compiled:
    none = F.lit(None).cast("double")
    if check.kind == "row_count_above":
        rows = F.col("_rows")
        return _Compiled(
            rows >= F.lit(check.rows), rows.cast("double"), F.format_string("actual=%,d", rows)
        )
    exists = check.column in df.columns
    if check.kind == "column_exists":
        found = "" if exists else f"columns={list(df.columns)}"
        return _Compiled(F.lit(exists), none, F.lit(found))
    if not exists:
        return _Compiled(F.lit(False), none, F.lit("column missing"), name=check.short_name)

    rate_of = {
        "no_nulls": _null_rate,
        "values_in_set": _valid_rate,
        "values_between": _between_rate,
        "not_negative": _negative_rate,
    }
    if check.kind not in rate_of:
        raise ValueError(f"unknown expectation: {check.kind}")
    return rate_of[check.kind](df, check, tag)


def _is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or not a number in a column of floating point."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def members(kind: T.DataType, values: Sequence[object]) -> list[object]:
    """The values that a column of this type can hold; no cell equals any of the others."""
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return [v for v in values if isinstance(v, str)]
    if isinstance(kind, T.BooleanType):
        return [v for v in values if isinstance(v, bool)]
    if isinstance(kind, T.NumericType):
        return [v for v in values if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [v for v in values if isinstance(v, datetime)]
    if isinstance(kind, T.DateType):
        return [v for v in values if isinstance(v, date) and not isinstance(v, datetime)]
    return []


def _null_rate(df: DataFrame, check: Check, tag: str) -> _Compiled:
    missing = _is_missing(df, check.column)
    rate = ratio(F.col(tag), F.col("_rows"))
    return _tolerant(
        (F.lit(1.0) - rate) >= F.lit(check.mostly), rate, "null_rate", {tag: F.count_if(missing)}
    )


def _valid_rate(df: DataFrame, check: Check, tag: str) -> _Compiled:
    values = members(df.schema[check.column].dataType, check.values)
    valid = F.col(quoted(check.column)).isin(*values) if values else F.lit(False)
    rate = ratio(F.col(tag), F.col("_rows"))
    return _tolerant(rate >= F.lit(check.mostly), rate, "valid_rate", {tag: F.count_if(valid)})


def _between_rate(df: DataFrame, check: Check, tag: str) -> _Compiled:
    number = number_or_null(df, check.column)
    inside = number.isNotNull()
    if check.low is not None:
        inside = inside & (number >= F.lit(check.low))
    if check.high is not None:
        inside = inside & (number <= F.lit(check.high))
    rate = F.coalesce(ratio(F.col(f"{tag}_in"), F.col(f"{tag}_n")), F.lit(1.0))
    return _tolerant(
        rate >= F.lit(check.mostly),
        rate,
        "valid_rate",
        {f"{tag}_n": F.count(number), f"{tag}_in": F.count_if(inside)},
    )


def _negative_rate(df: DataFrame, check: Check, tag: str) -> _Compiled:
    number = number_or_null(df, check.column)
    rate = ratio(F.col(f"{tag}_neg"), F.col(f"{tag}_n"))
    return _tolerant(
        rate <= F.lit(1 - check.mostly),
        rate,
        "negative_rate",
        {f"{tag}_n": F.count(number), f"{tag}_neg": F.count_if(number < 0)},
    )


def _tolerant(success: Column, rate: Column, label: str, aggregates: dict[str, Column]) -> _Compiled:
    """A rate of nothing is NULL and fails."""
    percent = F.format_string("%.1f%%", F.bround(rate * F.lit(100.0), 1))
    text = F.when(rate.isNotNull(), percent).otherwise(F.lit("nan%"))
    detail = F.concat(F.lit(f"{label}="), text)
    return _Compiled(F.coalesce(success, F.lit(False)), rate, detail, aggregates)


def _unique_results(df: DataFrame, suite: str, checks: Mapping[int, Check]) -> DataFrame:
    """All uniqueness checks of a suite, from one scan and one shuffle."""
    names = [f"_c{position}" for position in checks]
    return count_groups(df, _surplus_tests(df, checks), names).select(F.inline(F.array(*_unique_rows(suite, checks))))


def _surplus_tests(df: DataFrame, checks: Mapping[int, Check]) -> list[Tested]:
    return [Tested(SURPLUS, ~_is_missing(df, check.column), check.column) for check in checks.values()]


def _unique_rows(suite: str, checks: Mapping[int, Check]) -> list[Column]:
    return [_result(suite, position, check, _excess(F.col(f"_c{position}"))) for position, check in checks.items()]


def _excess(excess: Column) -> _Compiled:
    return _Compiled(excess == 0, excess.cast("double"), F.format_string("duplicates=%d", excess))


def _unique_result(df: DataFrame, suite: str, position: int, check: Check) -> DataFrame:
    """Rows beyond the first of each value. Rows are counted per value before
    the shuffle, so a value that fills much of the table is one row per task."""
    per_value = (
        df.filter(~_is_missing(df, check.column))
        .groupBy(F.col(quoted(check.column)))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_excess"))
    )
    return per_value.select(F.inline(F.array(_result(suite, position, check, _excess(F.col("_excess"))))))


def _result(suite: str, position: int, check: Check, compiled: _Compiled) -> Column:
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(position).alias("position"),
        F.lit(compiled.name or check.name).alias("check_name"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.mostly).alias("mostly"),
        compiled.observed.alias("observed"),
        compiled.detail.alias("detail"),
        compiled.success.alias("success"),
    )
