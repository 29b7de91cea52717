"""Readers for raw CSV and JSON-lines files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality import schemas
from txquality.functions.text import null_if_token, typed
from txquality.sources.quoted_csv import read_records


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header line skipped, empty cells NULL, columns bound by position.

    A cell that does not fit its type becomes NULL and the row is kept. Lines
    hold one record each, so large files are split among tasks.
    """
    reader = spark.read.option("header", "true").option("nullValue", "").option("mode", "PERMISSIVE")
    return reader.schema(schema).csv(path)


def transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS)


def customers_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS)


def transactions_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line, fields bound by name."""
    return spark.read.schema(schemas.TRANSACTIONS).json(path)


def read_csv_folder(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.csv", multi_line: bool = False
) -> DataFrame:
    """All CSV files of a folder as one table; FileNotFoundError if there are none.

    Cells are read as text so that every missing-value text becomes NULL, then
    cast to ``schema``; text that does not fit becomes NULL. A file whose header
    names other columns, or another order, is an error: files are never bound
    to the wrong columns. A row with more cells than columns is an error; one with
    fewer is filled with NULL.

    ``multi_line`` allows line breaks in quoted cells, at the price of a second pass over
    the text; without it a quoted cell that a line break cuts off is an error.
    """
    try:
        text = csv_text(spark, f"{folder.rstrip('/')}/{pattern}", schema, multi_line, check_header=True)
    except AnalysisException as error:
        if is_absent(error):
            raise FileNotFoundError(f"no files match {pattern} in {folder}") from error
        raise
    cells = (
        typed(null_if_token(f.name, schemas.FRAME_NULL_TOKENS), f.dataType).alias(f.name)
        for f in schema
    )
    # the first column is named as Spark refuses to read the bad lines alone
    refused = F.concat(F.lit("a CSV row of other cells than the header has: "), F.substring(BAD_LINE, 1, 200), F.lit(" ("), F.coalesce(F.col(schema[0].name), F.lit("")), F.lit(")"))
    fits = F.when(~_spoilt(len(schema)), F.lit(True)).otherwise(F.raise_error(refused).cast("boolean"))
    return text.filter(fits).select(*cells)


BAD_LINE, FILE = "_bad_line", "_file"


_QUOTING = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "columnPruning": "false"}


def csv_text(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool, check_header: bool
) -> DataFrame:
    """Cells of CSV files as text, named as in ``schema``, the text of rows that don't fit, and each row's file.

    Files have a header, which may be held against the schema, and doubled quotes. They
    are split among tasks, with line breaks in quoted cells or without.
    """
    as_text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(BAD_LINE, T.StringType())])
    if not multi_line:
        reader = spark.read.options(header="true", enforceSchema=not check_header, **_QUOTING)
        return reader.schema(as_text).csv(paths).select("*", F.col("_metadata.file_path").alias(FILE))
    records = read_records(spark, paths)
    # a record may end in the carriage return of its line, a file begin with a byte-order mark
    record = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "^\ufeff", "")
    columns = ", ".join(f"`{name}` string" for name in as_text.fieldNames())
    parsed = records.select("file", "first", F.from_csv(record, columns, {**_QUOTING, "multiLine": "true"}).alias("cells"))
    rows = parsed.filter(F.when(F.col("first"), _is_header(schema, check_header)).otherwise(F.lit(True)))
    return rows.select("cells.*", F.col("file").alias(FILE))


def _is_header(schema: T.StructType, check: bool) -> Column:
    """FALSE for a header, which is no row; an error for one of other columns."""
    if not check:
        return F.lit(False)
    named = reduce(and_, (F.lower(F.col("cells")[f.name]) == f.name.lower() for f in schema), F.col("cells")[BAD_LINE].isNull())
    refused = F.concat(F.lit("the CSV header of other columns than the schema has: "), F.col("file"))
    return F.when(F.coalesce(named, F.lit(False)), F.lit(False)).otherwise(F.raise_error(refused).cast("boolean"))


def _spoilt(columns: int) -> Column:
    """Too many cells, or a quote that is not closed on its line."""
    line = F.col(BAD_LINE)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    cells = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))
    return F.coalesce(line.isNotNull() & ((cells > columns) | (quotes % 2 != 0)), F.lit(False))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all tables, duplicates kept; columns matched by name, absent ones NULL."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table ``read`` returns, or None where its path does not exist.

    Spark resolves the path itself, so this works on every file system it reads.
    """
    try:
        return read()
    except FileNotFoundError:
        return None
    except AnalysisException as error:
        if is_absent(error):
            return None
        raise


def is_absent(error: AnalysisException) -> bool:
    """Whether Spark failed because a path, or every file of a pattern, is missing."""
    return error.getCondition() == "PATH_NOT_FOUND"


def source_table(spark: SparkSession, name: str) -> DataFrame:
    """A raw table by name, from the catalog or a view registered in the session."""
    return spark.table(name)


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``row_count``: the check after a load."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
