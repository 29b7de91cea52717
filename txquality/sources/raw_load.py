"""Bulk load of CSV files into a raw table, with a report per file and a ledger of files.

Every file is parsed once. A load is a unit of the table (see ``units``): loading again
under the same id replaces all of it, rejects included. Rejected rows lie apart, so they
cost readers nothing, and a load's report reads two small columns of that load alone.

The ledger beside the table holds a row for each file of each load: path, size,
modification time and outcome. With ``once`` a load leaves out what another load has
taken; a file that has changed since, or of which no row was loaded, is taken again.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality import schemas
from txquality.functions.text import null_if_token, typed
from txquality.session import stored
from txquality.sources.files import BAD_LINE, FILE, csv_text, if_present, is_absent
from txquality.units import Units


def parse_load(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.csv", multi_line: bool = False
) -> DataFrame:
    """Rows of the folder's CSV files, cast to ``schema``, with file and outcome.

    A row is rejected if it has too few or too many cells, or if a cell that is
    not a NULL text does not fit its column's type. ``multi_line`` allows line
    breaks in quoted cells, at the price of a second pass over the text.
    """
    return parse_files(spark, f"{folder.rstrip('/')}/{pattern}", schema, multi_line)


def parse_files(spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """As ``parse_load``, for a pattern or a list of files."""
    text = csv_text(spark, paths, schema, multi_line, check_header=False)
    faults = [F.col(BAD_LINE).isNotNull()]
    cells = []
    for field in schema:
        token = null_if_token(field.name, schemas.LOAD_NULL_TOKENS)
        value = typed(token, field.dataType)
        cells.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            faults.append(token.isNotNull() & value.isNull())
    return text.select(
        *cells,
        F.col(FILE).alias("_load_file"),
        reduce(or_, faults).alias("_rejected"),
    )


def load_table(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    table_path: str,
    load_id: str,
    pattern: str = "*.csv",
    multi_line: bool = False,
    once: bool = False,
) -> DataFrame:
    """Load a folder's CSV files into the raw table; returns the load's report.

    The report has every file of the load; one without rows is LOADED with 0. The
    load replaces what was loaded under its id before, also with fewer files or none.
    ``once`` takes only files that no other load has taken. The new files are named
    to the reader one by one, as its own listing would.

    An absent folder or one without files reports no rows, and takes back nothing:
    files that were loaded may have been cleared away since.
    """
    table = raw_units(table_path)
    try:
        listed = file_list(spark, folder, pattern)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return spark.createDataFrame([], _report_schema())
    if once:
        listed = _not_taken(spark, table, listed, load_id)
    listed = stored(listed, "load-files")
    paths = [_literal_path(r["path"]) for r in listed.select("path").toLocalIterator()]
    rows = parse_files(spark, paths, schema, multi_line) if paths else spark.createDataFrame([], _load_schema(schema))
    attempt = table.replace(rows, load_id, ["_rejected"], rebalance=False)
    report = load_report(_stored_load(spark, table_path, schema, [load_id]), listed.select("file"))
    entries = report.join(listed, "file").select(
        F.lit(load_id).alias("load_id"), F.lit(attempt).alias("attempt"), "file", "size", "modified", *LEDGER_OUTCOME
    )
    entries.write.mode("append").parquet(_ledger_path(table))
    return load_report(_stored_load(spark, table_path, schema, [load_id]), listed.select("file"))


LEDGER_OUTCOME = ("rows_parsed", "rows_loaded", "errors_seen", "status")
_LEDGER = (
    "load_id string, attempt string, file string, size long, modified timestamp, "
    "rows_parsed long, rows_loaded long, errors_seen long, status string"
)


def raw_units(table_path: str) -> Units:
    return Units(table_path, LOAD_COLUMN)


def _ledger_path(table: Units) -> str:
    return f"{table.root}/_ledger"


def ledger(spark: SparkSession, table_path: str) -> DataFrame:
    """Every file that counts in the table, with its load, size, time and outcome."""
    table = raw_units(table_path)
    current = table.current(spark)
    rows = if_present(lambda: spark.read.schema(_LEDGER).parquet(_ledger_path(table)))
    if rows is None or not current:
        return spark.createDataFrame([], _LEDGER).drop("attempt")
    counting = spark.createDataFrame([(unit, attempt) for unit, (attempt, _) in current.items()], "load_id string, attempt string")
    return rows.join(F.broadcast(counting), ["load_id", "attempt"], "left_semi").drop("attempt")


def _not_taken(spark: SparkSession, table: Units, listed: DataFrame, load_id: str) -> DataFrame:
    """Listed files but those that another load has taken as they are."""
    others = ledger(spark, table.location).filter((F.col("load_id") != load_id) & (F.col("status") != "LOAD_FAILED"))
    return listed.join(others.select("file", "size", "modified").distinct(), ["file", "size", "modified"], "left_anti").select(*listed.columns)


def _literal_path(path: str) -> str:
    """A path that Spark takes as it is, not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def file_list(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The folder's files, as Spark lists them; nothing of their content is read."""
    return spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{pattern}").select(
        F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def load_report(parsed: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per file: rows parsed, loaded and in error, and the outcome; files without rows if they are listed."""
    counts = parsed.groupBy(F.col("_load_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(~F.col("_rejected")).alias("rows_loaded"),
        F.count_if(F.col("_rejected")).alias("errors_seen"),
    )
    if files is not None:
        counts = files.join(counts, "file", "full_outer").fillna(0, ["rows_parsed", "rows_loaded", "errors_seen"])
    return counts.withColumn("status", load_status(F.col("rows_loaded"), F.col("errors_seen")))


def load_status(loaded: Column, errors: Column) -> Column:
    return (
        F.when(errors == 0, "LOADED").when(loaded == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED")
    )


def raw_table(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """The accepted rows of all loads; FileNotFoundError if nothing was ever loaded."""
    if raw_units(table_path).entries(spark) is None:
        raise FileNotFoundError(f"nothing was loaded into {table_path}")
    accepted = _stored_load(spark, table_path, schema).filter(~F.col("_rejected"))
    return accepted.select(*schema.fieldNames())


LOAD_COLUMN = "_load_id"


def _load_schema(schema: T.StructType) -> T.StructType:
    # the schema is given, so no file footers are read to infer it
    return T.StructType([*schema.fields, T.StructField("_load_file", T.StringType()), T.StructField("_rejected", T.BooleanType())])


def _stored_load(spark: SparkSession, table_path: str, schema: T.StructType, loads: list[str] | None = None) -> DataFrame:
    return raw_units(table_path).read(spark, _load_schema(schema), loads)


def _report_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("rows_parsed", T.LongType()),
            T.StructField("rows_loaded", T.LongType()),
            T.StructField("errors_seen", T.LongType()),
            T.StructField("status", T.StringType()),
        ]
    )
