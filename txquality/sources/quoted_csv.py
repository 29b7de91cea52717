"""CSV files with line breaks in quoted cells, read by many tasks.

A reader that allows such cells takes a file in one task, as a split cannot know whether
it begins inside a quote. Here each split says first how a quote that is open where it
begins ends up where it ends, for both cases. Put one after the other, these answers tell
each split how it begins, and it then starts at its first true record. Lines of a record
that crosses splits, one piece for each split, are put together after that.

A quote opens a cell only where the cell begins, and a doubled one inside stands for
itself, as in the reader for whole files. Two passes over the text; what is shuffled is
two small rows for each split and the pieces of records that cross one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CLOSE = re.compile(r'"(?:"|(?=[^"])|$)')
RECORD, HEAD, TAIL = 0, 1, 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quote is open at the end of a line, if it was or was not where the line begins."""
    at = 0
    while True:
        if inside:
            closing = _CLOSE.search(line, at)
            while closing and closing.group() == '""':
                closing = _CLOSE.search(line, closing.end())
            if not closing:
                return True
            at = closing.end()
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        comma = line.find(",", at)
        if comma < 0:
            return False
        at, inside = comma + 1, False


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str], Iterator[bool], bool]]:
    """Runs of lines of one split, which stand together and in order: file, start, lines, which hold a quote, begins inside."""
    for batch in batches:
        lines, file, start, begins = (batch.column(i) for i in range(4))
        key = list(zip(file.to_pylist(), start.to_pylist()))
        quoted = pc.match_substring(lines, '"').to_pylist()
        texts, open_ = lines.to_pylist(), begins.to_pylist()
        at = 0
        while at < len(key):
            to = at + 1
            while to < len(key) and key[to] == key[at]:
                to += 1
            yield *key[at], texts[at:to], quoted[at:to], open_[at]
            at = to


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of a split's lines: its number within the task, and how it ends in both cases."""
    rows = []
    for number, (file, start, lines, quoted, _) in enumerate(_splits(batches)):
        ends = [False, True]
        for line, has_quote in zip(lines, quoted):
            if has_quote:
                ends = [ends_inside(line, inside) for inside in ends]
        rows.append((file, start, number, *ends))
    if rows:
        names = ["file", "start", "number", "from_outside", "from_inside"]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, and the pieces of records that cross its ends."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])
    out: list[tuple] = []
    at, held, inside, kind, first = None, [], False, RECORD, False

    def close(final: int | None = None) -> None:
        nonlocal kind, held, first
        if held:
            out.append((*at, kind if final is None else final, first, "\n".join(held)))
            first = False
        held, kind = [], RECORD

    for file, start, lines, quoted, begins in _splits(batches):
        if at != (file, start):
            close(None if kind == HEAD else TAIL)
            at, inside, first = (file, start), begins, start == 0
            kind = HEAD if inside else RECORD
        for line, has_quote in zip(lines, quoted):
            if not held and not inside and kind == RECORD and line in ("", "\r"):
                continue
            held.append(line)
            if has_quote:
                inside = ends_inside(line, inside)
            if not inside:
                close()
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)
            out.clear()
    close(None if kind == HEAD else TAIL)
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _beginnings(lines: DataFrame) -> DataFrame:
    """Splits that begin inside a quote: file, start. One row for each split of a file is put in order."""
    marked = lines.withColumn("begins", F.lit(False))
    runs = marked.mapInArrow(_outcomes, "file string, start long, number long, from_outside boolean, from_inside boolean")
    outcomes = F.sort_array(F.collect_list(F.struct("start", "number", "from_outside", "from_inside")))
    of_file = runs.groupBy("file").agg(outcomes.alias("outcomes"))
    kind = "array<struct<start:bigint,number:bigint,begins:boolean>>"
    started = F.struct(F.array().cast(kind).alias("found"), F.lit(False).alias("inside"))
    step = lambda state, run: F.struct(
        F.concat(state["found"], F.array(F.struct(run["start"].alias("start"), run["number"].alias("number"), state["inside"].alias("begins")))).alias("found"),
        F.when(state["inside"], run["from_inside"]).otherwise(run["from_outside"]).alias("inside"),
    )
    walked = of_file.select("file", F.inline(F.aggregate("outcomes", started, step)["found"]))
    # a split's lines come in several runs, of which the first tells how the split begins
    return walked.groupBy("file", "start").agg(F.min_by("begins", "number").alias("begins")).where("begins").drop("begins")


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of CSV files as text, line breaks in quoted cells included: file, record, first (of its file)."""
    lines = _lines(spark, paths)
    inside = F.broadcast(_beginnings(lines).withColumnsRenamed({"file": "in_file", "start": "in_start"}).withColumn("begins", F.lit(True)))
    known = lines.join(inside, (F.col("file") == F.col("in_file")) & (F.col("start") == F.col("in_start")), "left")
    known = known.select("value", "file", "start", F.coalesce("begins", F.lit(False)).alias("begins"))
    found = known.mapInArrow(_records, "file string, start long, kind int, first boolean, record string")
    whole = found.where(F.col("kind") == RECORD).select("file", "record", "first")
    return whole.unionByName(_joined(found.where(F.col("kind") != RECORD)))


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross splits: from one split's last piece to the next split's first one, or through it."""
    in_order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    gathered = numbered.groupBy("file", "number").agg(parts.alias("parts"), F.bool_or("first").alias("first"))
    return gathered.select("file", F.array_join(F.transform("parts", lambda part: part["record"]), "\n").alias("record"), "first")
