"""Repeated passages removed line by line, found through overlapping three-line windows.

Every three consecutive lines that are not blank form a window. A window is
repeated when the same three lines (trimmed) occur at more than one place of the
corpus; its first place, by document id and position, stays, and the lines that
later places cover, merged where windows overlap, are removed. The earliest
place of a line is never covered by a later window, so no text is lost from the
corpus.

Defined cases: a NULL text stays NULL; texts with fewer than three lines have no
window and stay; blank lines stay; rows that repeat a document (id and text)
count as one document and are treated alike; a NULL id comes before all others;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pac
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality.llm import textkit as tk
from txquality.llm.names import fresh, refuse_taken

WINDOW_LINES = 3
_KEY, _AT = "__text_key", "__windows"


def _text_key() -> Column:
    return F.xxhash64(F.col("text"))


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text key, k, h1, h2): the k-th window of each text and a 128-bit hash of its lines."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda line: F.trim(line)), lambda line: line != "")
    hashes = F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b")))
    window = lambda k, part: F.xxhash64(*[F.col("hashes")[k + i][part] for i in range(WINDOW_LINES)])
    return (
        docs.where(F.col("text").contains("\n"))
        .select("doc_id", _text_key().alias(_KEY), hashes.alias("hashes"))
        .where(F.size("hashes") >= WINDOW_LINES)
        .select("doc_id", _KEY, F.explode(F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW_LINES), lambda k: F.struct(k.alias("k"), window(k, "a").alias("h1"), window(k, "b").alias("h2")))).alias("w"))
        .select("doc_id", _KEY, "w.*")
    )


def later_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text key, list of window positions) of every later place of a repeated window.

    Counts are summed before the shuffle, so a window that a third of all
    documents share sends one row per task; the join back is Spark's to split.
    """
    found = windows(docs)
    place = F.struct("doc_id", _KEY, "k")
    repeated = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    return (
        found.join(repeated, ["h1", "h2"])
        .where(place > F.col("first"))
        .groupBy("doc_id", _KEY)
        .agg(F.collect_set("k").alias(_AT))
    )


def covered_lines(text: str, starts: list[int]) -> tuple[list[str], np.ndarray]:
    """The lines of a text, and which of them the windows that start at these lines (blank ones not counted) cover."""
    lines = text.split("\n")
    solid = np.flatnonzero([line.strip(" ") != "" for line in lines])
    edges = np.zeros(len(solid) + 1, np.int64)
    np.add.at(edges, np.asarray(starts), 1)
    np.add.at(edges, np.asarray(starts) + WINDOW_LINES, -1)
    gone = np.zeros(len(lines), bool)
    gone[solid[np.cumsum(edges[:-1]) > 0]] = True
    return lines, gone


def _rewrite(starts_at: str, removed_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.pieces(batches):
            yield _rewritten(batch, starts_at, removed_name)

    return run


def _rewritten(batch: pa.RecordBatch, starts_at: str, removed_name: str) -> pa.RecordBatch:
    at = batch.schema.get_field_index(starts_at)
    column = batch.schema.get_field_index("text")
    texts = batch.column(column)
    starts = batch.column(at)
    removed = np.zeros(batch.num_rows, np.int64)
    hit = np.flatnonzero(starts.is_valid().to_numpy(zero_copy_only=False))
    if len(hit):
        cut = []
        for i in hit:
            lines, gone = covered_lines(texts[i].as_py(), starts[i].as_py())
            removed[i] = gone.sum()
            cut.append("\n".join(line for line, drop in zip(lines, gone) if not drop))
        texts = pac.replace_with_mask(texts, starts.is_valid(), pa.array(cut, texts.type))
    arrays = [texts if i == column else batch.column(i) for i in range(batch.num_columns) if i != at]
    names = [name for i, name in enumerate(batch.schema.names) if i != at]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(removed)], [*names, removed_name])


def remove_repeated_passages(docs: DataFrame, removed: str | None = None) -> DataFrame:
    """The documents without later places of repeated windows; with the count of removed lines if a column is named."""
    refuse_taken(docs, removed)
    doc, key, hit_key, starts, count = fresh(docs.columns, "__id", _KEY, "__hit_key", _AT, "__removed")
    at = later_windows(docs).select(F.col("doc_id").alias(doc), F.col(_KEY).alias(hit_key), F.col(_AT).alias(starts))
    keyed = docs.withColumn(key, _text_key())
    joined = keyed.join(at, keyed["doc_id"].eqNullSafe(at[doc]) & (keyed[key] == at[hit_key]), "left").drop(doc, hit_key, key)
    schema = T.StructType([*docs.schema.fields, T.StructField(count, T.LongType())])
    out = joined.mapInArrow(_rewrite(starts, count), schema)
    return out.withColumnRenamed(count, removed) if removed else out.drop(count)
