"""The corpus pipeline: from raw documents to token ids, each stage a job of its own.

Every stage reads what the one before it kept, as Parquet in the shared folder,
and its decisions take effect: toxic documents go, repeated passages are cut,
one document of each group of near copies stays, documents that hold benchmark
items go, and the rest are encoded. All stages but the last return the columns
they got, whatever their names.

Defined cases, in every stage: a NULL or empty text is a document without content and
stays (with no ids at the end, NULL ids for a NULL text); NULL in any other column
changes nothing; rows without an id, or with one that others have, are told apart by
their texts, but near copies go by id: rows of one id stay or go together, and rows
without one stay; equal rows stay or go together; an empty table gives an empty one;
texts may have any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txquality.llm import decontaminate, jaccard_join, line_dedup, pieces, toxicity
from txquality.llm.names import fresh
from txquality.llm.queries import vocabulary_path
from txquality.llm.shipping import importable
from txquality.session import clear_scratch, scratch_made, stored

NEAR_WORDS = 5
NEAR_LEAST = (8, 10)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labels, does not reject."""
    model = toxicity.fit(docs, importable(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    severity, toxic = fresh(docs.columns, "__severity", "__toxic")
    return toxicity.scored(docs, model, severity, toxic).where(~toxicity.rejected(toxic)).drop(severity, toxic)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later places of repeated three-line windows removed; a document of which nothing is left goes."""
    importable(spark)
    (removed,) = fresh(docs.columns, "__removed")
    cut = line_dedup.remove_repeated_passages(docs, removed).where((F.col(removed) == 0) | (F.trim("text") != ""))
    counted = {"n_chars": F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cut.withColumns(counted).drop(removed)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8."""
    importable(spark)
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_LEAST)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.decontaminated(docs, importable(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    importable(spark)
    coded = pieces.encoded(docs.select("doc_id", "text"), pieces.load(vocabulary_path()))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_passages),
    ("jaccard_join", one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode),
]

# The fitted model and the vocabulary cannot be written as SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's input and inner tables go once its output is written."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = scratch_made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear_scratch(spark, before, keep_last=True)
    return docs
