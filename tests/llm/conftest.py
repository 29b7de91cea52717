import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

# tasks import the operators from here
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")])

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("size", T.LongType())])

# clashing names ("source", "size") come along as extra columns
ODD_TEXTS = [
    None, "", " ", "one", "two words", "a\nb\nc", "a\nb\nc", "\n\n\n", "x " * 3000, "y" * 5000, "Ünïcode ☃ text\twith\vodd\fspaces",
    "▁ literal ▁▁ marks", "mixed МИР κόσμος 世界 text", "1 km and 2 kg in 3.5 hours, by Anna Bell", "MIT License", "the MIT license", "0", "same text here twice over", "same text here twice over",
]


def rows(texts, first=0):
    return [(first + i, t, "en" if i % 3 else None, "src", i) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def make(spark):
    def build(texts, extra=()):
        return spark.createDataFrame([*rows(texts), *extra], DOCS).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and long texts, ties, a NULL id, and a row that stands there twice."""
    return make(ODD_TEXTS, [(None, "a document without an id\nof three\nlines", "en", None, None), (3, "one", None, "src", 3)])
