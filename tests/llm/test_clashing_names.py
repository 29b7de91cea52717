"""Names that really clash with what operators and stages make, and the cases each stage defines."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txquality import session
from txquality.llm import jaccard_join, line_dedup, pieces, queries, toxicity
from txquality.llm.names import fresh

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = ["__id", "__removed", "__text_key", "__windows", "__hit_key", "__severity", "__toxic", "__key", "__ids", "severity", "ids", "cid", "Size"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents as the pipeline gets them, with NULLs, repeated rows, a long text, and extra columns of internal names."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    long = "line one is here\nline two is here\nline three is here\n" * 3 + "long text " * 250_000
    odd = [(None, None, None, None, None), (None, "a text without an id\nsecond\nthird", None, None, 3), (1, "", "xx", "s", None), (1, None, None, "s", 0), (900_001, long, "en", "s", len(long)), (900_002, "same row", "en", None, 8), (900_002, "same row", "en", None, 8)]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns({n: F.lit(i) for i, n in enumerate(NAMES)}).repartition(3)


def test_fresh_names():
    assert fresh(["a", "__ID"], "__id", "b", "A") == ["__id_", "b", "A_"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_pass_all_columns_and_odd_rows(spark, clashing, name, stage):
    out = stage(spark, clashing, SF_DIR)
    kept = out.collect()
    if name == "sentencepiece":
        assert sorted(out.columns) == ["doc_id", "ids", "n_ids"] and len(kept) == clashing.count()
        return
    assert out.schema.names == clashing.schema.names
    assert {tuple(r[n] for n in NAMES) for r in kept} == {tuple(range(len(NAMES)))}
    texts = [r.text for r in kept]
    assert texts.count(None) == 2 and "" in texts and texts.count("same row") == 2
    assert any(r.doc_id is None and r.text for r in kept) and any(t and len(t) > 2_000_000 for t in texts)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, clashing, name, stage):
    out = stage(spark, clashing.limit(0), SF_DIR)
    assert out.collect() == []
    assert name == "sentencepiece" or out.schema.names == clashing.schema.names


def test_results_never_have_a_name_twice(spark, clashing):
    vocabulary = pieces.load(queries.vocabulary_path())
    with pytest.raises(ValueError, match="ids already"):
        pieces.encoded(clashing, vocabulary)
    with pytest.raises(ValueError, match="severity already"):
        toxicity.scored(clashing, None)
    with pytest.raises(ValueError, match="size already"):
        line_dedup.remove_repeated_passages(clashing, "size")
    assert jaccard_join.one_of_each(clashing.select("doc_id", "text", "__id"), 5, (8, 10)).columns == ["doc_id", "text", "__id"]


def test_run_leaves_its_last_table_alone(spark):
    before = session.scratch_made()
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert session.scratch_made() == before + 1 and rows.count() > 0
