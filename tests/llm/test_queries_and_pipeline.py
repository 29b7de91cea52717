import math
import os
import re
import zlib
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_line_dedup import brute as cut_lines
from txquality.llm import pieces, queries
from txquality.llm.queries import vocabulary_path

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_one_query_for_each_operator():
    names = list(queries.registered())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(names) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        connection.sql(f"create view {table} as from '{SF_DIR}/{table}.parquet'")
    want = connection.sql(queries.oracle()[name])
    got = queries.registered()[name](spark, SF_DIR).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


# op5 has rows by query vector, op12 by word
OTHER_ROWS = ("pipeline", "op5_prefix_forest", "op12_spelling_variants")


@pytest.mark.parametrize("name", [n for n in sorted(queries.registered()) if n not in OTHER_ROWS])
def test_query_returns_a_row_for_each_document(spark, name):
    rows = queries.registered()[name](spark, SF_DIR)
    assert rows.count() == pq.read_metadata(f"{SF_DIR}/documents.parquet").num_rows


def test_pipeline_stage_by_stage(spark):
    """Each stage against what its own rule says about its input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    (_, toxic), (_, lines), (_, near), (_, leaks), (_, encode) = corpus_pipeline.STAGES
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    clean = spark.createDataFrame(toxic(spark, docs, SF_DIR).collect(), docs.schema)
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns
    # few labels at this size: some toxic documents have words that no other has
    assert sum(i in kept for i, t in labels.items() if t == 0) >= 0.97 * sum(t == 0 for t in labels.values())

    cut = spark.createDataFrame(lines(spark, clean, SF_DIR).collect(), docs.schema)
    want = {d: (t, n) for d, t, n in cut_lines([(r.doc_id, r.text) for r in clean.collect()])}
    assert {r.doc_id: r.text for r in cut.collect()} == {d: t for d, (t, n) in want.items() if n == 0 or t.strip(" ")}
    assert all(r.n_chars == len(r.text) for r in cut.collect() if want[r.doc_id][1])

    one = spark.createDataFrame(near(spark, cut, SF_DIR).collect(), docs.schema)
    groups = components([(r.doc_id, r.text) for r in cut.collect()], 5, 8, 10)
    assert {r.doc_id for r in one.collect()} == {d for d, _, c in groups if c == d}

    left = spark.createDataFrame(leaks(spark, one, SF_DIR).collect(), docs.schema)
    passages = [" ".join(t.lower().replace(".", " ").replace(",", " ").split()) for t in pq.read_table(f"{SF_DIR}/benchmark.parquet")["text"].to_pylist()]
    for r in one.collect():
        text = " ".join(r.text.lower().replace(".", " ").replace(",", " ").split())
        if any(p in text for p in passages):
            assert r.doc_id not in {x.doc_id for x in left.collect()}
    assert left.count() >= 0.9 * one.count()

    final = encode(spark, left, SF_DIR)
    back = pieces.decoded(final, pieces.load(vocabulary_path()))
    assert {(r.doc_id, r.decoded) for r in back.collect()} == {(r.doc_id, r.text) for r in left.collect()}


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r.n_ids == len(r.ids) for r in rows)


def test_base_columns_of_the_language_model_match_plain_counts(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    tokens = {d["doc_id"]: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), d["text"] or "")), None] for d in docs}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 == 2}
    seen = Counter(t for i, ts in tokens.items() if i not in held for t in ts)
    n, v = sum(seen.values()), len(seen)
    rows = queries.op1_interpolated_lm(spark, SF_DIR).collect()
    assert len(rows) == len(docs) == len(tokens)
    for r in rows:
        ts = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in held, len(ts), sum(t in seen for t in ts), n)
        assert math.isclose(r.base_score, math.fsum(math.log10((seen[t] + 1) / (n + 1 * (v + 1))) for t in ts), rel_tol=1e-9)


def test_stages_keep_odd_rows_that_are_clean(spark, odd):
    """NULL and empty texts, a NULL id and a repeated row pass every stage but the near copies' choice; an empty table stays empty."""
    clean = {None, "", " ", "one", "two words"}
    odd = odd.withColumnRenamed("size", "severity").withColumn("__id", odd["doc_id"])
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, odd, SF_DIR).collect()
        assert stage(spark, odd.limit(0), SF_DIR).collect() == []
        if name == "sentencepiece":
            assert len(rows) == odd.count() and {r.doc_id for r in rows if r.ids is None} == {r.doc_id for r in odd.collect() if r.text is None}
        else:
            assert list(rows[0].asDict()) == odd.columns and clean <= {r.text for r in rows}
            assert sum(r.text is None or r.text == "one" for r in rows) == sum(r.text is None or r.text == "one" for r in odd.collect())
