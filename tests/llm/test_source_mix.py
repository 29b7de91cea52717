import hashlib
import math
import os
import re

import duckdb
import pytest

from txquality.llm import queries, source_mix

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, source string, quality double"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by turns: share by weight, cap what is above, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, got, budget = set(order), dict.fromkeys(order, 0.0), share * sum(sizes.values())
    while open_:
        rate = budget / sum(w[s] for s in open_)
        over = {s for s in open_ if rate * w[s] > most * sizes[s]}
        if not over:
            return got | {s: rate * w[s] for s in open_}
        for s in over:
            got[s] = most * sizes[s]
            budget -= got[s]
        open_ -= over
    return got


def brute(rows):
    """(doc_id, size, source, target, taken) of each row, by sorting each source whole."""
    drawn = []
    for doc_id, text, source, quality in rows:
        digits = hashlib.md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()[:13]
        weight = 1.0 if quality is None else 4 ** (quality - 0.5)
        key = -math.log((int(digits, 16) + 0.5) / 2**52) / weight
        drawn.append((source, key, doc_id, len(re.findall("[^\x20\x09-\x0d]+", text or ""))))
    sizes = {}
    for source, _, _, size in drawn:
        sizes[source] = sizes.get(source, 0) + size
    out = []
    for source, target in targets(sizes).items():
        want = math.floor(target + 0.5)
        epochs, left = divmod(want, sizes[source]) if sizes[source] else (0, 0)
        for _, _, doc_id, size in sorted((d for d in drawn if d[0] == source), key=lambda d: (d[1], -1 if d[2] is None else d[2])):
            out.append((doc_id, size, source, round(target, 6), epochs * size + min(size, left)))
            left -= min(size, left)
    return sorted(out, key=str)


def found(spark, rows):
    mixed = source_mix.mix(spark.createDataFrame(rows, DOCS).repartition(3))
    return sorted(((r.doc_id, r.size, r.source, round(r.target, 6), r.taken) for r in mixed.collect()), key=str)


def corpus():
    rows = [(i, "w " * (i * 37 % 101), f"s{i % 7}" if i % 11 else None, [None, 0.0, 1.0, 0.5][i % 4]) for i in range(400)]
    return rows + [(900 + i, "many words here " * 400, "big", None) for i in range(20)]


ODD = [
    (1, None, "a", None), (2, "", "a", 1.0), (3, "\t\n ", "a", 0.0), (None, "no id here", "a", None), (None, None, None, None), (4, "x" * 50_000, "a", None), (5, "word " * 50_000, None, 1.0),
    (6, "same row", "b", None), (6, "same row", "b", None), (6, "same row", "b", None), (6, "another text of this id", "b", None), (7, "Ünï cödé two\x0bthree", "É", None), (8, None, "empty", None),
]


@pytest.mark.parametrize("rows", [corpus(), ODD, corpus() + ODD, [(1, "just one", None, None)], [(1, None, "x", None)]])
def test_equals_a_whole_sort(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_targets_are_met_and_no_document_is_taken_more_than_twice(spark):
    by_source = {}
    for doc_id, size, source, target, taken in found(spark, corpus()):
        assert 0 <= taken <= 2 * size
        by_source.setdefault(source, [target, 0])[1] += taken
    assert all(abs(target - taken) <= 0.5 for target, taken in by_source.values())


def test_a_row_that_is_most_of_its_source(spark, monkeypatch):
    """Equal keys are summed part by part, whatever their number."""
    monkeypatch.setattr(source_mix, "ORDERED_ROWS", 16)
    rows = corpus() + [(7, "five words in this row", "s1", None)] * 3000
    assert found(spark, rows) == brute(rows)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "BROADCAST_ROWS", 10)
    rows = [(i, "w " * (i % 29), f"src{i % 250}", None) for i in range(1500)]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    empty = source_mix.mix(spark.createDataFrame([], DOCS))
    assert empty.collect() == [] and "taken" in empty.columns
    names = ["place", "size", "range", "rest", "lot", "n", "before", "part", "file", "at", "w", "cap", "words"]
    docs = spark.createDataFrame([(*r, *[1] * len(names)) for r in ODD], DOCS + "".join(f", {n} int" for n in names))
    assert sorted(((r.doc_id, r.size, r.source, round(r.target, 6), r.taken) for r in source_mix.mix(docs).collect()), key=str) == brute(ODD)


def test_copies_hold_what_is_taken(spark):
    mixed = source_mix.mix(spark.createDataFrame(corpus() + ODD, DOCS)).collect()
    again = source_mix.copies(source_mix.mix(spark.createDataFrame(corpus() + ODD, DOCS))).collect()
    assert sum(r.words for r in again) == sum(r.taken for r in mixed)
    assert {r.epoch for r in again} <= {0, 1, 2}


def test_labels_give_quality(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, None), (None, 1), (9, 0)], "doc_id long, quality int")
    assert {r.text: r.quality for r in source_mix.with_quality(docs, labels).collect()} == {"a": 0.5, "b": 1.0, "c": None, "d": None}


def test_no_python_and_sql_agree(spark):
    query = queries.op13_source_mix(spark, SF_DIR)
    assert "Python" not in query._jdf.queryExecution().toString() and "Arrow" not in query._jdf.queryExecution().toString()
    duck = duckdb.connect()
    for table in ("documents", "labels"):
        duck.sql(f"create view {table} as from '{SF_DIR}/{table}.parquet'")
    want = duck.sql(queries.oracle()["op13_source_mix"])
    assert sorted(tuple(r[c] for c in want.columns) for r in query.collect()) == sorted(want.fetchall())
