"""Texts longer than a piece, among short ones, give what they give one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_language_id import ENGLISH, GERMAN, learned
from tests.llm.test_license_scan import brute as licences
from tests.llm.test_line_dedup import brute as cut_lines
from txquality.llm import interpolated_lm, jaccard_join, language_id, license_scan, line_dedup

LONG = 5 << 20


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(9)
    words = [f"w{k}" for k in range(4000)]
    body = "\n".join(" ".join(draw.choice(words) for _ in range(12)) for _ in range(LONG // 60))
    late = "first common line here\nsecond common line here\nthird common line here"
    return [late, body + "\n" + late + "\nunder the MIT License", body + "\n" + late, "short", None, ""]


def test_language_model_counts_the_whole_text(make, texts):
    rows = {r.doc_id: r for r in interpolated_lm.score_documents(make(texts), F.col("doc_id") == 2).collect()}
    want = [len((t or "").split()) + 1 for t in texts]
    assert [rows[i].n_tokens for i in range(len(texts))] == want and rows[2].n_known == want[2]
    assert rows[0].train_tokens == sum(want) - want[2] and all(np.isfinite(r.score) for r in rows.values())


def test_line_dedup(make, texts):
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.remove_repeated_passages(make(texts).select("doc_id", "text"), removed="n_removed").collect()}
    assert got == {d: (t, n) for d, t, n in cut_lines(list(enumerate(texts)))}
    assert got[1][1] == 3 and got[1][0].endswith("under the MIT License")


def test_language(spark, make):
    long = " ".join(GERMAN * (LONG // 90)) + " " + " ".join(ENGLISH)
    rows = {r.doc_id: r for r in language_id.identify(make([long, " ".join(ENGLISH)]), learned(spark)).collect()}
    assert rows[0].lang_pred == "de" and rows[1].lang_pred == "en"
    assert len(rows[0].spans) == 2


def test_licences(make, texts):
    rows = {r.doc_id: r for r in license_scan.scan(make(texts)).collect()}
    short = licences("under the MIT License")
    before = len(texts[1].split()) - 4
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word) == (1, before + 2, before + 2) and rows[1].labels == short[5] == "mit"
    assert rows[2].n_base == 0 and rows[2].n_words == len(texts[2].split())


def test_jaccard_join(make, texts):
    got = sorted(tuple(r) for r in jaccard_join.components(make(texts), 3, (9, 10)).select("doc_id", "n_shingles", "component_id").collect())
    assert got == sorted(components(list(enumerate(texts)), 3, 9, 10))
    assert got[2][2] == 1
