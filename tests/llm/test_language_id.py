import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from txquality.llm import language_id as li

ENGLISH = "the and of that with this house water people over under when where light night".split()
GERMAN = "der und die nicht mit haus wasser leute über unter wenn licht nacht schön straße".split()
RUSSIAN = "это дом вода люди свет ночь когда где под над".split()


def texts(words, n, seed):
    draw = random.Random(seed)
    return [" ".join(draw.choice(words) for _ in range(12)) for _ in range(n)]


def learned(spark):
    rows = [(lang, t) for lang, words in (("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN)) for t in texts(words, 30, 1)]
    return li.learn(spark.createDataFrame([*rows, (None, "ignored"), ("en", None)], "lang string, text string"))


def brute_viterbi(scores, switch):
    best = [(s, [k]) for k, s in enumerate(scores[0])]
    for row in scores[1:]:
        top = max(range(len(best)), key=lambda k: best[k][0])
        best = [
            ((best[k][0] if best[k][0] >= best[top][0] - switch else best[top][0] - switch) + s, (best[k] if best[k][0] >= best[top][0] - switch else best[top])[1] + [k])
            for k, s in enumerate(row)
        ]
    return max(best, key=lambda b: b[0])[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=6), st.integers(0, 1000), st.sampled_from([0.0, 1.0, 3.0]))
def test_side_by_side_viterbi_matches_one_by_one(sizes, seed, switch):
    rows = np.concatenate(([0], np.cumsum(sizes)))
    scores = np.random.default_rng(seed).integers(-5, 5, (rows[-1], 3)).astype(float)
    labels = li.viterbi(scores, rows, switch)
    for a, b in zip(rows, rows[1:]):
        if b > a:
            assert labels[a:b].tolist() == brute_viterbi(scores[a:b].tolist(), switch)


def test_held_out_texts_and_mixed_spans(spark, make):
    model = learned(spark)
    mixed = " ".join(texts(ENGLISH, 1, 5) + texts(RUSSIAN, 1, 6) + texts(GERMAN, 1, 7))
    found = {r.doc_id: r for r in li.identify(make([*texts(ENGLISH, 5, 9), *texts(GERMAN, 5, 9), mixed]), model).collect()}
    assert [found[i].lang_pred for i in range(10)] == ["en"] * 5 + ["de"] * 5
    assert [s.lang for s in found[10].spans] == ["en", "ru", "de"]
    assert found[10].spans[0].start == 0 and found[10].spans[-1].end == len(mixed)
    assert 0 < found[10].score < 1


def test_script_narrows_the_candidates(spark, make):
    model = learned(spark)
    found = li.identify(make(["щщщ ъъъ", "qqqq", "世界"]), model).collect()
    by_id = {r.doc_id: r.lang_pred for r in found}
    assert by_id[0] == "ru" and by_id[1] in ("de", "en") and by_id[2] in ("de", "en", "ru")


def test_counts_of_a_table_match_dictionaries():
    w = li.words_of(pa.array(["Ab c", None, "", "1 Äb"]))
    assert np.diff(w.rows).tolist() == [2, 0, 0, 1] and np.diff(w.first).tolist() == [2, 1, 2]
    assert w.starts.tolist() == [0, 3, 2]


def test_odd_rows(spark, odd):
    found = {r.doc_id: r for r in li.identify(odd, learned(spark)).collect()}
    for i in (0, 1, 2, 7, 16):
        assert (found[i].lang_pred, found[i].score, found[i].spans) == ("und", 0.0, [])
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == odd.select("doc_id").distinct().count()
    nothing = li.learn(odd.where("lang = 'none'").select("lang", "text"))
    assert {r.lang_pred for r in li.identify(odd, nothing).collect()} == {"und"}
    assert li.identify(odd.limit(0), nothing).collect() == []
