import random

import numpy as np
from pyspark.sql import functions as F

from txquality.llm import toxicity as tx

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [f"word{draw.randrange(200)}" for _ in range(30)]
        kind = draw.random()
        if kind < 0.2:
            words[draw.randrange(30)] = draw.choice(["vile", "nasty", "horrid"])
            words[draw.randrange(30)] = draw.choice(["vile", "nasty", "horrid"])
        elif kind < 0.4:
            words = ["click", "here"] * 15
        texts.append(" ".join(words))
        labels.append((i, 0 if 0.2 <= kind < 0.4 else 1, 1 if kind < 0.2 else 0))
    return texts, labels


def test_held_out_accuracy_and_order_of_grades(spark, make):
    texts, labels = corpus(900, 1)
    docs = make(texts)
    model = tx.fit(docs, spark.createDataFrame([x for x in labels if x[0] < 600], LABELS))
    rows = {r.doc_id: r for r in tx.scored(docs, model).withColumn("out", tx.rejected()).collect()}
    held = [(rows[i], quality, toxic) for i, quality, toxic in labels if i >= 600]
    assert sum(r.out == bool(toxic) for r, _, toxic in held) >= 0.98 * len(held)
    mean = lambda grade: np.mean([r.severity for r, q, t in held if (2 if t else 1 - q) == grade])
    assert mean(0) < mean(1) < mean(2)
    assert model.thresholds[0] < model.thresholds[1]


def test_gradient_reaches_the_likelihoods_maximum():
    rng = np.random.default_rng(3)
    x = rng.standard_normal(4000)
    grade = np.digitize(1.5 * x + rng.logistic(size=4000), [-1.0, 2.0])
    w, thresholds = tx.fit_ordinal(np.arange(4000), np.zeros(4000, int), x, grade, 1, 3)
    assert abs(w[0] - 1.5) < 0.15 and abs(thresholds[0] + 1) < 0.15 and abs(thresholds[1] - 2) < 0.2


def test_the_sample_is_bounded(spark, make, monkeypatch):
    texts, labels = corpus(600, 2)
    sizes = []
    keep = tx.stored
    monkeypatch.setattr(tx, "stored", lambda df, label: sizes.append((label, (out := keep(df, label)).count())) or out)
    model = tx.fit(make(texts), spark.createDataFrame(labels, LABELS), most=200)
    assert 120 < dict(sizes)["toxicity-sample"] < 280 and (model.weights != 0).any()


def test_odd_rows_and_labels(spark, odd):
    some = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 1, 0), (5, None, None), (None, 1, 1), (77, 0, 0)], LABELS)
    for labels in (some, some.limit(0), some.where("doc_id = 4")):
        rows = tx.scored(odd, tx.fit(odd, labels)).collect()
        assert len(rows) == odd.count() and all(0 <= r.severity <= 2 and 0 <= r.p_toxic <= 1 for r in rows)
    assert [r.severity < 0.01 for r in rows] == [True] * len(rows)
    assert tx.scored(odd.limit(0), tx.fit(odd, some)).collect() == []
    grades = {r.doc_id: r.grade for r in tx.grade_of(some).collect()}
    assert grades == {3: 2, 4: 0, 77: 1}


def test_whole_text_counts(spark, make):
    texts, labels = corpus(600, 4)
    late = "fine words only " * 20_000 + "vile nasty horrid"
    docs = make([*texts, late, "fine words only " * 20_000])
    model = tx.fit(docs, spark.createDataFrame(labels, LABELS))
    rows = {r.doc_id: r.p_toxic for r in tx.scored(docs, model).where(F.col("doc_id") >= 600).collect()}
    assert rows[600] > 0.5 > rows[601]


def test_no_step_from_the_fit_raises_the_likelihood_of_several_features():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 4)) * (rng.random((3000, 4)) < 0.5)
    grade = np.digitize(x @ [2.0, -1.0, 0.5, 0.0] + rng.logistic(size=3000), [-0.5, 1.0])
    row, column = np.nonzero(x)
    w, thresholds = tx.fit_ordinal(row, column, x[row, column], grade, 4, 3)

    def likelihood(w, thresholds):
        total = 0.0
        for score, k in zip(x @ w, grade):
            up = 1 / (1 + np.exp(score - thresholds[k])) if k < 2 else 1.0
            down = 1 / (1 + np.exp(score - thresholds[k - 1])) if k > 0 else 0.0
            total += np.log(up - down)
        return total / len(grade) - tx.RIDGE / 2 * (w**2).sum()

    top = likelihood(w, thresholds)
    for i in range(4):
        for step in (-0.05, 0.05):
            assert likelihood(w + step * (np.arange(4) == i), thresholds) < top
    for i in range(2):
        for step in (-0.05, 0.05):
            assert likelihood(w, thresholds + step * (np.arange(2) == i)) < top


def test_scores_match_a_plain_sum_over_each_text(spark, make):
    texts, labels = corpus(400, 6)
    docs = make(texts)
    model = tx.fit(docs, spark.createDataFrame(labels, LABELS))
    for r in tx.scored(docs, model).collect():
        raw = r.text.encode()
        _, found = tx.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        counts = {f: found.tolist().count(f) for f in set(found.tolist())}
        score = sum(model.weights[f] * np.log(1 + n) for f, n in counts.items())
        above = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert abs(r.severity - sum(above)) < 1e-9 and abs(r.p_toxic - above[1]) < 1e-9
