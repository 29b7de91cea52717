import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from txquality.llm import interpolated_lm as lm

def apart():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(docs, weights):
    """Counts and scores by dictionaries, with the weights learned."""
    unigrams, pairs, starts = Counter(), Counter(), 0
    for doc_id, text in docs:
        if not held_out(doc_id):
            words = tokens(text)
            unigrams.update(words)
            pairs.update(zip(["start", *words], words))
            starts += 1
    total, vocabulary = sum(unigrams.values()), len(unigrams)
    out = {}
    for doc_id, text in docs:
        words, score, base = tokens(text), 0.0, 0.0
        for before, word in zip(["start", *words], words):
            context = starts if before == "start" else unigrams[before]
            w = weights[min(context.bit_length(), lm.BUCKETS - 1)]
            estimate = pairs[before, word] / context if context else 0.0
            score += math.log10(w[0] * estimate + w[1] * unigrams[word] / max(total, 1) + w[2] / (vocabulary + 1))
            base += math.log10((unigrams[word] + 1) / (total + vocabulary + 1))
        out[doc_id] = (held_out(doc_id), len(words), sum(unigrams[w] > 0 for w in words), total, round(base, 6), round(score, 6))
    return out


def scored(docs, monkeypatch):
    seen = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: seen.append(learn(*a)) or seen[-1])
    rows = lm.score_documents(docs, apart()).collect()
    return rows, seen[-1]


def test_counts_and_scores_match_dictionaries(make, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["the", "The", "cat", "dog", "ran", "sat", "on"] + [f"w{draw.randrange(40)}"]) for _ in range(draw.randrange(30))) for _ in range(120)]
    rows, weights = scored(make(texts), monkeypatch)
    want = brute(list(enumerate(texts)), weights)
    assert {r[0]: (*r[1:5], round(r[5], 6), round(r[6], 6)) for r in rows} == want
    assert np.allclose(weights.sum(1), 1) and (weights[1:] > 0).all()


def test_expectation_maximisation_raises_the_held_out_likelihood(make, monkeypatch):
    draw = random.Random(8)
    chain = {w: [draw.choice("abcdefghij") for _ in range(2)] for w in "abcdefghij"}
    texts = []
    for _ in range(300):
        word, out = "a", []
        for _ in range(20):
            word = draw.choice(chain[word])
            out.append(word)
        texts.append(" ".join(out))
    rows, weights = scored(make(texts), monkeypatch)
    held = [r for r in rows if r.held_out]
    mean = lambda name: sum(r[name] for r in held) / sum(r.n_tokens for r in held)
    assert mean("score") > mean("base_score") + 0.3
    frequent = weights[8:12]
    assert (frequent[:, 0] > 0.8).all()


def test_odd_rows(odd, monkeypatch):
    rows, weights = scored(odd, monkeypatch)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.n_known, r.train_tokens) for r in rows)
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    want = brute(docs, weights)
    assert got == sorted(((d is None, d or 0), want[d][1], want[d][2], want[d][3]) for d, _ in docs)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_nothing_to_learn_from_or_to_score(make):
    only = make(["a b", "c"]).where("doc_id < 0")
    assert lm.score_documents(only, apart()).collect() == []
    rows = lm.score_documents(make(["a b", None]), F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens) for r in rows] == [(0, 0), (0, 0)] and all(math.isfinite(r.score) for r in rows)
