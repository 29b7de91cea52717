import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from txquality.llm import queries, spelling_variants

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def counts(docs):
    words = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def edited(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(docs):
    n = counts(docs)
    # words with one letter left out in common are the only ones that can be near
    holes = {}
    for w in n:
        for hole in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            holes.setdefault(hole, set()).add(w)
    near = {w: set() for w in n}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if edited(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def found(spark, docs, columns="doc_id long, text string"):
    rows = spelling_variants.variants(spark.createDataFrame(docs, columns).repartition(3)).collect()
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)


def planted():
    """A chain of forms, ties between them, words of equal letters, one edit at every place."""
    draw = random.Random(5)
    texts = ["spelling " * 2000, "speling " * 150, "spelin " * 12 + "speliin " * 12, "spelinx speling " * 2, "aaaaaaaa " * 40 + "aaaaaaa aaaaaaaaa " * 3, "Überprüfung ÜBERPRÜFUNG überprüfung " * 5, "naïveté÷× " * 4]
    base = "manuscript"
    for i in range(len(base) + 1):
        texts.append(f"{base[:i]}é{base[i:]} " * 2 + f"{base[:i]}{base[i + 1:]} " * 3 + f"{base[:i]}z{base[i + 1:]} " * 2)
    texts.append(f"{base} " * 90)
    stems = ["".join(draw.choice("abc") for _ in range(draw.randint(7, 9))) for _ in range(500)]
    texts += [" ".join(draw.choices(stems, k=80)) for _ in range(40)]
    return list(enumerate(texts))


def test_equals_all_pairs(spark):
    docs = planted()
    assert found(spark, docs) == brute(docs)


def test_groups_of_many_tiles(spark, monkeypatch):
    """A group above a tile is compared tile against tile, with the same result."""
    monkeypatch.setattr(spelling_variants, "TILE", 4)
    monkeypatch.setattr(spelling_variants, "LOT_ROWS", 50)
    docs = planted()
    assert found(spark, docs) == brute(docs)


def test_odd_texts(spark):
    long = "y" * 3_000
    docs = [(1, None), (2, ""), (3, "short words only"), (None, "without an identity"), (None, "without an identity"), (4, "repeated repeated"), (4, "repeated repeated"), (5, f"{long} {long} {long}y {long}y {long[:-1]}x {long[:-1]}x"), (6, "letters " * 100_000), (7, "interior×word interior÷word Äpfelchen äpfelchen Äpfelchen")]
    assert found(spark, docs) == brute(docs)


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    docs = [(i, t, "w", 1, 2, "k") for i, t in planted()[:12]]
    assert found(spark, docs, "doc_id long, text string, word string, n int, c int, key string") == brute([d[:2] for d in docs])


def test_common_ends_of_every_edit():
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("ab"), draw.integers(1, 9))) for _ in range(60)]
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    lengths = np.array([len(w) for w in words])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    prefix, suffix = spelling_variants.common_ends(data, np.cumsum(lengths) - lengths, lengths, i, j)
    for a, b, p, s in zip(i, j, prefix, suffix):
        assert p == len(os.path.commonprefix([words[a], words[b]])) and s == len(os.path.commonprefix([words[a][::-1], words[b][::-1]]))
        if words[a] != words[b]:
            assert edited(words[a], words[b]) == (abs(lengths[a] - lengths[b]) <= 1 and p + s >= max(lengths[a], lengths[b]) - 1)


@pytest.mark.parametrize("folder", [SF_DIR])
def test_registered_query(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    rows = queries.op12_spelling_variants(spark, folder).collect()
    assert sorted(tuple(r) for r in rows) == brute(docs)
