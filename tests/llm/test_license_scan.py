import random
import re

from txquality.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = [(label, text.split()) for label, base, text, _ in ls.TEMPLATES if base]


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text):
    w = words(text)
    places = [(i, label) for label, p in BASE for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = set()
    for label, _, template, phrase in ls.TEMPLATES:
        t, p = template.split(), phrase.split()
        at = next(i for i in range(len(t)) if t[i : i + len(p)] == p)
        for i in range(-len(t), len(w)):
            held = sum(0 <= i + j < len(w) and w[i + j] == x for j, x in enumerate(t))
            if i + at >= 0 and w[i + at : i + at + len(p)] == p and held / len(t) >= ls.FOUND_SHARE:
                labels.add(label)
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels))


def check(docs):
    got = sorted(((r.doc_id, *r[1:7]) for r in ls.scan(docs).collect()), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)


def test_phrases_and_templates_match_brute_force(make):
    draw = random.Random(3)
    stock = ["mit", "license", "License,", "apache", "general", "public", "the", "lesser", "gnu", "cc", "by", "nc", "x"]
    texts = [" ".join(draw.choice(stock) for _ in range(draw.randrange(25))) for _ in range(150)]
    for _, _, template, _ in ls.TEMPLATES:
        t = template.split()
        texts += [template.upper(), " ".join(t[1:]), "so " + " ".join(w if draw.random() < 0.9 else "z" for w in t) + " it is", " ".join(t[: len(t) // 2])]
    check(make(texts))


def test_odd_rows(odd):
    check(odd)
    assert ls.scan(odd.limit(0)).collect() == []


def test_scores(make):
    rows = {r.doc_id: r.score for r in ls.scan(make(["under the MIT License.", "nothing", None, ls.TEMPLATES[13][2].replace("documentation", "other")])).collect()}
    assert rows[0] == 1 and rows[1] == rows[2] == 0 and 0.75 <= rows[3] < 1
