import random

from pyspark.sql import functions as F

from txquality.llm import line_dedup


def brute(docs):
    """Texts without the lines that later places of three-line windows cover; one place for each id and text."""
    seen, covered = set(), {}
    order = sorted({(d is not None, d if d is not None else 0, t) for d, t in docs if t is not None}, key=lambda x: x[:2])
    for has_id, doc_id, text in order:
        lines = text.split("\n")
        solid = [i for i, line in enumerate(lines) if line.strip(" ")]
        gone = set()
        for k in range(len(solid) - 2):
            window = tuple(lines[i].strip(" ") for i in solid[k : k + 3])
            if window in seen:
                gone |= set(solid[k : k + 3])
            seen.add(window)
        covered[has_id, doc_id, text] = gone
    out = []
    for doc_id, text in docs:
        gone = covered.get((doc_id is not None, doc_id if doc_id is not None else 0, text), set())
        out.append((doc_id, None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone), len(gone)))
    return sorted(out, key=repr)


def check(docs):
    got = [(r.doc_id, r.text, r.n) for r in line_dedup.remove_repeated_passages(docs, "n").collect()]
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_random_texts(make):
    draw = random.Random(2)
    check(make(["\n".join(draw.choice(["a", "b", "c ", "", "  ", "d"]) for _ in range(draw.randrange(14))) for _ in range(80)]))


def test_overlapping_repeats_within_one_text(make):
    check(make(["\n".join(["a"] * 7), "b\na\na\na\nc"]))


def test_odd_rows_and_other_columns(odd):
    check(odd)
    assert line_dedup.remove_repeated_passages(odd).columns == odd.columns
    assert line_dedup.remove_repeated_passages(odd.limit(0)).count() == 0


def test_shared_passage_in_every_text_stays_once(make):
    passage = "one two three\nfour five six\nseven eight nine"
    docs = make([f"start {i}\n{passage}\nend {i}" for i in range(200)])
    found = line_dedup.remove_repeated_passages(docs)
    assert found.where(F.col("text").contains("four five six")).select("doc_id").collect() == [(0,)]
    assert found.where(F.col("text").contains("start") & F.col("text").contains("end")).count() == 200
