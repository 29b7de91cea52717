import random
import re

import numpy as np

from txquality.llm import decontaminate as dc

ITEMS = "item_id long, text string"
QUESTION = "A train leaves London at 9 and travels 120 km to meet Alice, who waits 45 minutes there; how far does Alice walk if she starts 120 m away?"


def found(spark, docs, items):
    return {r.doc_id: r for r in dc.verdicts(docs, spark.createDataFrame(items, ITEMS)).collect()}


def test_changed_values_are_caught_if_consistent(spark, make):
    changed = QUESTION.replace("London", "Paris").replace("120", "300").replace("45", "10").replace("km", "miles").replace("Alice", "Berta")
    torn = changed.replace("300 m", "77 m").replace("Berta walk", "Clara walk")
    rows = found(spark, make([QUESTION, changed, torn, "Nothing of the kind is written here, in a text of more than thirteen words in all.", f"Before it. {changed} After it."]), [(1, QUESTION)])
    assert [rows[i].contaminated for i in range(5)] == [True, True, False, False, True]
    assert [rows[i].values_changed for i in range(5)] == [False, True, False, False, True]
    assert list(rows[4]["items"]) == [1]


def test_literal_passages_match_brute_force(spark, make):
    draw = random.Random(7)
    word = lambda: draw.choice("abcdefghij") + draw.choice("aeiou") + draw.choice("klmnop")
    items = [(i, " ".join(word() for _ in range(draw.randrange(5, 40)))) for i in range(20)]
    texts = []
    for _ in range(120):
        own = [word() for _ in range(draw.randrange(5, 60))]
        if draw.random() < 0.6:
            item = draw.choice(items)[1].split()
            a = draw.randrange(len(item))
            cut = item[a : a + draw.randrange(1, 40)] if draw.random() < 0.7 else item
            at = draw.randrange(len(own))
            own[at:at] = cut
        texts.append(" ".join(own))
    rows = found(spark, make(texts), items)
    for i, text in enumerate(texts):
        words = text.split()
        hit = set()
        for item_id, item in items:
            t = item.split()
            need = min(len(t), dc.RUN_WORDS)
            if any(words[p : p + need] == t[q : q + need] for p in range(len(words) - need + 1) for q in range(len(t) - need + 1)):
                hit.add(item_id)
        assert set(rows[i]["items"]) == hit and rows[i].contaminated == bool(hit)


def test_case_and_punctuation_do_not_hide(spark, make):
    item = "the river of éclairs runs past a mill where nobody has ever ground any corn at all"
    rows = found(spark, make([item.upper(), "!! ".join(item.split()), re.sub(" ", "\n", item)]), [(5, item)])
    assert all(rows[i].contaminated for i in range(3))


def test_the_join_without_a_sift_gives_the_same(spark, make, monkeypatch):
    docs, items = make([QUESTION, "x " + QUESTION.replace("120", "7"), "clean"]), [(1, QUESTION), (2, QUESTION)]
    sifted = found(spark, docs, items)
    monkeypatch.setattr(dc, "SIFT_WINDOWS", 0)
    assert found(spark, docs, items) == sifted and list(sifted[1]["items"]) == [1, 2]


def test_odd_rows(spark, odd):
    items = [(1, None), (2, ""), (3, "one"), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (None, "a document without an id of three lines"), (6, "x " * 30)]
    rows = dc.verdicts(odd, spark.createDataFrame(items, ITEMS)).collect()
    assert len(rows) == odd.count()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.contaminated) == [(False, 8), (True, None)]
    kept = dc.decontaminated(odd, spark.createDataFrame(items, ITEMS))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    nothing = spark.createDataFrame([], ITEMS)
    assert not any(r.contaminated for r in dc.verdicts(odd, nothing).collect())
    assert dc.verdicts(odd.limit(0), nothing).collect() == []


def test_a_verbatim_stretch_counts_beside_a_conflict(spark, make):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    words[5] = words[25] = "9"
    torn = [*words[:25], "7", *words[26:]]
    other = [*words[:5], "8", *words[6:25], "7", *words[26:]]
    near = [*words[:5], "8", *words[6:12], "and", *words[12:]]
    changed = [*words[:5], "8", *words[6:25], "8", *words[26:]]
    rows = found(spark, make([" ".join(t) for t in (torn, other, [*words[:12], "and", *words[24:]], near, changed)]), [(1, " ".join(words))])
    assert [rows[i].contaminated for i in range(5)] == [True, True, False, True, True]
    assert [rows[i].run_words for i in range(5)] == [25, 19, 0, 18, 30]
    assert [rows[i].values_changed for i in range(5)] == [False, False, False, False, True]


def test_verbatim_copies_match_whatever_their_case(spark, make):
    accented = "nous aimons été comme éclair et œuvre dès que réélu à côté"
    plain = "the old mill by the river has not ground any corn since the last war ended there"
    named = "once the miller of Upper Dale and Anna Bell of Lower Dale went to Green Field Market together"
    items = [(1, accented), (2, plain), (3, named)]
    texts = [accented.upper(), "Und " + accented.upper(), plain.title(), plain.upper(), named.lower(), named.upper(), named.title(), plain.title().replace("Corn", "Rye")]
    rows = found(spark, make(texts), items)
    assert [list(rows[i]["items"]) for i in range(8)] == [[1], [1], [2], [2], [3], [3], [3], []]
    assert not any(rows[i].values_changed for i in range(8))


def test_an_accented_capital_second_makes_no_name():
    text = "Le mot ÉÉTAIT RÉÉLU et Éric ou Rémy ou ŒUVRE sŒur À"
    raw = np.frombuffer(text.encode(), np.uint8)
    words, kind, _, _ = dc.template(raw, np.array([0, len(raw)]))
    assert [w for w, k in zip(text.split(), kind) if k == dc.NAME] == ["Éric", "Rémy"]
    low = np.frombuffer(text.lower().encode(), np.uint8)
    assert (dc.template(low, np.array([0, len(low)]))[0] == words).all()


def test_exact_copies_of_items_full_of_slots_are_found(spark, make):
    short = "What is 12 plus 34?"
    edge = "please weigh the pears at 5 kg 7 g 3 mg"
    dense = "mix the two powders well then add 10 g 20 g 30 g 40 g 50 g and stir it"
    numbers = "1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    items = [(1, short), (2, edge), (3, dense), (4, numbers)]
    texts = [
        f"So: {short} Easy.", edge, f"Please {dense}", numbers,
        short.replace("34", "35"), edge.replace("pears", "plums"), numbers.replace("7", "70"), edge.replace("5 kg", "6 kg"),
        dense.replace("50 g", "60 g"),
    ]
    rows = found(spark, make(texts), items)
    assert [list(rows[i]["items"]) for i in range(9)] == [[1], [2], [3], [4], [], [], [], [], [3]]
    assert rows[2].run_words == len(dense.split()) and not any(rows[i].values_changed for i in range(8))


def test_template_and_plain_words_make_one_run(spark, make):
    item = "a farmer sold 30 apples and then gave away half of them at 7 m 5 cm 7 mm"
    changed = item.replace("30", "40")
    rows = found(spark, make([changed, changed.replace("mm", "km")]), [(1, item)])
    assert [rows[i].run_words for i in range(2)] == [len(item.split()), len(item.split()) - 1]
    assert all(rows[i].values_changed for i in range(2))


def test_rows_of_one_id_or_without_one_stand_for_themselves(spark):
    """Parts of an item in several rows are no run, whatever ids the rows share."""
    item = " ".join(f"token{chr(97 + i)}x" for i in range(26))
    words = item.split()
    parts = [" ".join(words[:9]), "nothing of it at all in this row", " ".join(words[8:20])]
    for doc_id in (None, 7):
        docs = spark.createDataFrame([(doc_id, t) for t in parts] + [(doc_id, item), (8, None), (9, "")], "doc_id long, text string").repartition(3)
        bench = spark.createDataFrame([(1, item), (2, item), (2, item)], "item_id long, text string")
        found = [(r.doc_id, r.contaminated, r["items"], r.run_words) for r in dc.verdicts(docs, bench).collect()]
        assert sorted(found, key=str) == sorted([(doc_id, False, [], 0)] * 3 + [(doc_id, True, [1, 2], 26), (8, False, [], 0), (9, False, [], 0)], key=str)
        kept = [r.text for r in dc.decontaminated(docs, bench).collect()]
        assert sorted(kept, key=str) == sorted([*parts, None, ""], key=str)


def test_items_that_repeat_are_looked_for_once(spark):
    item = " ".join(f"other{chr(97 + i)}y" for i in range(20))
    docs = spark.createDataFrame([(i, f"intro {item} end {i}") for i in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, item) for i in range(50)], "item_id long, text string")
    assert dc._matched(docs, bench).count() == 20
    assert all(r["items"] == list(range(50)) for r in dc.verdicts(docs, bench).collect())
    assert dc.matches(docs, bench).count() == 1000


def test_a_text_longer_than_a_piece_and_clashing_names(spark):
    item = " ".join(f"long{chr(97 + i)}z" for i in range(20))
    text = "filler words go here " * 150_000 + item + " more filler" * 50_000
    columns = "doc_id long, text string, item string, items string, words int, doc string, hash int"
    docs = spark.createDataFrame([(1, text, "a", "b", 1, "c", 2), (2, text[:-1000].replace("longaz", "x"), "a", "b", 1, "c", 2)], columns)
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert {r.doc_id: (r.contaminated, r.run_words) for r in dc.verdicts(docs, bench).collect()} == {1: (True, 20), 2: (True, 19)}
    kept = dc.decontaminated(docs, spark.createDataFrame([(5, f"{item} absent")], "item_id long, text string"))
    assert kept.columns == docs.columns and kept.count() == 0
