import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txquality.llm import pieces as pc
from txquality.llm.queries import vocabulary_path


def small():
    names = ["", "", ""] + [""] * 256 + ["▁", "a", "b", "ab", "aba", "▁a", "ba", "c", "bc", "abab", "é", "▁▁", "bcab"]
    scores = np.zeros(len(names), np.int64)
    scores[259:] = -1000 * np.arange(1, len(names) - 258) - np.array([0, 7, 3, 900, 900, 50, 20, 0, 10, 1500, 2, 4, 2000])
    return pc.Vocabulary(names, scores, np.arange(3, 259))


@pytest.fixture(scope="module")
def code():
    return pc.Coder(small())


@pytest.fixture(scope="module")
def vocabulary():
    return pc.load(vocabulary_path())


def brute(code, text):
    """The best segmentation over the whole text at once."""
    chars = ["▁", *text.replace(" ", "▁")] if text else []
    own = [False, *(c == "▁" for c in text)] if text else []
    best, back = [0] + [None] * len(chars), {}
    for end in range(1, len(chars) + 1):
        for start in range(max(0, end - code.longest), end):
            found = -1 if any(own[start:end]) else code.by_text.get("".join(chars[start:end]), -1)
            if found < 0 and end - start > 1:
                continue
            total = best[start] + (int(code.v.scores[found]) if found >= 0 else code.byte_score)
            if best[end] is None or total > best[end]:
                best[end], back[end] = total, (start, found)
    out, end = [], len(chars)
    while end:
        start, found = back[end]
        out.append([found] if found >= 0 else [int(code.v.bytes_at[b]) for b in chars[start].encode()])
        end = start
    return [i for part in reversed(out) for i in part]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc é▁世\n", max_size=70), max_size=5))
def test_ids_are_the_best_and_decode_exactly(texts):
    code = pc.Coder(small())
    ids, bounds = code.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [brute(code, t) for t in texts]
    data, ends = code.decode(ids, bounds)
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(ends, ends[1:])] == texts


def test_long_parts_are_streamed_in_a_bounded_window(code):
    draw = random.Random(1)
    text = "".join(draw.choice("abc") for _ in range(5000))
    points = [ord(c) for c in text]
    ids = list(code.streamed(points))
    assert [i for i in ids] == brute(code, text)[1:] or brute(code, text)[0] == code.by_text["▁a"]
    ids, _ = code.encode([text])
    assert ids.tolist() == brute(code, text)


def test_ids_are_committed_before_the_text_ends(code):
    read = []

    class Watched(list):
        def __getitem__(self, i):
            read.append(i.stop if isinstance(i, slice) else i)
            return super().__getitem__(i)

    first = next(code.streamed(Watched([ord("c")] * 1000)))
    assert first == code.by_text["c"] and max(read) < 50


def test_public_vocabulary_on_odd_rows(odd, vocabulary):
    rows = pc.decoded(pc.encoded(odd, vocabulary, round_trip="same"), vocabulary).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.decoded == r.text and r.same and (r.ids is None) == (r.text is None)
        assert r.text != "" or r.ids == []
    assert pc.encoded(odd.limit(0), vocabulary).collect() == []
    assert pc.encoded(odd, vocabulary).columns == [*odd.columns, "ids"]


def test_public_vocabulary_matches_whole_text_search(vocabulary):
    code = pc.Coder(vocabulary)
    for text in ("The quick brown fox, jumps.", "Straße naïve 世界 x" * 5, "nowhitespacehere" * 20, "tabs\tand\nlines  two"):
        assert code.encode([text])[0].tolist() == brute(code, text)
