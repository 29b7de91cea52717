import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from txquality.llm import textkit as tk

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té世.1", max_size=30)), max_size=12)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_spans_are_what_split_gives(texts):
    data, bounds = tk.text_bytes(pa.array(texts, pa.string()))
    starts, ends, rows = tk.spans(data, bounds, tk.NOT_SPACE)
    raw = data.tobytes()
    got = [[raw[starts[i] : ends[i]] for i in range(rows[r], rows[r + 1])] for r in range(len(texts))]
    assert got == [(t or "").encode().split() for t in texts]


@settings(max_examples=50, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes_wherever_they_stand(texts):
    data, bounds = tk.text_bytes(pa.array(texts, pa.string()))
    starts, ends, _ = tk.spans(data, bounds, tk.NOT_SPACE)
    raw = data.tobytes()
    for h, s, e in zip(tk.hash_spans(data, starts, ends), starts, ends):
        assert int(h) == tk.hash_word(raw[s:e])


def test_hashes_do_not_depend_on_blocks():
    word = b"w" * (tk._BLOCK + 100)
    text = b" ".join([b"a", word, b"b", word])
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = tk.spans(data, np.array([0, len(data)]), tk.NOT_SPACE)
    hashes = tk.hash_spans(data, starts, ends)
    assert hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3


def test_slices_and_pieces_keep_rows():
    column = pa.array(["ab", None, "", "c d", "e" * 50])
    batch = pa.record_batch({"text": column}).slice(1)
    assert [b.column(0).to_pylist() for b in tk.pieces(iter([batch]), most=4)] == [[None, "", "c d"], ["e" * 50]]


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing_round_trips(values):
    array = np.array(values, np.uint64)
    assert tk.unpack(tk.pack(array)).tolist() == values
    assert tk.unpack_sorted(tk.pack_sorted(np.sort(array))).tolist() == sorted(values)


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 5)), max_size=10))
def test_ragged_runs(runs):
    starts, lengths = np.array([r[0] for r in runs], np.int64), np.array([r[1] for r in runs], np.int64)
    assert tk.ragged(starts, lengths).tolist() == [s + i for s, n in runs for i in range(n)]
