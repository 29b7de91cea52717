import hashlib
import os
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers

from txquality.llm import queries, token_alignment

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def files():
    return token_alignment.load(queries.byte_vocabulary_path(), queries.vocabulary_path())


@pytest.fixture(scope="module")
def sides(files):
    """Both tokenizers as plain functions: (id, bytes) of each token of a whole text."""
    pairs = tokenizers.Tokenizer.from_file(queries.byte_vocabulary_path())
    pairs.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary_path())
    split = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    # code points below U+0800 spell every byte but some that no UTF-8 text begins with
    known = {c: b for point in range(0x800) for c, b in zip(split.pre_tokenize_str(chr(point))[0][0], chr(point).encode())}
    known |= {c: b for point in range(0x800, 0x110000, 0x40) if not 0xD800 <= point < 0xE000 for c, b in zip(split.pre_tokenize_str(chr(point))[0][0], chr(point).encode())}

    def first(text):
        ids = pairs.encode(f" {text}", add_special_tokens=False).ids
        return [(i, bytes(known[c] for c in pairs.id_to_token(i))) for i in ids]

    def second(text):
        out = []
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            out.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        return out

    return first, second


def brute(docs, sides):
    held, counts = [], Counter()
    for doc_id, text in docs:
        a, b = ([], []) if not text else (sides[0](text), sides[1](text))
        whole = f" {text}".encode()
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a, b = [], []
        groups, i, j = [], 0, 0
        while i < len(a):
            left, right = [a[i][0]], [b[j][0]]
            end_a, end_b = len(a[i][1]), len(b[j][1])
            i, j = i + 1, j + 1
            while end_a != end_b:
                if end_a < end_b:
                    left.append(a[i][0])
                    end_a, i = end_a + len(a[i][1]), i + 1
                else:
                    right.append(b[j][0])
                    end_b, j = end_b + len(b[j][1]), j + 1
            groups.append((left, right))
        links = [(x, y) for left, right in groups for x in left for y in right]
        counts.update(set(links))
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        held.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    rows = [(d, a, b, g, len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), sha) for d, a, b, g, links, sha in held]
    return sorted(rows, key=str)


def found(spark, files, docs, columns="doc_id long, text string", **how):
    rows = token_alignment.alignment(spark.createDataFrame(docs, columns).repartition(3), files, **how).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in rows), key=str)


def texts():
    draw = random.Random(8)
    odd = ["", None, " ", "\n\n", "  two  spaces ", "<|endoftext|> and <s> </s>", "tab\tand\r\nline", "żółć 世界 مرحبا 🙂🙂 ñ", "a\x00b", "▁ mark ▁", "it's we'll DON'T", "1234567890" * 30, "y" * 3000, "=" * 700 + "x", " " * 50, "  x", "ﬁne ½ Å Å", "same text twice", "same text twice"]
    words = "the of stream alignment über naïve Zürich 42 3.14 don't (x) -> émigré data\nbase".split(" ")
    return odd + [" ".join(draw.choices(words, k=draw.randrange(1, 60))) for _ in range(60)]


def test_equals_brute_force(spark, files, sides):
    docs = [*enumerate(texts()), (None, "no id here"), (None, "nor here"), (3, "a second text of this id")]
    assert found(spark, files, docs) == brute(docs, sides)


@pytest.mark.parametrize("head", [0, 7, 40])
def test_pairs_beyond_the_broadcast_ones_are_joined(spark, files, sides, head):
    docs = list(enumerate(texts()))
    assert found(spark, files, docs, head_pairs=head) == brute(docs, sides)


def test_one_group_holds_a_third(spark, files, sides):
    docs = [*enumerate(texts()), *[(7, "a row that is there very often indeed")] * 40]
    assert found(spark, files, docs, head_pairs=5) == brute(docs, sides)


def test_long_texts_are_cut_where_words_start(files, sides):
    coders = token_alignment.Encoders(files)
    assert coders.cuts
    draw = random.Random(2)
    kept = [t for t in texts()[4:17] if b"".join(b for _, b in sides[1](t)) == f" {t}".encode()]
    assert len(kept) > 8
    long = "".join(draw.choice(kept + ["plain words here ", "Number 7 of 9 "]) for _ in range(3000))
    assert len(coders.parts(long)) > 2 and " ".join(coders.parts(long)) == long
    a, _, b, _ = coders.encode([long, "", "short"])
    assert a.tolist() == [i for i, _ in sides[0](long)] + [i for i, _ in sides[0]("short")]
    assert b.tolist() == [i for i, _ in sides[1](long)] + [i for i, _ in sides[1]("short")]


def test_a_text_longer_than_a_piece(spark, files, sides):
    docs = [(1, "many plain words, and some more; " * 50_000), (2, "z" * 200_000), (3, "short")]
    assert found(spark, files, docs) == brute(docs, sides)


def test_empty_table_and_clashing_names(spark, files, sides):
    assert found(spark, files, []) == []
    docs = [(i, t, 1, [2], "x") for i, t in enumerate(texts()[:9])]
    assert found(spark, files, docs, "doc_id long, text string, n_a int, pairs array<int>, row_no string") == brute([d[:2] for d in docs], sides)


def test_merge_asof_finds_all_overlaps(files):
    found = token_alignment.Alignment(token_alignment.Encoders(files), ["unbelievable alignment", "", "zażółć"])
    a, b = found.coders.first_size[found.a], found.coders.second_size[found.b]
    starts = [(s.cumsum() - s, s.cumsum()) for s in (a, b)]
    want = [sum(x < f and e < y for x, y in zip(*starts[0]) for e, f in zip(*starts[1]))]
    assert found.n_overlaps.sum() == want[0]


def test_registered_query(spark, files, sides):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    rows = queries.op11_token_alignment(spark, SF_DIR).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute(docs, sides)


def test_steps_on_tokens_keep_no_table_of_documents(files, monkeypatch):
    """Starts run on over the texts of a batch, so neither a key nor a search for doubles is needed."""
    merged = []
    merge_asof = token_alignment.pd.merge_asof
    monkeypatch.setattr(token_alignment.pd, "merge_asof", lambda *sides, **how: merged.append(how) or merge_asof(*sides, **how))
    monkeypatch.setattr(token_alignment.pd.DataFrame, "drop_duplicates", lambda *_: pytest.fail("overlaps are compared as rows"))
    coders = token_alignment.Encoders(files)
    texts = ["", "unbelievable alignment", "", "zażółć", "two  spaces", "zażółć", ""]
    together = token_alignment.Alignment(coders, texts)
    assert merged == [{"on": "start"}] * 2
    alone = [token_alignment.Alignment(coders, [t]) for t in texts]
    assert together.digests() == [a.digests()[0] for a in alone]
    assert together.links().tolist() == [a.links()[0] for a in alone] and together.n_overlaps.tolist() == [a.n_overlaps[0] for a in alone]
    rows, pairs, n = together.pairs()
    assert [(r, p, k) for r, a in enumerate(alone) for _, p, k in zip(*a.pairs())] == list(zip(rows, pairs, n))
    assert not len(token_alignment.Alignment(coders, ["", ""]).pairs()[0])
