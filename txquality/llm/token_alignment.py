"""Tokens of two tokenizers aligned over the bytes of a text.

``pandas.merge_asof`` finds for each token's start the other side's token that covers it;
the union of both directions is all overlaps. The texts of a batch are laid end to end and
both sides spell the same bytes, so a start lies in one text only. An overlap whose two
ends are equal closes a group. All tokens of a group are linked, first side
with second.

One pass encodes the texts and stores, for each document, its digest columns and the
distinct linked pairs with their occurrences. Pairs are then counted over all
documents (partial counts before the shuffle). Frequent pairs, as many as a bounded
table holds, come back to the documents by broadcast; the others, none of which is
frequent, by a join on the pair. So no pair that a third of all documents hold is ever
gathered, and nothing is left out.

A long text is encoded in parts, cut at single spaces between letters or digits: both
vocabularies start a new word there, so the ids are those of the whole text.

Defined cases: a text that is NULL, empty or not given back byte for byte by both
tokenizers has no tokens (zeros and an empty digest); special tokens' strings are
plain text; a NULL or repeated id is allowed, as rows are told apart by a number of
their own; repeated rows count as documents; an empty table gives no rows; only the
columns named are read, so others may have any names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality.llm import textkit as tk
from txquality.session import stored

PIECE_BYTES = 1 << 20
PART_BYTES = 1 << 16
SLICE_LINKS = 1 << 22
# pairs that are broadcast: 500,000 rows of 17 bytes
HEAD_PAIRS = 500_000
_DOC_BITS = 32
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


# fixed value: how a byte-level vocabulary splits a text into words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Vocabularies:
    """The files of both tokenizers: byte-level pairs (first side) and pieces (second side)."""

    first: bytes
    second: bytes

    @property
    def digest(self) -> str:
        return hashlib.sha256(self.first + b"\0" + self.second).hexdigest()


def load(first_path: str, second_path: str) -> Vocabularies:
    with open(first_path, "rb") as a, open(second_path, "rb") as b:
        return Vocabularies(a.read(), b.read())


def _byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokens(file: bytes) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary whose ids follow its merges, so that an id is its token's rank."""
    model = json.loads(file)["model"]
    numbers = model["vocab"]
    merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
    if model["type"] != "BPE" or any(numbers[token] != 256 + i for i, token in enumerate(merged)):
        raise ValueError("not a byte-level vocabulary whose ids follow its merges")
    alphabet = _byte_of_character()
    return [bytes(alphabet[c] for c in token) for token in sorted(numbers, key=numbers.get)]


class Encoders:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, files: Vocabularies):
        import sentencepiece
        import tiktoken

        self.first_bytes = byte_level_tokens(files.first)
        ranks = {token: number for number, token in enumerate(self.first_bytes)}
        self.first = tiktoken.Encoding("first", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=files.second)
        self.second_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.first_size = np.array([len(b) for b in self.first_bytes], np.int64)
        self.second_size = np.array([len(b) for b in self.second_bytes], np.int64)
        # texts can be cut before a space if no piece goes on over one
        self.cuts = not any(b" " in b.lstrip(b" ") for b in self.second_bytes)
        ends = (",", "|", ";", "")
        self.written = np.array([f"{i}{end}" for end in ends for i in range(max(len(self.first_bytes), len(self.second_bytes)))], object)
        self.numbers = len(self.written) // len(ends)

    def _piece(self, number: int) -> bytes:
        piece = self.second.id_to_piece(number)
        return bytes([int(piece[1:-1], 16)]) if self.second.is_byte(number) else piece.replace("▁", " ").encode()

    def parts(self, text: str) -> list[str]:
        if not self.cuts or len(text) <= PART_BYTES:
            return [text]
        out, at = [], 0
        while len(text) - at > PART_BYTES and (cut := _CUT.search(text, at + PART_BYTES)):
            out.append(text[at : cut.start()])
            at = cut.end()
        return [*out, text[at:]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, and the bounds of the texts in them; none for texts that do not come back."""
        parts = [self.parts(t) if t else [] for t in texts]
        flat = [p for ps in parts for p in ps]
        first = [self.first.encode_ordinary(f" {p}") for p in flat]
        second = self.second.encode(flat, num_threads=1) if flat else []
        owner = _bounds([len(ps) for ps in parts])
        wanted = [f" {t}".encode() if t else b"" for t in texts]
        sides, same = [], np.ones(len(texts), bool)
        for lists, token_bytes, sizes in ((first, self.first_bytes, self.first_size), (second, self.second_bytes, self.second_size)):
            held = list(chain.from_iterable(lists))
            ids = np.array(held, np.int64)
            bounds = _bounds([len(ids) for ids in lists])[owner]
            spelled = b"".join(map(token_bytes.__getitem__, held))
            at = _bounds(sizes[ids])[bounds].tolist()
            same &= np.array([spelled[s:e] == want for s, e, want in zip(at, at[1:], wanted)], bool)
            sides.append((ids, bounds))
        out = []
        for ids, bounds in sides:
            held = np.diff(bounds) * same
            out += [ids[np.repeat(same, np.diff(bounds))], np.concatenate(([0], np.cumsum(held)))]
        return tuple(out)


def overlaps(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of tokens whose bytes overlap, from the starts of both sides' tokens in order."""
    a, b = pd.DataFrame({"start": first, "i": np.arange(len(first))}), pd.DataFrame({"start": second, "j": np.arange(len(second))})
    covering_a = pd.merge_asof(a, b, on="start")
    covering_b = pd.merge_asof(b, a, on="start")
    # two tokens that start together are found from both sides
    later = covering_b["start"].to_numpy() > first[covering_b["i"].to_numpy()]
    return tuple(np.concatenate([covering_a[side].to_numpy(), covering_b[side].to_numpy()[later]]) for side in ("i", "j"))


def _bounds(sizes: Sequence[int] | np.ndarray) -> np.ndarray:
    """Where runs of these sizes start, and the end of the last."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def _collapsed(ids: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group with their number, and the groups' bounds."""
    codes, n = np.unique(group << _DOC_BITS | ids, return_counts=True)
    return codes & ((1 << _DOC_BITS) - 1), n, _bounds(np.bincount(codes >> _DOC_BITS, minlength=groups))


def _summed(rows: np.ndarray, pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences by row and pair, from entries whose rows are in order."""
    if len(rows) and int(rows[-1]).bit_length() + int(pairs.max()).bit_length() < 64:
        order = np.argsort(rows << int(pairs.max()).bit_length() | pairs)
    else:
        order = np.lexsort((pairs, rows))
    rows, pairs, n = rows[order], pairs[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (pairs[1:] != pairs[:-1]))))
    return rows[new], pairs[new], np.add.reduceat(n, new)


class Alignment:
    """Tokens of a few texts, aligned."""

    def __init__(self, coders: Encoders, texts: list[str]):
        self.coders, self.rows = coders, len(texts)
        self.a, self.a_bounds, self.b, self.b_bounds = coders.encode(texts)
        a_size, b_size = coders.first_size[self.a], coders.second_size[self.b]
        # both sides spell the same bytes, so starts run on from text to text
        a_start, b_start = _bounds(a_size)[:-1], _bounds(b_size)[:-1]
        a_doc = np.repeat(np.arange(self.rows), np.diff(self.a_bounds))
        i, j = overlaps(a_start, b_start)
        self.n_overlaps = np.bincount(a_doc[i], minlength=self.rows)
        closing = (a_start + a_size)[i] == (b_start + b_size)[j]
        # the last tokens of the groups on both sides; a group begins where the one before it is closed
        a_last, b_last = np.sort(i[closing]), np.sort(j[closing])
        self.groups = len(a_last)
        self.group_doc = a_doc[a_last]
        self.a_first, self.b_first = (np.concatenate(([0], last + 1)) for last in (a_last, b_last))
        self.a_group, self.b_group = (np.repeat(np.arange(self.groups), np.diff(first)) for first in (self.a_first, self.b_first))

    def digests(self) -> list[str]:
        """SHA-256 of the groups as text: ids of both sides, group after group."""
        c = self.coders
        a_last = np.zeros(len(self.a), np.int64)
        b_last = np.zeros(len(self.b), np.int64)
        a_last[self.a_first[1:] - 1] = 1  # "|"
        b_last[self.b_first[1:] - 1] = 2  # ";"
        final = self.b_bounds[1:][np.diff(self.b_bounds) > 0] - 1
        b_last[final] = 3
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + self.b_first[self.a_group]] = a_last * c.numbers + self.a
        codes[np.arange(len(self.b)) + self.a_first[self.b_group + 1]] = b_last * c.numbers + self.b
        written = c.written[codes].tolist()
        bounds = (self.a_bounds + self.b_bounds).tolist()
        return [hashlib.sha256("".join(written[s:e]).encode()).hexdigest() if e > s else "" for s, e in zip(bounds, bounds[1:])]

    def links(self) -> np.ndarray:
        """How many links each text has."""
        per_group = np.diff(self.a_first) * np.diff(self.b_first)
        return np.bincount(self.group_doc, per_group, self.rows).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs of each text: row, pair as one number, occurrences."""
        a, a_n, a_at = _collapsed(self.a, self.a_group, self.groups)
        b, b_n, b_at = _collapsed(self.b, self.b_group, self.groups)
        group = np.repeat(np.arange(self.groups), np.diff(a_at))
        others = np.diff(b_at)[group]
        done = np.cumsum(others)
        parts = [(np.zeros(0, np.int64),) * 3]
        at = 0
        while at < len(a):
            before = done[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(done, before + SLICE_LINKS, "right")))
            i, j = np.repeat(np.arange(at, to), others[at:to]), tk.ragged(b_at[group[at:to]], others[at:to])
            parts.append(_summed(self.group_doc[group[i]], pair_code(a[i], b[j]), a_n[i] * b_n[j]))
            at = to
        rows, pairs, n = (np.concatenate(x) for x in zip(*parts))
        return _summed(rows, pairs, n) if len(parts) > 2 else (rows, pairs, n)


PAIR_BITS = 20


def pair_code(first, second):
    """Two ids as one number; the first is the number shifted back."""
    return (first << PAIR_BITS) | second


_ENCODERS: dict[str, Encoders] = {}


def encoders(digest: str, files) -> Encoders:
    """A worker keeps the tokenizers of one pair of vocabularies, told apart by their content."""
    if digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[digest] = Encoders(files.value)
    return _ENCODERS[digest]


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, pairs array<long>, pair_n array<long>"


def _aligned(digest: str, files):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = encoders(digest, files)
        for piece in tk.pieces(batches, most=PIECE_BYTES):
            texts = [t or "" for t in piece.column(1).to_pylist()]
            found = Alignment(coders, texts)
            rows, pairs, n = found.pairs()
            bounds = pa.array(np.searchsorted(rows, np.arange(found.rows + 1)), pa.int32())
            count = lambda values: pa.array(np.asarray(values, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0), count(np.diff(found.a_bounds)), count(np.diff(found.b_bounds)),
                    count(np.bincount(found.group_doc, minlength=found.rows)), count(found.links()), count(found.n_overlaps), pa.array(found.digests(), pa.string()),
                    pa.ListArray.from_arrays(bounds, pa.array(pairs, pa.int64())), pa.ListArray.from_arrays(bounds, pa.array(n, pa.int64())),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "pairs", "pair_n"],
            )

    return run


def aligned(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Each document (doc_id, text) with counts, digest and its linked pairs."""
    files = docs.sparkSession.sparkContext.broadcast(vocabularies)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_aligned(vocabularies.digest, files), _ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """Each pair with the documents that hold it, and whether its first id is linked with none more often."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", PAIR_BITS).cast("int")), "alignment-counts")
    # a row for each id of the vocabulary at most
    highest = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("highest")))
    return counts.join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def _least_of_head(counts: DataFrame, most: int) -> int:
    """The smallest count such that pairs counted so often are at most ``most``; counts are looked at by powers of two."""
    heights = counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()
    total = 0
    for power, n in sorted(((r["power"], r["n"]) for r in heights), reverse=True):
        total += n
        if total > most:
            return 1 << (power + 1)
    return 1


def alignment(docs: DataFrame, vocabularies: Vocabularies, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Counts, best links and the digest of each document's groups."""
    rows = stored(aligned(docs, vocabularies).withColumn("row_no", F.monotonically_increasing_id()), "alignment-rows")
    counts = stored(pair_counts(rows), "alignment-pairs")
    least = _least_of_head(counts, head_pairs)
    head = F.broadcast(counts.where(F.col("docs") >= least))
    held = rows.select("row_no", F.inline(F.arrays_zip("pairs", "pair_n"))).toDF("row_no", "pair", "n")
    met = held.join(head, "pair", "left") if least > 1 else held.join(head, "pair")
    found = met.where(F.col("docs").isNotNull()).select("row_no", "n", "docs", "best")
    if least > 1:
        # each of these pairs stands in fewer than ``least`` rows
        rest = met.where(F.col("docs").isNull()).select("row_no", "pair", "n")
        found = found.unionByName(rest.join(counts.where(F.col("docs") < least), "pair").select("row_no", "n", "docs", "best"))
    sums = found.groupBy("row_no").agg(F.sum(F.col("n") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    out = rows.select("row_no", *names, "n_overlaps", "groups_sha256").join(sums, "row_no", "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return out.select(*names, zero("n_best"), zero("count_sum"), "groups_sha256", "n_overlaps")
