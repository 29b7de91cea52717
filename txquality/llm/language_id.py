"""Languages of mixed texts: scripts narrow the candidates, Viterbi labels the words.

Learned from labelled texts: for each language, how often each letter trigram
of a word (with its edges) and each whole word occurs, hashed into a table of
fixed size; and which scripts its letters are of. A word's score for a language
is the sum of its features' log probabilities. Only languages that use the
word's script are candidates for it (all, where none does). Viterbi then finds
the best labels of a text's words, where each switch of language costs
SWITCH; runs of one label are spans. The text's language is the one with the
most letters; its share of the letters is the score.

Words are runs of letters (Unicode), lower-cased one by one. Counts cover all
labelled documents: every batch adds up its own tables, Spark sums them by
language and slot, and only the tables (a fixed size for each language) reach
the driver.

Defined cases: NULL, empty and letterless texts are ``und`` with score 0 and
no span; documents without a language are not learned from; without any
labelled document every text is ``und``; ties go to the language that is first
by name; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality.llm import textkit as tk

SLOT_BITS = 15
SMOOTHING = 0.5
SWITCH = 12.0
UNKNOWN = "und"
# a script belongs to a language if it has at least this share of its letters
SCRIPT_SHARE = 0.01
# fixed values: first code point of each range, and the script of its letters
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"),
    (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for _, name in SCRIPTS])
_TOP = 0x110000
_TABLES: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter, and its lower case."""
    if not _TABLES:
        alpha, lower = np.zeros(_TOP, bool), np.arange(_TOP, dtype=np.uint32)
        for c in range(0x32000):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                alpha[c] = True
                small = chr(c).lower()
                if len(small) == 1:
                    lower[c] = ord(small)
        _TABLES.extend((alpha, lower))
    return _TABLES[0], _TABLES[1]


@dataclass
class Model:
    """Log probability of each feature slot in each language, and the languages of each script."""

    languages: list[str]
    slots: np.ndarray  # languages x slots
    scripts: np.ndarray  # scripts x languages


@dataclass
class Words:
    """The words of a piece: places in its letters, their features, rows and script."""

    first: np.ndarray  # first letter of each word, an index over all letters, and one past the last
    rows: np.ndarray  # first word of each row, and one past the last
    slots: np.ndarray  # trigram slots, one for each letter
    whole: np.ndarray  # slot of the whole word
    script: np.ndarray
    starts: np.ndarray  # first character within its row


def words_of(column: pa.Array) -> Words:
    alpha, lower = _letters()
    texts = [t or "" for t in column.to_pylist()]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    flags = alpha[points].astype(np.uint8)
    starts, ends, rows = tk.spans(flags, bounds, np.arange(256) == 1)
    size = ends - starts
    letters = lower[points[tk.ragged(starts, size)]].astype(np.uint64)
    first = np.concatenate(([0], np.cumsum(size)))
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    shift = np.uint64(64 - SLOT_BITS)
    before, after = np.zeros_like(letters), np.zeros_like(letters)
    before[1:], after[:-1] = letters[:-1], letters[1:]
    before[first[:-1]], after[first[1:] - 1] = 1, 1  # edges
    slots = (tk.mix((before << np.uint64(42)) ^ (letters << np.uint64(21)) ^ after) >> shift).astype(np.int64)
    ends_at = first[1:]
    whole = (tk.mix(tk.hash_spans(letters, first[:-1], ends_at) + np.uint64(5)) >> shift).astype(np.int64)
    script = _SCRIPT[np.searchsorted(_FIRST, points[starts], "right") - 1] if len(starts) else np.zeros(0, np.int64)
    return Words(first, rows, slots, whole, script, starts - bounds[row] if len(starts) else starts)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature and script counts of each language; slots after the last feature count letters by script."""
    width = (1 << SLOT_BITS) + len(NAMES)
    sums: dict[str, np.ndarray] = {}
    for piece in tk.pieces(batches):
        names, which = np.unique(piece.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        w = words_of(piece.column(1))
        of_word = np.repeat(which, np.diff(w.rows))
        of_letter = np.repeat(of_word, np.diff(w.first))
        for i, name in enumerate(names):
            table = sums.setdefault(name, np.zeros(width, np.int64))
            own = of_word == i
            table += np.bincount(w.slots[of_letter == i], minlength=width) + np.bincount(w.whole[own], minlength=width)
            table += np.bincount((1 << SLOT_BITS) + w.script[own], np.diff(w.first)[own], width).astype(np.int64)
    for name, table in sums.items():
        held = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(held), pa.string()), pa.array(held), pa.array(table[held])], ["lang", "slot", "n"])


def learn(labelled: DataFrame) -> Model:
    """A model of the rows (lang, text), all of them."""
    found = labelled.where("lang is not null").select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(_tables, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique()) if len(found) else []
    counts = np.zeros((len(languages), (1 << SLOT_BITS) + len(NAMES)))
    if len(found):
        counts[np.searchsorted(languages, found["lang"]), found["slot"]] = found["n"]
    features, scripts = counts[:, : 1 << SLOT_BITS], counts[:, 1 << SLOT_BITS :]
    logs = np.log((features + SMOOTHING) / (features.sum(1, keepdims=True) + SMOOTHING * (1 << SLOT_BITS)))
    uses = scripts.T >= SCRIPT_SHARE * np.maximum(scripts.sum(1), 1)[None, :]
    uses[~uses.any(1)] = True
    return Model(list(languages), logs, uses)


def viterbi(scores: np.ndarray, rows: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each word, all rows side by side: word k of every row that has one is one step."""
    size = np.diff(rows)
    order = np.argsort(-size, kind="stable")
    start, size = rows[:-1][order], size[order]
    labels = np.zeros(len(scores), np.int64)
    if not len(scores):
        return labels
    keep = np.zeros(scores.shape, bool)  # the label's best path comes from the same label
    top_before = np.zeros(len(scores), np.int64)
    best = np.zeros((len(size), scores.shape[1]))
    live = np.searchsorted(-size, -np.arange(int(size[0])), "left")
    for k, n in enumerate(live):
        at = start[:n] + k
        if k:
            top = best[:n].argmax(1)
            moved = best[np.arange(n), top] - switch
            stay = best[:n] >= moved[:, None]
            keep[at], top_before[at] = stay, top
            best[:n] = np.where(stay, best[:n], moved[:, None])
        best[:n] += scores[at]
    label = best.argmax(1)
    for k in range(int(size[0]) - 1, -1, -1):
        n = live[k]
        at = start[:n] + k
        labels[at] = label[:n]
        label[:n] = np.where(keep[at, label[:n]], label[:n], top_before[at])
    return labels


def label_words(w: Words, model: Model) -> np.ndarray:
    letters = np.concatenate((np.zeros((len(model.languages), 1)), np.cumsum(model.slots[:, w.slots], 1)), 1)
    scores = (letters[:, w.first[1:]] - letters[:, w.first[:-1]] + model.slots[:, w.whole]).T
    scores = np.where(model.scripts[w.script], scores, scores - 1e6)
    return viterbi(scores, w.rows, SWITCH)


def _predict(shared: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        count = len(model.languages)
        for piece in tk.pieces(batches):
            n = piece.num_rows
            w = words_of(piece.column(1))
            row = np.repeat(np.arange(n), np.diff(w.rows))
            size = np.diff(w.first)
            shares = np.zeros((n, count + 1))
            label = label_words(w, model) if count else np.full(len(row), 0)
            np.add.at(shares, (row, label), size)
            total = shares.sum(1) if count else np.zeros(n)
            found = np.where(total > 0, shares.argmax(1), count)
            turns = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (label[1:] != label[:-1])))) if len(row) and count else np.zeros(0, np.int64)
            lasts = np.append(turns[1:], len(row)) - 1 if len(turns) else turns
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row[turns], np.arange(n + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(w.starts[turns]), pa.array(w.starts[lasts] + size[lasts]), pa.array(names[label[turns]].tolist(), pa.string())], ["start", "end", "lang"]),
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(names[found].tolist(), pa.string()), pa.array(np.where(total > 0, shares.max(1) / np.maximum(total, 1), 0.0)), spans],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every document; a span is of characters from start to before end."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_predict(shared), f"doc_id {kind}, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>")
