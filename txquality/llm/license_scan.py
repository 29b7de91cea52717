"""Licence texts found through a positional index of their rare words.

The index holds, for each licence template, where each of its words stands, and
one entry word: the word of the template's mandatory phrase with the highest
IDF over the scanned documents. A file looks up the entry words that it holds;
each place of one proposes an alignment of the template. On it, the postings of
all template words are intersected by relative position. The template is found
when every word of the mandatory phrase stands in its place and the share of
template words in place is at least FOUND_SHARE.

A template that is its own mandatory phrase (the base phrases are) is found at
every place where its words stand one after the other.

Defined cases: NULL and empty texts have no words, no label and score 0; a text
without an entry word is not looked at further; overlapping places all count;
rows that repeat are scanned each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality.llm import textkit as tk

FOUND_SHARE = 0.75

# fixed values: (label, base phrase?, template, mandatory phrase)
TEMPLATES = (
    ("mit", True, "mit license", "mit license"),
    ("apache", True, "apache license", "apache license"),
    ("gpl", True, "general public license", "general public license"),
    ("lgpl", False, "lesser general public license", "lesser general public license"),
    ("agpl", False, "affero general public license", "affero general public license"),
    ("mpl", False, "mozilla public license", "mozilla public license"),
    ("epl", False, "eclipse public license", "eclipse public license"),
    ("isc", False, "isc license", "isc license"),
    ("zlib", False, "zlib license", "zlib license"),
    ("bsl", False, "boost software license", "boost software license"),
    ("cc-by", False, "creative commons attribution", "creative commons attribution"),
    ("cc-by-nc", False, "cc by nc", "cc by nc"),
    ("cc-by-sa", False, "cc by sa", "cc by sa"),
    ("mit", False, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache", False, "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "may not use this file except in compliance"),
    ("gpl", False, "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "under the terms of the gnu general public license"),
    ("bsd", False, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("unlicense", False, "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class Template:
    label: str
    base: bool
    words: np.ndarray  # vocabulary ids in order
    key: slice  # the mandatory phrase
    entry: int  # offset of the entry word


def _vocabulary() -> list[str]:
    return sorted({w for _, _, text, _ in TEMPLATES for w in text.split()})


def word_ids(words: np.ndarray, vocabulary: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The vocabulary id of each word hash, -1 for other words; ``vocabulary`` is sorted, ``order`` its ids."""
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, order[at], -1)


def _hashed() -> tuple[np.ndarray, np.ndarray]:
    hashes = np.array([tk.hash_word(w.encode()) for w in _vocabulary()], np.uint64)
    order = np.argsort(hashes)
    return hashes[order], order


def _piece_words(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = tk.text_bytes(piece.column(piece.schema.get_field_index("text")))
    starts, ends, rows = tk.spans(data, bounds, tk.ALNUM)
    return word_ids(tk.hash_spans(tk.LOWER[data], starts, ends), *_hashed()), rows


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, size = np.zeros(len(_vocabulary()), np.int64), len(_vocabulary())
    for piece in tk.pieces(batches):
        ids, rows = _piece_words(piece)
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[ids >= 0]
        total += np.bincount(np.unique(row * size + ids[ids >= 0]) % size, minlength=size)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["word", "documents"])


def build_index(docs: DataFrame) -> list[Template]:
    """The templates with their entry words, by document frequency over all documents."""
    counts = docs.select("text").mapInArrow(_document_frequency, "word long, documents long").groupBy("word").agg(F.sum("documents").alias("n")).collect()
    frequency = {r["word"]: r["n"] for r in counts}
    number = {w: i for i, w in enumerate(_vocabulary())}
    index = []
    for label, base, text, phrase in TEMPLATES:
        words, key = text.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        # the highest IDF is the smallest document frequency; ties go to the longer word, then to the earlier
        entry = min(range(start, start + len(key)), key=lambda i: (frequency.get(number[words[i]], 0), -len(words[i]), i))
        index.append(Template(label, base, np.array([number[w] for w in words]), slice(start, start + len(key)), entry))
    return index


def places(template: Template, ids: np.ndarray, rows: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word (an index over all rows), row and matched share of every place of the template; ``where``: places of its entry word."""
    row = np.searchsorted(rows, where, "right") - 1
    low, high = rows[row], rows[row + 1]
    first = where - template.entry
    in_place = np.zeros((len(where), len(template.words)), bool)
    for j, word in enumerate(template.words):
        at = first + j
        inside = (at >= low) & (at < high)
        in_place[inside, j] = ids[at[inside]] == word
    share = in_place.mean(1)
    found = in_place[:, template.key].all(1) & (share >= FOUND_SHARE)
    return first[found], row[found], share[found]


def _scan(index: list[Template]):
    entries = sorted({int(t.words[t.entry]) for t in index})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches):
            ids, rows = _piece_words(piece)
            n = piece.num_rows
            where = {w: np.flatnonzero(ids == w) for w in entries}
            n_base, first, last, score = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1), np.zeros(n)
            labels: list[set[str]] = [set() for _ in range(n)]
            base_labels: list[set[str]] = [set() for _ in range(n)]
            for t in index:
                start, row, share = places(t, ids, rows, where[int(t.words[t.entry])])
                np.maximum.at(score, row, share)
                for r in np.unique(row):
                    labels[r].add(t.label)
                if t.base:
                    n_base += np.bincount(row, minlength=n)
                    at = start - rows[row]
                    np.maximum.at(last, row, at)
                    np.minimum.at(first, row, at)
                    for r in np.unique(row):
                        base_labels[r].add(t.label)
            none = last < 0
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(piece.schema.get_field_index("doc_id")),
                    pa.array(np.diff(rows)),
                    pa.array(n_base),
                    pa.array(first, pa.int64(), mask=none),
                    pa.array(last, pa.int64(), mask=none),
                    pa.array([",".join(sorted(x)) for x in base_labels]),
                    pa.array([",".join(sorted(x)) for x in labels]),
                    pa.array(score),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def scan(docs: DataFrame) -> DataFrame:
    """Words, base places, labels and the best template's share for every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan(build_index(docs)),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
