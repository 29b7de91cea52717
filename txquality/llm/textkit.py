"""Vectorised text helpers for Arrow batches: word spans, 64-bit hashes, packed integer columns.

They run inside tasks on one bounded piece of a batch at a time. Spark
partitions the documents and shuffles what the pieces yield. A NULL text
counts as an empty one everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20
_BLOCK = 1 << 18
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_STEP_INVERSE = _U(pow(int(_STEP), -1, 1 << 64))
_JOIN = _U(0xC2B2AE3D27D4EB4F)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~ASCII_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
# letters, digits and every byte of a character beyond ASCII
ALNUM = DIGIT | UPPER
ALNUM[ord("a") : ord("z") + 1] = True
ALNUM[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the offsets of the rows in it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, bounds = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def spans(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``member`` bytes within each row, and the runs' row bounds.

    The third array has one entry more than rows: runs ``[b[i], b[i + 1])`` lie in row i.
    """
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    inside = member[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _powers(n: int, step: np.uint64) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(_BLOCK + 1, _STEP), _powers(_BLOCK + 1, _STEP_INVERSE)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: equal bytes, equal hash, in any batch and process."""
    return hash_prefixes(data, starts, ends, ())[0]


def hash_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of each span, then of its first bytes for each length (the whole span where it is no longer).

    ``data`` holds bytes, or code points as wider integers.

    Spans are in order and do not overlap. Works block by block, so memory stays
    near the block size but for a span that is longer than a block.
    """
    out = [np.empty(len(starts), np.uint64) for _ in range(1 + len(lengths))]
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
        width = int(ends[to - 1]) - base
        if width <= _BLOCK:
            powers, inverses = _POWERS, _INVERSES
        else:
            powers, inverses = _powers(width + 1, _STEP), _powers(width + 1, _STEP_INVERSE)
        sums = np.zeros(width + 1, np.uint64)
        part = data[base : base + width]
        np.cumsum((_BYTE_VALUES[part] if part.dtype == np.uint8 else mix(part.astype(np.uint64) + _JOIN)) * powers[:width], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        for to_end, hashes in zip((e, *(np.minimum(s + k, e) for k in lengths)), out):
            hashes[at:to] = (sums[to_end] - sums[s]) * inverses[s]
        at = to
    return [mix(hashes) for hashes in out]


def hash_word(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(hash_spans(data, np.array([0]), np.array([len(data)]))[0])


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n hashes; the caller drops those that cross rows."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    last = len(words) - n + 1
    out = words[:last].copy()
    for k in range(1, n):
        out = out * _JOIN + words[k : k + last]
    return mix(out)


def ngrams_by_row(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram hashes that lie within rows, their row, and the index of their first word."""
    grams = ngram_hashes(words, n)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    first = np.arange(len(grams))
    whole = row[: len(grams)] == row[n - 1 :] if len(grams) else np.zeros(0, bool)
    return grams[whole], row[: len(grams)][whole], first[whole]


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes, in the smallest unsigned width that holds them."""
    values = np.ascontiguousarray(values)
    top = int(values.max()) if len(values) else 0
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        if top <= np.iinfo(kind).max:
            break
    values = values.astype(kind)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()
    head = np.array([values.dtype.itemsize, len(values)], np.int64).tobytes()
    return head + pa.compress(planes, "zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    width, n = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    planes = np.frombuffer(pa.decompress(memoryview(blob)[16:], width * n, "zstd"), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(np.dtype(f"u{width}")).reshape(n)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, packed as their differences."""
    values = values.astype(np.uint64)
    return pack(np.concatenate((values[:1], values[1:] - values[:-1])))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob).astype(np.uint64), dtype=np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    """Hashes as Spark's signed longs, bit for bit."""
    return values.view(np.int64)


def unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.int64).view(np.uint64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of runs, run after run."""
    total = int(lengths.sum())
    jump = np.ones(total, np.int64)
    held = lengths > 0
    starts, lengths = starts[held], lengths[held]
    if not total:
        return jump
    at = np.cumsum(lengths)[:-1]
    jump[0] = starts[0]
    jump[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(jump)
