"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are laid out as padded matrices of code points, and two blocks of them are
compared row against row: the length of the common prefix plus that of the common
suffix reaches the longer length minus one exactly if one edit parts the words.

Which blocks are compared: an edit leaves two of three parts of the shorter word as
they are, so words meet only where they share all but one part (prefix before it,
suffix after it) and their lengths are equal or one apart. A group above ``TILE``
words is cut into tiles, and each pair of tiles is a piece of work of its own, so no
group is compared in one task. Only near pairs leave a task, each of them once.

Words are counted in one pass over the texts, summed before the shuffle. The rest
works on the vocabulary (distinct words that occur often enough).

Defined cases: a NULL text has no words; a NULL id counts as an empty one; repeated
rows are rows of their own and count again; an empty table gives no rows; texts and
words may have any length (matrices are built for a bounded number of cells, one pair
at least); only the columns named are read, so others may have any names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txquality.llm import textkit as tk
from txquality.session import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_TIMES = 10
# a run whose checksum with its document's id is a multiple of this loses a letter
DAMAGED = 31
PARTS = 3
TILE = 2048
LOT_ROWS = 20_000
HELD_WORDS = 200_000
CELLS = 1 << 23


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
    held: Counter[str] = Counter()

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for piece in batches:
        for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1)):
            # bytes are lower-cased, as that changes A to Z alone
            lowered = (text.as_py() or "").encode().lower().decode()
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for word, n in Counter(run.findall(lowered)).items():
                h = zlib.crc32(word.encode(), seed)
                if h % DAMAGED == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < LEAST_LENGTH:
                        continue
                held[word] += n
            if len(held) >= HELD_WORDS:
                yield batch()
    if held:
        yield batch()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words of the documents (doc_id, text) that occur often enough, with their counts."""
    seen = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_counted, "word string, n long")
    return seen.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _bound(part: int) -> str:
    """Where a part of a word of class ``c`` starts, as SQL."""
    return f"cast(c * {part} div {PARTS} as int)"


def _blocks(words: DataFrame) -> DataFrame:
    """Each word once for each block: class (length of the shorter word), open part, and the key of the shared ones."""
    length = F.char_length("word")
    classes = words.withColumn("c", F.explode(F.array(length, length - 1))).where(F.col("c") >= LEAST_LENGTH)
    shared = [
        f"struct({i} as part, xxhash64(c, {i}, substring(word, 1, {_bound(i)}), right(word, c - {_bound(i + 1)})) as key)"
        for i in range(PARTS)
    ]
    return classes.select("word", "n", "c", F.inline(F.array(*map(F.expr, shared))))


def _tiles(blocks: DataFrame) -> DataFrame:
    """Rows of blocks with two words or more, for each pair of tiles that a row's tile belongs to."""
    sizes = blocks.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    tiled = blocks.join(sizes, "key").withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
    own = tiled.withColumn("tile", F.pmod(F.xxhash64("word", F.lit(TILE)), F.col("tiles")).cast("int"))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return paired.select("key", "part", "c", "word", "n", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))


def _padded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Words as rows of code points, aligned left or right; cells beside a word are 0."""
    cells = np.arange(width)
    offset = lengths[:, None] - width + cells if right else np.broadcast_to(cells, (len(starts), width))
    inside = (offset >= 0) & (offset < lengths[:, None])
    return np.where(inside, data[np.where(inside, starts[:, None] + offset, 0)], 0)


def common_ends(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common prefix and the common suffix of words i and j."""
    width = int(max(lengths[i].max(), lengths[j].max()))
    shorter = np.minimum(lengths[i], lengths[j])
    found = []
    for right in (False, True):
        differ = _padded(data, starts[i], lengths[i], width, right) != _padded(data, starts[j], lengths[j], width, right)
        differ = differ[:, ::-1] if right else differ
        found.append(np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), width), shorter))
    return found[0], found[1]


def _partners(group: np.ndarray, tile: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, in order of group and tile, the rows after it that it is compared with: start and number."""
    at = np.arange(len(group))
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    ends = np.repeat(np.append(edges[1:], len(group)), np.diff(np.append(edges, len(group))))
    # two tiles: rows of the first meet all of the second
    in_high = np.concatenate(([0], np.cumsum((tile == high) & (low != high))))
    first_high = ends - (in_high[ends] - in_high[at])
    start = np.where(low == high, at + 1, np.where(tile == low, first_high, ends))
    return start, ends - start


def _near_pairs(lot: pa.Table) -> pa.Table:
    out = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
    column = lambda name: lot.column(name).to_numpy()
    c, key, tile, low, high, part, n = (column(x) for x in ("c", "key", "tile", "low", "high", "part", "n"))
    order = np.lexsort((tile, high, low, key, c))
    c, key, tile, low, high, part, n = (x[order] for x in (c, key, tile, low, high, part, n))
    words = lot.column("word").combine_chunks().take(pa.array(order))
    texts = words.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    # all letters lie below U+0100, so a code point is a byte
    data = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
    changed = np.zeros(len(key), bool)
    changed[1:] = (key[1:] != key[:-1]) | (c[1:] != c[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    first, number = _partners(np.cumsum(changed), tile, low, high)

    found: list[tuple[np.ndarray, np.ndarray]] = []
    width = np.ceil(np.log2(lengths + 1)).astype(np.int64)
    for bits in np.unique(width):
        rows = np.flatnonzero((width == bits) & (number > 0))
        pairs = np.cumsum(number[rows])
        at = 0
        while at < len(rows):
            done = pairs[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(pairs, done + max(1, CELLS >> (int(bits) + 1)), "right")))
            some = rows[at:to]
            i, j = np.repeat(some, number[some]), tk.ragged(first[some], number[some])
            # lengths c and c, or c and c + 1: two of c + 1 meet in the class above
            fits = (lengths[i] == c[i]) | (lengths[j] == c[i])
            i, j = i[fits], j[fits]
            if len(i):
                found.append(_one_edit(data, starts, lengths, c, part, i, j))
            at = to
    if not found:
        return out.empty_table()
    i, j = (np.concatenate(x) for x in zip(*found))
    both, other = np.concatenate((i, j)), np.concatenate((j, i))
    return pa.Table.from_arrays([words.take(pa.array(both)), words.take(pa.array(other)), pa.array(n[other])], schema=out)


def _one_edit(data, starts, lengths, c, part, i, j) -> tuple[np.ndarray, np.ndarray]:
    prefix, suffix = common_ends(data, starts, lengths, i, j)
    longer = np.maximum(lengths[i], lengths[j])
    c, part = c[i].astype(np.int64), part[i]
    near = (prefix + suffix >= longer - 1) & ((prefix < lengths[i]) | (lengths[i] != lengths[j]))
    # the pair counts in the first open part that holds the edit
    first = np.full(len(i), PARTS)
    for k in reversed(range(PARTS)):
        first = np.where((prefix >= c * k // PARTS) & (suffix >= c - c * (k + 1) // PARTS), k, first)
    near &= first == part
    return i[near], j[near]


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of words (word, n) one edit apart, in both directions: word, near, near_n.

    ``words`` must be a stored table.
    """
    tiles = stored(_tiles(_blocks(words)), "variant-tiles")
    lots = max(1, -(-tiles.count() // LOT_ROWS))
    dealt = tiles.withColumn("lot", F.pmod(F.xxhash64("key", "low", "high"), F.lit(lots)))
    return dealt.groupBy("lot").applyInArrow(_near_pairs, "word string, near string, near_n long")


def variants(docs: DataFrame) -> DataFrame:
    """Every word with its count, near words, form and root."""
    words = stored(vocabulary(docs), "variant-words")
    # the smallest of equally frequent ones, by bytes and so by code points
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.less") >= FORM_TIMES * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    found = stored(found, "variant-forms")
    roots = _roots(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(links: DataFrame) -> DataFrame:
    """The end of each word's chain. Every turn doubles the steps; counts rise tenfold a step, so few turns do."""
    links = stored(links, "variant-roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        links = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return links
