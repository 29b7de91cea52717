"""Benchmark decontamination through templates of questions.

Numbers, names and units become typed placeholders, so a question whose values
were changed has the same template. Every window of template words of the
benchmark is hash-joined with the documents' windows, and so is every window of
plain words that holds a slot (without slots the two are one). Matches on one
diagonal (document position minus item position) are merged into runs, those by
template, those by plain words, and all together; a run counts if its slots are
consistent: each value of the item stands for one value in the document
throughout, and the other way round. A run of plain words is a verbatim copy and
always consistent, whatever stands beside it.

A document is contaminated when a consistent run covers RUN_WORDS words of an
item, or all of it where the item is shorter.

Words are runs of letters and digits, lower-cased (A-Z and letters of two bytes in
UTF-8, up to U+07FF); a number may have dots and commas inside. A name is a capitalised word, not all capitals, that follows
another word of its sentence. A unit is a listed unit that follows a number.
Template windows with fewer than LITERAL_WORDS words outside slots say nothing and
are not used; plain words match however few of them stand outside slots. Items with fewer than LEAST_WORDS words are not looked for.

Documents go by id and text, not by id alone: rows of one id with different texts, or
without an id, have verdicts of their own, and runs are never put together from two.
Items go by their text until the end, so items that repeat cost nothing in between.

Defined cases: NULL and empty texts are clean; items that repeat match alike; rows
that repeat id and text share their verdict; an empty benchmark leaves every document
clean; texts of any length are read whole, in pieces of bounded size where several fit
into one; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txquality.llm import textkit as tk
from txquality.llm.names import fresh
from txquality.session import stored

WINDOW_WORDS = 8
LITERAL_WORDS = 4
LEAST_WORDS = 5
RUN_WORDS = 13
# up to so many benchmark windows are sent to every task to sift the documents' windows before the join
SIFT_WINDOWS = 2_000_000
SIFT_BITS = 22
# fixed values: units that make a slot after a number
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months "
    "year years percent dollar dollars euro euros cent cents usd eur degree degrees celsius fahrenheit meter meters metre metres "
    "watt watts volt volts joule joules newton newtons mph kmh hz khz mhz ghz kb mb gb tb"
).split()
NUMBER, NAME, UNIT = 1, 2, 3
# which matches make up a run: by template, by plain words, all
BY_TEMPLATE, VERBATIM, BY_EITHER = 0, 1, 2
_PLACEHOLDER = np.array([0, 0x6E756D626572, 0x6E616D65, 0x756E6974], np.uint64)
_UNIT_HASHES = np.sort(np.array([tk.hash_word(u.encode()) for u in UNITS], np.uint64))
_JOINT = np.zeros(256, bool)
_JOINT[[ord("."), ord(",")]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True
_SMALL = np.zeros(256, bool)
_SMALL[ord("a") : ord("z") + 1] = True
_SMALL[128:] = True
# characters of two bytes without case, where that leaves them two bytes
_FOLDED = np.array([ord(f) if len(f := chr(c).casefold()) == 1 and 0x80 <= ord(f) < 0x800 else c for c in range(0x800)], np.uint16)


def template(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the rows: hash, slot type (0: literal), template hash, and the rows' word bounds."""
    member = tk.ALNUM[data]
    if len(data) > 2:
        digit = tk.DIGIT[data]
        member[1:-1] |= _JOINT[data[1:-1]] & digit[:-2] & digit[2:]
    flags = member.astype(np.uint8)
    starts, ends, rows = tk.spans(flags, bounds, np.arange(256) == 1)
    lowered = tk.LOWER[data]
    small = _SMALL[data]
    if len(data) > 1:
        wide = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xDF))
        code = (data[wide].astype(np.uint16) & 0x1F) << 6 | data[wide + 1] & 0x3F
        held = _FOLDED[code] != code
        wide, code = wide[held], _FOLDED[code[held]]
        lowered[wide], lowered[wide + 1] = 0xC0 | code >> 6, 0x80 | code & 0x3F
        small[wide] = False
    words = tk.hash_spans(lowered, starts, ends)
    kind = np.zeros(len(words), np.uint8)
    if len(words):
        numeric = np.concatenate(([0], np.cumsum(tk.DIGIT[data] | (_JOINT[data] & member))))
        kind[numeric[ends] - numeric[starts] == ends - starts] = NUMBER
        first = np.zeros(len(words), bool)
        first[rows[:-1][np.diff(rows) > 0]] = True
        stops = np.concatenate(([0], np.cumsum(_STOP[data])))
        opens = first.copy()
        opens[1:] |= stops[starts[1:]] > stops[ends[:-1]]
        wide_upper = (data[starts] == 0xC3) & (data[np.minimum(starts + 1, len(data) - 1)] < 0x9F)
        second = np.where(wide_upper, starts + 2, starts + 1)
        capital = (tk.UPPER[data[starts]] | wide_upper) & (second < ends) & small[np.minimum(second, len(data) - 1)]
        kind[capital & ~opens] = NAME
        after_number = np.zeros(len(words), bool)
        after_number[1:] = (kind[:-1] == NUMBER) & ~first[1:]
        at = np.minimum(np.searchsorted(_UNIT_HASHES, words), len(_UNIT_HASHES) - 1)
        kind[after_number & (_UNIT_HASHES[at] == words)] = UNIT
    return words, kind, np.where(kind > 0, _PLACEHOLDER[kind], words), rows


def windows(words: np.ndarray, kind: np.ndarray, form: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of plain words, and those of template words that hold a slot and enough literals: hash, row, first word (an index over all rows), and whether by template."""
    literals = np.concatenate(([0], np.cumsum(kind == 0)))
    hashes, row, at = tk.ngrams_by_row(words, rows, width)
    templates = tk.ngrams_by_row(form, rows, width)[0]
    held = literals[at + width] - literals[at]
    plain = np.arange(len(hashes))
    typed = np.flatnonzero((held >= min(LITERAL_WORDS, width)) & (held < width))
    both = np.concatenate((plain, typed))
    return np.concatenate((hashes[plain], templates[typed])), row[both], at[both], np.arange(len(both)) >= len(plain)


def _window_table(ids: pa.Array, row: np.ndarray, at: np.ndarray, hashes: np.ndarray, typed: np.ndarray, words: np.ndarray, kind: np.ndarray, rows: np.ndarray, width: int, names: list[str], lengths: bool) -> pa.RecordBatch:
    """One row for each window; its slot values in order, each of a hash that tells types apart."""
    value = tk.signed(tk.mix(words + kind.astype(np.uint64)))
    slots, counts = np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    if len(at):
        spread = at[:, None] + np.arange(width)[None, :]
        marked = kind[spread] > 0
        slots, counts = value[spread[marked]], marked.sum(1)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(slots))
    columns = [ids.take(pa.array(row)), pa.array(at - rows[row]), pa.array(tk.signed(hashes)), pa.array(typed), lists]
    if lengths:
        columns += [pa.array(np.diff(rows)[row]), pa.array(np.full(len(row), width))]
    return pa.RecordBatch.from_arrays(columns, names)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["item_id", "item_pos", "hash", "typed", "item_slots", "item_words", "width"]
    for piece in tk.pieces(batches):
        ids, texts = piece.column(0), piece.column(1)
        words, kind, form, rows = template(*tk.text_bytes(texts))
        size = np.diff(rows)
        for width in range(LEAST_WORDS, WINDOW_WORDS + 1):
            wanted = size >= width if width == WINDOW_WORDS else size == width
            hashes, row, at, typed = windows(words, kind, form, rows, width)
            keep = wanted[row] if len(row) else np.zeros(0, bool)
            yield _window_table(ids, row[keep], at[keep], hashes[keep], typed[keep], words, kind, rows, width, names, True)


def _doc_windows(sift: object | None, widths: list[int]):
    names = ["doc", "doc_pos", "hash", "typed", "doc_slots"]
    mask = np.uint64((1 << SIFT_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sift.value if sift is not None else None
        coarse = None
        if wanted is not None:
            coarse = np.zeros(1 << SIFT_BITS, bool)
            coarse[(wanted & mask).astype(np.int64)] = True
        for piece in tk.pieces(batches):
            ids, texts = piece.column(0), piece.column(1)
            words, kind, form, rows = template(*tk.text_bytes(texts))
            for width in widths:
                hashes, row, at, typed = windows(words, kind, form, rows, width)
                if coarse is not None:
                    keep = np.flatnonzero(coarse[(hashes & mask).astype(np.int64)])
                    place = np.minimum(np.searchsorted(wanted, hashes[keep]), len(wanted) - 1)
                    keep = keep[wanted[place] == hashes[keep]]
                    hashes, row, at, typed = hashes[keep], row[keep], at[keep], typed[keep]
                yield _window_table(ids, row, at, hashes, typed, words, kind, rows, width, names, False)

    return run


def _field(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


_TEXT_KEY = "__text_key"


def _item_ids(benchmark: DataFrame) -> DataFrame:
    """The ids of each benchmark text."""
    return benchmark.groupBy(F.xxhash64("text").alias("item")).agg(F.collect_set("item_id").alias("item_ids"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, words, same_values): consistent runs of each item in each document (id and text), the longest run."""
    found = _matched(docs, benchmark).join(_item_ids(benchmark), "item")
    return found.select("doc_id", F.explode("item_ids").alias("item_id"), "words", "same_values")


def _matched(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text key, item, words, same_values), where an item is the key of a benchmark text."""
    spark = docs.sparkSession
    texts = benchmark.select(F.xxhash64("text").alias("item"), "text").dropDuplicates(["item"])
    items = stored(
        texts.mapInArrow(_item_windows, "item_id long, item_pos long, hash long, typed boolean, item_slots array<long>, item_words long, width long"),
        "benchmark-windows",
    )
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    sift = None
    if items.select("hash").distinct().count() <= SIFT_WINDOWS:
        found = items.select("hash").distinct().toPandas()["hash"].to_numpy(np.int64)
        sift = spark.sparkContext.broadcast(np.sort(tk.unsigned(found)))
    # a benchmark without windows matches nothing, and needs no look at the documents
    source = docs.select(F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key")), "text")
    doc = f"struct<doc_id:{_field(docs, 'doc_id')},text_key:bigint>"
    places = (source if widths else source.limit(0)).mapInArrow(_doc_windows(sift if widths else None, widths), f"doc {doc}, doc_pos long, hash long, typed boolean, doc_slots array<long>")
    diagonal = ["doc", "item_id", "diagonal", "width"]
    # plain words that are equal keep their values, whatever the document's own case makes of them
    kept = F.transform("item_slots", lambda s: F.struct(s.alias("item_slots"), s.alias("doc_slots")))
    bare = (F.size("item_slots") == 0) & (F.size("doc_slots") == 0)
    kinds = F.when(F.col("typed"), F.array(F.lit(BY_TEMPLATE), F.lit(BY_EITHER))).when(bare, F.array(F.lit(BY_TEMPLATE), F.lit(VERBATIM), F.lit(BY_EITHER))).otherwise(F.array(F.lit(VERBATIM), F.lit(BY_EITHER)))
    hits = (
        places.join(items, ["hash", "typed"])
        .where(~F.col("typed") | (F.size("item_slots") == F.size("doc_slots")))
        .select("doc", "item_id", (F.col("doc_pos") - F.col("item_pos")).alias("diagonal"), "width", "item_pos", "item_words", F.when(F.col("typed"), F.arrays_zip("item_slots", "doc_slots")).otherwise(kept).alias("slots"), kinds.alias("kinds"))
        .distinct()
        .withColumn("kind", F.explode("kinds"))
        .drop("kinds")
    )
    along = Window.partitionBy(*diagonal, "kind").orderBy("item_pos")
    step = F.col("item_pos") - F.lag("item_pos").over(along)
    runs = hits.withColumn("step", step).withColumn("run", F.sum(F.when(F.col("step").isNull() | (F.col("step") > F.col("width")), 1).otherwise(0)).over(along))
    pairs = F.array_distinct(F.flatten(F.collect_set("slots")))
    merged = runs.groupBy(*diagonal, "kind", "run").agg(
        F.sum(F.when((F.col("step").isNull()) | (F.col("step") > F.col("width")), F.col("width")).otherwise(F.col("step"))).alias("words"),
        F.max("item_words").alias("item_words"),
        pairs.alias("pairs"),
    )
    one_to_one = F.col("pairs").isNull() | (
        (F.size(F.array_distinct(F.col("pairs.item_slots"))) == F.size("pairs")) & (F.size(F.array_distinct(F.col("pairs.doc_slots"))) == F.size("pairs"))
    )
    same = F.coalesce(F.forall("pairs", lambda p: p["item_slots"] == p["doc_slots"]), F.lit(True))
    # a verbatim stretch of a longer run that counts has that run's values
    longer = F.max(F.when(F.col("kind") != VERBATIM, same))
    return (
        merged.where((F.col("words") >= F.least(F.lit(RUN_WORDS), F.col("item_words"))) & one_to_one)
        .groupBy(*diagonal)
        .agg(F.max("words").alias("words"), F.coalesce(longer, F.lit(True)).alias("same_values"))
        .groupBy("doc", F.col("item_id").alias("item"))
        .agg(F.max("words").alias("words"), F.max("same_values").alias("same_values"))
        .select("doc.doc_id", F.col("doc.text_key").alias(_TEXT_KEY), "item", "words", "same_values")
    )


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: whether it is contaminated, by which items, the longest run, and whether values differ from the item's in all of them."""
    by_item = _matched(docs, benchmark).join(_item_ids(benchmark), "item")
    found = by_item.groupBy(F.col("doc_id").alias("__id"), F.col(_TEXT_KEY).alias("__key")).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("items"), F.max("words").alias("run_words"), F.max("same_values").alias("same_values")
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias(_TEXT_KEY))
    same = (F.col(_TEXT_KEY) == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return rows.join(found, same, "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(f"array<{_field(benchmark, 'item_id')}>")).alias("items"),
        F.coalesce("run_words", F.lit(0).cast("long")).alias("run_words"),
        F.coalesce(~F.col("same_values"), F.lit(False)).alias("values_changed"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a benchmark item."""
    key, found_id, found_key = fresh(docs.columns, _TEXT_KEY, "__id", "__key")
    found = _matched(docs, benchmark).select(F.col("doc_id").alias(found_id), F.col(_TEXT_KEY).alias(found_key)).distinct()
    same = (F.col(key) == F.col(found_key)) & F.col("doc_id").eqNullSafe(F.col(found_id))
    return docs.withColumn(key, F.xxhash64("text")).join(found, same, "left_anti").drop(key)
