"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Native: DataFrame functions only. Every document draws an exponential key, scaled
by its quality weight; within a source documents stand in the order of their keys.
A source's target is met by complete epochs of all its documents, then by the
documents with the smallest keys, prefix-summed to what is left of the budget. The
document in which the budget ends gives its first words only.

No source is sorted as a whole. Words are summed by source and a fixed number of key
ranges (before the shuffle, so a source with a third of all rows costs no more than
another), the range in which the budget ends is searched again in finer ranges, and
only its few rows are put in order. All other documents follow from their key's range.
Rows whose keys are equal to the last bit (repeated documents) are summed by parts of
the stored table, then within a part, so they need not meet in one task either.

Defined cases: a NULL text has no words and takes none; an empty table gives no rows;
NULL is a source of its own, the last one; a NULL or repeated id is allowed, as keys
come from id and text; equal rows draw equal keys, and which of them comes first
changes nothing but the order of equal rows; a document without a quality weighs 1; a
source without words has the target 0. Texts of any length are counted whole by Spark.
Only the columns named are read, so others may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txquality.session import stored

WORD = r"[^\x20\x09-\x0D]+"
# the share of all words that the mix takes, and the most that a source may be repeated
SHARE = 1.5
MOST = 2
WEIGHTS = (3, 1, 2)
DRAW_BITS, ORDER_BITS, STEP_BITS = 52, 48, 12
# rows of one source that are put in order in one task
ORDERED_ROWS = 10_000
# sources or labelled documents that are broadcast, by count
BROADCAST_ROWS = 100_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(quality: Column) -> Column:
    """2 for quality 1, a half for quality 0, 1 where it is not known."""
    return F.coalesce(F.pow(F.lit(4.0), quality - 0.5), F.lit(1.0))


def exponential(doc_id: str = "doc_id", text: str = "text") -> Column:
    """``-ln(u)``, where u in (0, 1) comes from id and text: the same in every run."""
    known = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    digits = F.substring(F.md5(known.cast("binary")), 1, DRAW_BITS // 4)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << DRAW_BITS)
    return -F.log(u)


def drawn(docs: DataFrame) -> DataFrame:
    """What the mix needs of each document: id, source, size in words, draw, and its quality if it has that column.

    Texts go no further, so whatever is joined or shuffled later is narrow.
    """
    quality = ["quality"] if "quality" in docs.columns else []
    return docs.select("doc_id", "source", word_count().alias("size"), exponential().alias("draw"), *quality)


def with_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``quality``: the mean label of the document's id, NULL if it has none."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    known = known.where(F.col("quality").isNotNull())
    return docs.join(F.broadcast(known) if _is_small(known) else known, "doc_id", "left")


def _is_small(table: DataFrame) -> bool:
    return table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The target of each source (``source``, ``source_size``), and its number in code-point order.

    Weights go round by that order. What is above ``most`` times a source's size is
    shared among the others by weight, until none is above.
    """
    ordered = stored(sizes.orderBy(F.col("source").asc_nulls_last()), "mix-sources")
    # the sorted files tell each row's number without a sort in one task
    placed = ordered.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("file").agg(F.count("*").alias("n")).select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    number = F.col("first") + F.col("at")
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int")).cast("double")
    table = placed.join(starts, "file").select(
        "source", "source_size", number.alias("source_no"), weight.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("cap")
    )
    table = stored(table, "mix-weights")
    rate = _rate(table, share)
    return table.withColumn("target", F.least(F.lit(rate) * F.col("w"), F.col("cap"))).drop("w", "cap")


def _rate(table: DataFrame, share: float) -> float:
    """Words per unit of weight once the capped sources are full; a few sums come to the driver each turn."""
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    rate, full = 0.0, -1
    while True:
        above = F.lit(rate) * F.col("w") > F.col("cap")
        now = table.agg(F.count_if(above).alias("full"), F.sum(F.when(above, F.col("cap"))).alias("taken"), F.sum(F.when(~above, F.col("w"))).alias("w")).first()
        if now["full"] == full or not now["w"]:
            return rate
        rate, full = (budget - (now["taken"] or 0.0)) / now["w"], now["full"]


def _ends(rows: DataFrame, sources: DataFrame, few: bool) -> tuple[DataFrame, int]:
    """The key range in which each source's budget ends, words before it and rows in it; bits below a range."""
    shift = ORDER_BITS
    ends = sources.select("source_no", "rest", F.lit(0).cast("long").alias("range"), F.lit(0).cast("long").alias("before"))
    while True:
        inside = rows.join(F.broadcast(ends) if few else ends, "source_no").where(F.shiftright("place", shift) == F.col("range"))
        shift -= STEP_BITS
        sums = inside.groupBy("source_no", "rest", "before", F.shiftright("place", shift).alias("range")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        running = F.sum("words").over(Window.partitionBy("source_no").orderBy("range")) + F.col("before")
        reached = sums.withColumn("running", running).where((F.col("running") > F.col("rest")) & (F.col("running") - F.col("words") <= F.col("rest")))
        # a range of documents without words may share its end with the one before
        first = reached.groupBy("source_no", "rest").agg(F.min(F.struct("range", (F.col("running") - F.col("words")).alias("before"), "n")).alias("end"))
        ends = stored(first.select("source_no", "rest", "end.range", "end.before", "end.n"), "mix-ends")
        most = ends.agg(F.max("n")).first()[0] or 0
        if shift == 0 or most <= ORDERED_ROWS:
            return ends, shift


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, text, source, quality)."""
    return mix_drawn(drawn(docs), weights, share, most)


def mix_drawn(draws: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """What the mix takes of each row of ``draws`` (see ``drawn``), which have a quality.

    Returns doc_id, source, size, source_size, target, epochs (complete ones),
    ``part`` (words of the last, incomplete one) and ``taken`` in words.
    """
    key = F.col("draw") / quality_weight(F.col("quality"))
    place = F.least((-F.expm1(-key) * float(1 << ORDER_BITS)).cast("long"), F.lit((1 << ORDER_BITS) - 1))
    rows = stored(draws.select("doc_id", "source", "size", place.alias("place")), "mix-rows")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    want = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(0).cast("long")
    sources = targets.withColumn("epochs", epochs).withColumn("rest", (want - F.col("epochs") * F.col("source_size")).cast("long"))
    # one row for each source in all that is joined from here on
    few = _is_small(sources)
    beside_rows = lambda table: F.broadcast(table) if few else table

    position = rows.select("*", F.concat_ws("/", "_metadata.file_name", F.floor(F.col("_metadata.row_index") / ORDERED_ROWS).cast("string")).alias("lot"), F.col("_metadata.row_index").alias("row_at"))
    rows = position.join(beside_rows(sources.withColumnRenamed("source", "of_source")), F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    ends, shift = _ends(rows.select("source_no", "place", "size"), sources, few)
    placed = rows.join(beside_rows(ends.select("source_no", "range", "before", "n")), "source_no", "left")
    at = F.shiftright("place", shift)
    beside = F.col("range").isNull() | (at != F.col("range"))
    clear = placed.where(beside).withColumn("part", F.when(at < F.col("range"), F.col("size")).otherwise(0))

    edge = placed.where(~beside).withColumn("lot", F.when(F.col("n") <= ORDERED_ROWS, F.lit("")).otherwise(F.col("lot")))
    lots = edge.groupBy("source_no", "lot").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("source_no", "lot", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("lot_before"))
    inside = Window.partitionBy("source_no", "lot").orderBy("place", "doc_id", "size", "row_at").rowsBetween(Window.unboundedPreceding, -1)
    ordered = edge.withColumn("lot_words", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(lots, ["source_no", "lot"])
    left = F.col("rest") - F.col("before") - F.col("lot_before") - F.col("lot_words")
    cut = ordered.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))

    names = ["doc_id", "source", "size", "source_size", "target", "epochs", F.col("part").cast("long").alias("part")]
    mixed = clear.select(*names).unionByName(cut.select(*names))
    return mixed.withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))


def copies(mixed: DataFrame) -> DataFrame:
    """One row for each time a document enters the mix: its epoch from 0, and how many of its words."""
    whole = F.when(F.col("size") > 0, F.array_repeat("size", F.col("epochs").cast("int"))).otherwise(F.array().cast("array<bigint>"))
    entries = F.filter(F.concat(whole, F.array("part")), lambda words: words > 0)
    return mixed.select("doc_id", "source", F.posexplode(entries).alias("epoch", "words"))
