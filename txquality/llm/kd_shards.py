"""K-d tree shards: recursive cuts at distributed weighted medians of the widest dimension.

Native: DataFrame functions only. All nodes of a level are cut together. A cut
is found by refining histograms of the bytes along the node's widest dimension,
ties ordered by the text's checksum, then by a hash of the document id and the
place of the stored row, so equal texts lie side by side and are parted only
where a shard would otherwise be off its share, even if one row repeats without end. A histogram has a fixed number of bins for each node,
whatever the number of rows, and is summed before the shuffle. The driver holds
the tree's cuts and one level's histograms.

Defined cases: a NULL text has size 1 and checksum 0; an empty table gives no
rows; NULL dimensions count as 0; rows that repeat id and text lie side by side,
are parted like equal texts, and get slots of their own; texts of any length are
measured whole by Spark; other columns are not needed and may clash with
nothing, as only named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txquality.session import stored

BIN_BITS = 12
DIM_BITS = 20
TIE_BITS = 32
# a hash of the id, and below it one of the place of the row
ID_BITS = 48
PLACE_BITS = 20
# how far a shard may be off its share of the bytes, as a part of that share
TOLERANCE = 0.002
SLOT_ROWS = 50_000


@dataclass
class Node:
    """A node to cut: its number, leaves below it, bytes, and the search so far."""

    number: int
    leaves: int
    first_leaf: int
    dim: int = 0
    target: float = 0.0
    slack: float = 0.0
    left: int = 0
    low: int = 0
    bits: int = DIM_BITS + TIE_BITS
    tie: int | None = None
    cut: tuple[int, int] | None = None


def text_dimensions() -> dict[str, Column]:
    """Metadata of a text: its size, words a byte, lines a byte and share of characters beyond ASCII."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text) + 1
    blanks = F.length(text) - F.length(F.translate(text, " ", ""))
    breaks = F.length(text) - F.length(F.translate(text, "\n", ""))
    return {"d_size": F.log2(size), "d_words": blanks / size, "d_lines": breaks / size, "d_wide": (F.octet_length(text) - F.length(text)) / size}


def _scaled(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Dimensions as integers of DIM_BITS bits, each over its own range."""
    ends = rows.agg(*[f(F.coalesce(d, F.lit(0.0))).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]).first()
    top = (1 << DIM_BITS) - 1

    def scale(d: str) -> Column:
        low, high = ends[f"lo_{d}"] or 0.0, ends[f"hi_{d}"] or 0.0
        if high <= low:
            return F.lit(0).cast("long")
        return F.floor((F.coalesce(d, F.lit(0.0)) - low) / (high - low) * top).cast("long")

    return rows.withColumns({d: scale(d) for d in dims})


def _local(like: DataFrame, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A table of a few rows that the planner knows to be small."""
    literal = lambda v, kind: f"cast({'null' if v is None else v} as {kind})"
    values = ", ".join(f"({', '.join(map(literal, row, columns.values()))})" for row in rows)
    return like.sparkSession.sql(f"select * from values {values} as t({', '.join(columns)})")


def _with_node(rows: DataFrame, cuts: list[tuple], dims: list[str]) -> DataFrame:
    """One level down: each row goes left or right of its node's cut."""
    if not cuts:
        return rows
    table = _local(rows, {"node": "long", "dim": "int", "c1": "long", "c2": "long", "to_left": "long", "to_right": "long"}, cuts)
    k1 = _key(dims)
    left = (k1 < F.col("c1")) | ((k1 == F.col("c1")) & (F.col("tie_id") < F.col("c2")))
    moved = rows.join(table, "node", "left").withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).when(left, F.col("to_left")).otherwise(F.col("to_right")))
    return moved.drop("dim", "c1", "c2", "to_left", "to_right")


def _key(dims: list[str]) -> Column:
    return F.element_at(F.array(*dims), F.col("dim") + 1) * (1 << TIE_BITS) + F.col("tie")


def _refine(rows: DataFrame, nodes: list[Node], dims: list[str]) -> None:
    """Narrow the search of every open node by one histogram, until each has its cut."""
    while open_nodes := [n for n in nodes if n.cut is None]:
        table = [(n.number, n.dim, n.low, max(0, n.bits - BIN_BITS), n.tie) for n in open_nodes]
        search = _local(rows, {"node": "long", "dim": "int", "low": "long", "shift": "int", "at_tie": "long"}, table)
        key = F.when(F.col("at_tie").isNull(), _key(dims)).when(F.col("at_tie") == _key(dims), F.col("tie_id"))
        place = F.floor((key - F.col("low")) / F.pow(F.lit(2.0), F.col("shift"))).cast("long")
        bins = rows.join(search, "node").withColumn("bin", place).where(F.col("bin").between(0, (1 << BIN_BITS) - 1))
        heights: dict[int, list[tuple[int, int]]] = {}
        for r in bins.groupBy("node", "bin").agg(F.sum("size").alias("bytes")).collect():
            heights.setdefault(r["node"], []).append((r["bin"], r["bytes"]))
        for n in open_nodes:
            _step(n, sorted(heights.get(n.number, [])))


def _step(node: Node, bins: list[tuple[int, int]]) -> None:
    shift = max(0, node.bits - BIN_BITS)
    at = lambda place: node.low + (place << shift)

    def cut_at(value: int) -> None:
        node.cut = (value, 0) if node.tie is None else (node.tie, value)

    below = node.left
    for place, height in bins:
        if below + height <= node.target:
            below += height
            continue
        short, over = node.target - below, below + height - node.target
        if min(short, over) <= node.slack or (shift == 0 and node.tie is not None):
            cut_at(at(place) if short <= over else at(place + 1))
        elif shift == 0:
            node.left, node.tie, node.low, node.bits = below, at(place), 0, ID_BITS
        else:
            node.left, node.low, node.bits = below, at(place), shift
        return
    cut_at(node.low + (1 << node.bits))


def kd_shards(rows: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` (doc_id, size, tie, dimensions) with ``shard`` and ``slot``.

    Give the number of shards, or the bytes that a leaf should hold. Shards
    are numbered along the tree; slots run from 0 without gaps in each.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    kept = stored(rows, "kd-rows")
    # rows that repeat id and text differ by where they are stored, so that a cut can part them
    place = F.pmod(F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")), F.lit(1 << PLACE_BITS))
    by_id = F.pmod(F.xxhash64("doc_id"), F.lit(1 << (ID_BITS - PLACE_BITS)))
    kept = kept.select("*", (by_id * (1 << PLACE_BITS) + place).alias("tie_id"))
    work = _scaled(kept, dims).withColumn("node", F.lit(1).cast("long"))
    total = kept.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, math.ceil(total / target_bytes))
    share = total / shards
    level = [Node(1, shards, 0)]
    leaf_of: list[tuple[int, int]] = [(1, 0)] if shards == 1 else []
    depth = 0
    while total and any(n.leaves > 1 for n in level):
        cutting = [n for n in level if n.leaves > 1]
        seen = {
            r["node"]: r
            for r in work.groupBy("node").agg(F.sum("size").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in dims]).collect()
        }
        for n in cutting:
            stats = seen.get(n.number)
            n.dim = max(range(len(dims)), key=lambda i: stats[dims[i]]) if stats else 0
            n.target = (stats["bytes"] if stats else 0) * (n.leaves // 2) / n.leaves
            n.slack = share * tolerance
        _refine(work, cutting, dims)
        cuts, level = [], []
        for n in cutting:
            below = n.leaves // 2
            left, right = Node(2 * n.number, below, n.first_leaf), Node(2 * n.number + 1, n.leaves - below, n.first_leaf + below)
            cuts.append((n.number, n.dim, *n.cut, left.number, right.number))
            level += [left, right]
        leaf_of += [(n.number, n.first_leaf) for n in level if n.leaves == 1]
        work = _with_node(work, cuts, dims)
        depth += 1
        if depth % 4 == 0 and any(n.leaves > 1 for n in level):
            work = stored(work, "kd-level")
    leaves = _local(rows, {"node": "long", "shard": "int"}, leaf_of or [(1, 0)])
    return with_slots(work.join(leaves, "node").select("doc_id", "size", "tie", "shard"))


def with_slots(placed: DataFrame) -> DataFrame:
    """Gapless slots in each shard: rows are numbered within small parts, whose counts are then added up."""
    placed = stored(placed, "kd-placed")
    # a part is a stretch of a stored file, so it is small whatever its rows are
    part = F.concat_ws("/", "_metadata.file_name", F.floor(F.col("_metadata.row_index") / SLOT_ROWS).cast("string"))
    cut = placed.select("*", part.alias("part"), F.col("_metadata.row_index").alias("row_at"))
    counts = cut.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("tie", "doc_id", "row_at"))
    return cut.withColumn("number", number).join(before, ["shard", "part"]).withColumn("slot", F.col("before") + F.col("number") - 1).drop("part", "number", "before", "row_at")
