"""Exact self-join of documents by the Jaccard similarity of their word n-grams, in metric space.

Jaccard distance is a metric, so a document at distance d from a pivot links
(distance at most e) only with documents at distances d - e to d + e from it.

1. Documents with equal sets are one class; only classes are joined, and of these
   none whose set is so small that only an equal one could link (``least_linking``).
2. Regions. Most texts are at distance near 1 from every document but their
   near copies, so pivots that are drawn at random part nothing. Pivots are
   therefore found among documents that share rare n-grams: the n-grams of a
   document in hash order, a quarter of them or so, are counted over all documents; a
   document that links with another shares at least one n-gram among the rarest
   of those (the prefix principle, applied twice: see ``prefix_sizes``). All
   documents with that n-gram meet in the region of its pivot, the first of them. A
   document lies in as many regions as it needs, so no link is lost.
3. A region that is too large for one task is split by pivots: its documents
   go to the nearest pivot's cell, and, by the triangle inequality, to every
   cell whose pivot is at most 2e farther (a link cannot reach beyond). What
   links with the pivot itself is connected already, and stays only where the
   window of a document outside still reaches it. Cells are split again until
   they are small; a region that pivots do not part (its cells overlap too much)
   is joined whole, every two blocks of it in a task.
4. A small region is joined exactly in its task: pivot after pivot, comparing
   only documents that share one of the region's rare n-grams with it, lie within
   the windows of the first pivots, are of fitting size and not connected yet.
5. Links are connected by large-star and small-star rounds.

The result is exact: links are verified on whole sets of 64-bit hashes with
integers. Links between documents that are already connected may be left out.

Defined cases: a text with fewer words than the n-gram has its whole sequence as
the only element; NULL and empty texts have an empty set and link with nothing;
rows that repeat are members of one class; NULL ids are never chosen as a
component's id unless all of it are NULL; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txquality.llm import textkit as tk
from txquality.llm.names import fresh
from txquality.session import stored

PIECE_BYTES = 4 << 20
OWNER_BYTES = 16 << 20
LEAST_OWNERS = 32
# how many n-grams more than the shortest prefix are counted, as a part of the set
EXTRA = 0.15
# elements of all sets in a region that one task joins
REGION_ELEMENTS = 2_000_000
PIVOTS = 12
LEVELS = 6
# a region whose cells together hold more than so many times its documents is joined in blocks instead
SPREAD = 2.0
SALT_ELEMENTS = 500_000
# so many rows of two or three longs are broadcast, more are joined by shuffle
BROADCAST_ROWS = 200_000
STORED_PIVOTS = 8
_INDEX_BITS = 24
_OTHER = np.uint64(0xA24BAED4963EE407)


def shingles(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each row, ascending within it, and the rows' bounds."""
    starts, ends, rows = tk.spans(data, bounds, tk.NOT_SPACE)
    words = tk.hash_spans(tk.LOWER[data], starts, ends)
    grams, row, _ = tk.ngrams_by_row(words, rows, n)
    size = np.diff(rows)
    for k in range(1, n):  # shorter sequences as a whole, apart by their length
        short = np.flatnonzero(size == k)
        if len(short):
            whole = tk.ngram_hashes(words, k)[rows[short]]
            grams, row = np.concatenate((grams, tk.mix(whole + np.uint64(k)))), np.concatenate((row, short))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[fresh], row[fresh]
    return grams, np.searchsorted(row, np.arange(len(rows)))


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def set_keys(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share."""
    return _row_sums(tk.mix(grams + np.uint64(1)), bounds), _row_sums(tk.mix(grams ^ _OTHER), bounds)


def prefix_sizes(size: np.ndarray, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """How many n-grams in hash order are counted, and how many of the rarest of those are looked up.

    Sets x, y that link share at least ceil(t|x|) elements, and so, for any k up
    to that, at least k of the first |x| - ceil(t|x|) + k in any common order:
    all that lie before their k-th common element are too few to fill the
    rest. With k = ceil(EXTRA |x|) those are counted. As |y| >= t|x|, at least
    k(ceil(t|x|)) of them are common, so a prefix shorter by that less one,
    in order of rarity, still holds a common one.
    """
    num, den = least
    common = -(-size * num // den)
    extra = lambda s: np.maximum(1, np.ceil(EXTRA * s).astype(np.int64))
    counted = size - common + np.minimum(extra(size), np.maximum(common, 1))
    counted = np.minimum(counted, size)
    return counted, np.maximum(counted - extra(common) + 1, np.minimum(size, 1))


def least_linking(least: tuple[int, int]) -> int:
    """The size from which a set can link with another that is not equal: i of at least i + 1 elements in common."""
    num, den = least
    return -(-num // (den - num)) if num < den else np.iinfo(np.int64).max


def _read(n: int, least: tuple[int, int], owners: int):
    """Of each piece: its documents' sizes and set keys; and, for each owner, the n-grams to count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "chunk", "doc_id", "index", "size", "k1", "k2", "stands", "owner", "grams", "docs"]
        for number, piece in enumerate(tk.pieces(batches, most=PIECE_BYTES)):
            chunk = (TaskContext.get().partitionId() << 20) + number
            grams, bounds = shingles(*tk.text_bytes(piece.column(1)), n)
            size = np.diff(bounds)
            k1, k2 = set_keys(grams, bounds)
            rows = piece.num_rows
            none = lambda kind, many: pa.nulls(many, kind)
            # one of equal sets stands for the others of its piece
            first = np.zeros(rows, bool)
            first[np.unique(np.stack((k1, k2), 1), axis=0, return_index=True)[1]] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(rows, np.int32)), pa.array(np.full(rows, chunk)), piece.column(0), pa.array(np.arange(rows)), pa.array(size), pa.array(tk.signed(k1)), pa.array(tk.signed(k2)), pa.array(first), none(pa.int32(), rows), none(pa.binary(), rows), none(pa.binary(), rows)],
                names,
            )
            counted, _ = prefix_sizes(size, least)
            counted = np.where(first & (size >= least_linking(least)), counted, 0)
            at = tk.ragged(bounds[:-1], counted)
            keys, doc = grams[at], np.repeat(np.arange(rows), counted)
            order = np.argsort(keys, kind="stable")
            keys, doc = keys[order], doc[order]
            owner = (((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(owner, np.arange(owners + 1))
            own = np.flatnonzero(np.diff(cut))
            many = len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(many, np.int32)), pa.array(np.full(many, chunk)), none(piece.schema.field(0).type, many), none(pa.int64(), many), none(pa.int64(), many), none(pa.int64(), many), none(pa.int64(), many), none(pa.bool_(), many),
                    pa.array(own.astype(np.int32)), pa.array([tk.pack_sorted(keys[cut[i] : cut[i + 1]]) for i in own], pa.binary()), pa.array([tk.pack(doc[cut[i] : cut[i + 1]]) for i in own], pa.binary()),
                ],
                names,
            )

    return run


def _count(table: pa.Table) -> pa.Table:
    """For the n-grams of one owner: those that several sets hold, back to each piece with their counts."""
    chunks = table.column("chunk").to_numpy()
    keys = [tk.unpack_sorted(b) for b in table.column("grams").to_pylist()]
    sizes = np.array([len(k) for k in keys])
    docs = np.concatenate([tk.unpack(b).astype(np.int64) for b in table.column("docs").to_pylist()])
    keys = np.concatenate(keys)
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    many = times[which]
    at = np.concatenate(([0], np.cumsum(sizes)))
    out = {k: [] for k in ("chunk", "grams", "docs", "times")}
    for chunk, a, b in zip(chunks, at, at[1:]):
        held = np.flatnonzero(many[a:b] > 1) + a
        if len(held):
            for name, value in zip(out, (int(chunk), tk.pack_sorted(keys[held]), tk.pack(docs[held]), tk.pack(many[held]))):
                out[name].append(value)
    return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), **{k: pa.array(out[k], pa.binary()) for k in ("grams", "docs", "times")}})


def _look_up(least: tuple[int, int]):
    """The rarest shared n-grams of each class's document in a piece."""

    def run(answers: pa.Table, classes: pa.Table) -> pa.Table:
        index = classes.column("index").to_numpy()
        if not len(index) or not answers.num_rows:
            return pa.table({"gram": pa.array([], pa.int64()), "cid": pa.array([], pa.int64())})
        chunk = classes.column("chunk")[0].as_py()
        blobs = [answers.column(k).to_pylist() for k in ("grams", "docs", "times")]
        grams = np.concatenate([tk.unpack_sorted(b) for b in blobs[0]])
        docs, times = (np.concatenate([tk.unpack(b).astype(np.int64) for b in part]) for part in blobs[1:])
        size = np.zeros(max(int(index.max()), int(docs.max())) + 1, np.int64)
        size[index] = classes.column("size").to_numpy()
        counted, looked_up = prefix_sizes(size, least)
        shared = np.bincount(docs, minlength=len(size))
        # n-grams of this document alone come first in order of rarity and need no look-up
        left = np.maximum(0, looked_up - (counted - shared))
        order = np.lexsort((grams, times, docs))
        grams, docs = grams[order], docs[order]
        rank = np.arange(len(docs)) - np.searchsorted(docs, docs)
        keep = rank < left[docs]
        return pa.table({"gram": pa.array(tk.signed(grams[keep])), "cid": pa.array((chunk << _INDEX_BITS) + docs[keep])})

    return run


def _sets(n: int):
    """Sets of the rows whose set is that of the class asked for by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, most=PIECE_BYTES):
            grams, bounds = shingles(*tk.text_bytes(piece.column(0)), n)
            k1, k2 = set_keys(grams, bounds)
            raw = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 8).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(grams))])
            same = (tk.signed(k1) == piece.column(2).to_numpy()) & (tk.signed(k2) == piece.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([piece.column(1), raw.cast(pa.binary())], ["cid", "grams"]).filter(pa.array(same))

    return run


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its rows, of a few longs each, are counted to be few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class _Members:
    """Sets of a group of documents, flattened."""

    def __init__(self, blobs: list[bytes]):
        self.sizes = np.array([len(b) // 8 for b in blobs], np.int64)
        self.flat = np.frombuffer(b"".join(blobs), np.uint64)
        self.at = np.cumsum(self.sizes) - self.sizes

    def one(self, i: int) -> np.ndarray:
        return self.flat[self.at[i] : self.at[i] + self.sizes[i]]

    def common(self, pivot: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Elements that each of some members shares with the pivot."""
        if not len(pivot) or not len(some):
            return np.zeros(len(some), np.int64)
        part = self.flat[tk.ragged(self.at[some], self.sizes[some])]
        place = np.minimum(np.searchsorted(pivot, part), len(pivot) - 1)
        hit = np.concatenate(([0], np.cumsum(pivot[place] == part)))
        ends = np.cumsum(self.sizes[some])
        return hit[ends] - hit[ends - self.sizes[some]]


class _Groups:
    """Members by what links have connected; the smaller of two groups is renamed, so all unions cost n log n."""

    def __init__(self, n: int):
        self.of, self.left = np.arange(n), n
        self._members: dict[int, list[int]] = {}

    def join(self, a: int, b: int) -> bool:
        a, b = int(self.of[a]), int(self.of[b])
        if a == b:
            return False
        into, out = self._members.pop(a, [a]), self._members.pop(b, [b])
        if len(into) < len(out):
            into, out, a = out, into, b
        self.of[out] = a
        into.extend(out)
        self._members[a] = into
        self.left -= 1
        return True


def _rare_postings(members: _Members, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An inverted index of each member's rarest elements of the region, as many as its prefix takes.

    Two members that link share one of them (the prefix principle in the region's own
    order of rarity). Returned are the members by element, where each element's
    postings end, and each member's places in the postings with their bounds.
    """
    num, den = least
    n = len(members.sizes)
    row = np.repeat(np.arange(n), members.sizes)
    _, element, times = np.unique(members.flat, return_inverse=True, return_counts=True)
    order = np.lexsort((element, times[element], row))
    rank = np.arange(len(row)) - np.repeat(members.at, members.sizes)
    prefix = members.sizes - -(-members.sizes * num // den) + 1
    chosen = order[(rank < prefix[row]) & (times[element[order]] > 1)]
    chosen = chosen[np.lexsort((row[chosen], element[chosen]))]
    element, row = element[chosen], row[chosen]
    ends = np.searchsorted(element, element, side="right")
    places = np.argsort(row, kind="stable")
    return row, ends, places, np.searchsorted(row[places], np.arange(n + 1))


def region_links(members: _Members, least: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that connect all members which links connect.

    Every member is a pivot once. It is compared only with later members that share a rare
    element with it, lie within the windows of the first pivots, are of fitting size and
    are not connected with it yet.
    """
    num, den = least
    n = len(members.sizes)
    reach = 1 - num / den + 1e-9
    if n < 2 or not len(members.flat):
        return []
    postings, ends, places, bounds = _rare_postings(members, least)
    groups = _Groups(n)
    seen: list[np.ndarray] = []
    links = []
    has_later = np.zeros(n, bool)
    has_later[postings[np.arange(len(postings)) + 1 < ends]] = True
    for pivot in np.flatnonzero(has_later).tolist():
        size = members.sizes[pivot]
        if len(seen) < STORED_PIVOTS:
            later = np.arange(pivot + 1, n)
            shared = members.common(members.one(pivot), later)
            far = np.zeros(n)
            far[later] = 1 - shared / (size + members.sizes[later] - shared)
            seen.append(far)
        look = np.concatenate([postings[at + 1 : ends[at]] for at in places[bounds[pivot] : bounds[pivot + 1]].tolist()])
        fits = (groups.of[look] != groups.of[pivot]) & (members.sizes[look] * den >= size * num) & (size * den >= members.sizes[look] * num)
        for d in seen:
            fits &= np.abs(d[look] - d[pivot]) <= reach
        look = np.unique(look[fits])
        if not len(look):
            continue
        common = members.common(members.one(pivot), look)
        union = size + members.sizes[look] - common
        links.extend((pivot, i) for i in look[common * den >= union * num].tolist() if groups.join(pivot, i))
        if groups.left == 1:
            break
    return links


def _join_region(least: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        cids, order = np.unique(table.column("cid").to_numpy(), return_index=True)
        blobs = table.column("grams").take(pa.array(order)).to_pylist()
        links = region_links(_Members(blobs), least)
        a, b = (cids[np.array([x[k] for x in links], np.int64)] if links else np.zeros(0, np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return run


_CELLS = "region long, cell long, cid long, distance double, linked boolean, pivot long, size long"


def _nearest(least: tuple[int, int]):
    """Cells of the members of one part of a large region."""
    num, den = least
    reach = 1 - num / den

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        columns = {k: [] for k in ("region", "cell", "cid", "distance", "linked", "pivot", "size")}
        if members.num_rows and pivots.num_rows:
            region = members.column("region")[0].as_py()
            own = _Members(members.column("grams").to_pylist())
            cids, all_members = members.column("cid").to_numpy(), np.arange(members.num_rows)
            heads, order = np.unique(pivots.column("cid").to_numpy(), return_index=True)
            sets = [np.frombuffer(b, np.uint64) for b in pivots.column("grams").take(pa.array(order)).to_pylist()]
            common = np.stack([own.common(s, all_members) for s in sets], 1)
            union = own.sizes[:, None] + np.array([len(s) for s in sets])[None, :] - common
            far = 1 - common / union
            linked = (common * den >= union * num) & (cids[:, None] != heads[None, :])
            into = far <= far.min(1, keepdims=True) + 2 * reach + 1e-9
            row, cell = np.nonzero(into | linked)
            for name, value in zip(columns, (np.full(len(row), region), cell, cids[row], far[row, cell], linked[row, cell], heads[cell], own.sizes[row])):
                columns[name].append(value)
        kinds = {"distance": np.float64, "linked": bool}
        return pa.table({k: pa.array(np.concatenate([np.zeros(0, kinds.get(k, np.int64)), *v]).astype(kinds.get(k, np.int64))) for k, v in columns.items()})

    return run


def _renewed(df: DataFrame) -> DataFrame:
    """The same rows under new column references, for a join of a table with itself."""
    return df.select(*[F.col(c).alias(f"{c}_") for c in df.columns]).toDF(*df.columns)


def _split(regions: DataFrame, sets: DataFrame, least: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One level of cells for large regions: their members by cell, members of those that pivots do not part, and the links with the pivots."""
    reach = 1 - least[0] / least[1]
    full = sets.join(_small(regions), "cid")
    parts = F.greatest(F.lit(1), F.ceil(F.col("elements") / SALT_ELEMENTS))
    salted = full.withColumn("salt", F.pmod(F.xxhash64("cid"), parts).cast("long")).select("region", "salt", "cid", "grams")
    draw = Window.partitionBy("region").orderBy(F.xxhash64("cid", "region"), "cid")
    heads = regions.withColumn("n", F.row_number().over(draw)).where(F.col("n") <= PIVOTS).drop("n", "size")
    heads = sets.join(_small(heads), "cid")
    spread = heads.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).select("region", "salt", "cid", "grams")
    cells = stored(
        salted.groupBy("region", "salt").cogroup(_renewed(spread).groupBy("region", "salt")).applyInArrow(_nearest(least), _CELLS),
        "jaccard-cells",
    )
    outside = cells.where("not linked and cid <> pivot").groupBy("region", "cell").agg(F.min("distance").alias("nearest"))
    # a document that links with the pivot stays only within the window of one that does not
    kept = stored(cells.join(outside, ["region", "cell"]).where(F.col("distance") >= F.col("nearest") - reach - 1e-9).select("region", "cell", "cid", "size"), "jaccard-kept")
    before = regions.groupBy("region").agg(F.count("*").alias("before"))
    spread_out = kept.groupBy("region").agg(F.count("*").alias("after")).join(before, "region").where(F.col("after") > SPREAD * F.col("before")).select("region")
    parted = kept.join(spread_out, "region", "left_anti").select(F.xxhash64("region", "cell").alias("region"), "cid", "size")
    whole = regions.join(spread_out, "region", "left_semi")
    return parted.distinct(), whole, cells.where("linked").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))


def _blocks(regions: DataFrame) -> DataFrame:
    """Regions that pivots did not split: every two blocks of one meet in a region of their own."""
    count = F.greatest(F.lit(1), F.ceil(F.col("elements") * 2 / REGION_ELEMENTS)).cast("long")
    block = regions.withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return block.withColumn("other", other).select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "cid", "size")


def _weighed(regions: DataFrame) -> DataFrame:
    weight = regions.groupBy("region").agg(F.sum("size").alias("elements"), F.count("*").alias("members")).where("members > 1").drop("members")
    return regions.join(weight, "region")


def links(regions: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): links of all regions; large regions are split first. ``regions``: (region, cid, size)."""
    found = []
    small = F.col("elements") <= REGION_ELEMENTS
    ready = []
    regions = stored(_weighed(regions), "jaccard-regions")
    for level in range(LEVELS + 1):
        ready.append(regions.where(small).select("region", "cid"))
        large = regions.where(~small)
        if not large.head(1):
            break
        if level == LEVELS:
            ready.append(_blocks(large).select("region", "cid").distinct())
            break
        cells, whole, with_pivots = _split(large, sets, least)
        found.append(with_pivots)
        ready.append(_blocks(whole).select("region", "cid").distinct())
        regions = stored(_weighed(cells), "jaccard-regions")
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    found.append(sets.join(_small(every), "cid").groupBy("region").applyInArrow(_join_region(least), "a long, b long"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for all nodes of the edges (a, b)."""
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        star = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # small star: every node and its smaller neighbours go to the smallest of them
        low = star.groupBy("b").agg(F.min("a").alias("m"))
        inner = star.join(low, "b")
        fresh = stored(inner.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(low.select(F.col("m").alias("a"), "b")).distinct(), "links")
        changed = fresh.join(edges, ["a", "b"], "left_anti").limit(1).count() or edges.join(fresh, ["a", "b"], "left_anti").limit(1).count()
        edges = fresh
        if not changed:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def components(docs: DataFrame, n: int, least: tuple[int, int]) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; ``least``: similarity as a fraction of integers."""
    id_field = docs.schema["doc_id"]
    kind = id_field.dataType.simpleString()
    rows = docs.select("doc_id", "text")
    weight = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = max(LEAST_OWNERS, math.ceil(weight / OWNER_BYTES))
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("chunk", T.LongType()), T.StructField("doc_id", id_field.dataType), T.StructField("index", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("stands", T.BooleanType()), T.StructField("owner", T.IntegerType()), T.StructField("grams", T.BinaryType()), T.StructField("docs", T.BinaryType()),
    ])
    read = stored(rows.mapInArrow(_read(n, least, owners), schema), "shingles")
    every = read.where("kind = 0").select("doc_id", "chunk", "index", "size", "k1", "k2", "stands")
    filled = every.where("size > 0")
    # a class goes by the place of a document whose n-grams were counted, and by its smallest id
    place = F.min(F.when(F.col("stands"), F.struct("chunk", "index")))
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    grouped = filled.groupBy("k1", "k2").agg(place.alias("p"), smallest.alias("d"), F.first("size").alias("size"))
    classes = stored(
        grouped.select("k1", "k2", "size", "d.doc_id", "p.chunk", "p.index").withColumn("cid", F.shiftleft("chunk", _INDEX_BITS) + F.col("index")),
        "classes",
    )

    answers = read.where("kind = 1").select("chunk", "owner", "grams", "docs").groupBy("owner").applyInArrow(_count, "chunk long, grams binary, docs binary, times binary")
    looked_up = stored(answers.groupBy("chunk").cogroup(classes.select("chunk", "index", "size").groupBy("chunk")).applyInArrow(_look_up(least), "gram long, cid long"), "rare")
    heads = looked_up.groupBy("gram").agg(F.min("cid").alias("region"), F.max("cid").alias("last")).where("region < last").drop("last")
    regions = looked_up.join(heads, "gram").select("region", "cid").distinct()
    regions = stored(regions.join(classes.select("cid", "size"), "cid"), "regions")

    involved = stored(regions.select("cid").distinct().join(classes.select("cid", "doc_id", "k1", "k2"), "cid"), "involved")
    wanted = _small(involved.select(F.col("doc_id").alias("__id"), "cid", "k1", "k2"))
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id"))).select("text", "cid", "k1", "k2")
    # rows that repeat an id and its text give a set more than once; the tasks that join take one
    sets = stored(texts.mapInArrow(_sets(n), "cid long, grams binary"), "sets")

    roots = connected(links(regions, sets, least))
    linked = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    ids = linked.groupBy("root").agg(F.min(first).alias("p")).select("root", F.col("p.doc_id").alias("component_id"))
    named = linked.join(ids, "root").select("k1", "k2", "component_id", F.lit(True).alias("__in"))
    return every.join(named, ["k1", "k2"], "left").select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("__in") & (F.col("size") > 0), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int, least: tuple[int, int]) -> DataFrame:
    """The documents without those that links connect with one of a smaller id; rows that share an id stay together."""
    (removed,) = fresh(docs.columns, "__id")
    gone = components(docs, n, least).where("component_id <> doc_id").select(F.col("doc_id").alias(removed)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(removed), "left_anti")
