"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree hashes a vector's direction from the centre of the data to a string
of LENGTH bits and keeps its vectors as a sorted array of these strings. A
string begins with SYMBOLS symbols: the direction is turned at random, and a
symbol names which of AXES axes it is nearest to, and on which side. Near
vectors share a symbol far more often than the five sides of planes that it
stands for. The sides of some of the axes follow, one bit each. Descent: in
every tree a query finds, by binary search, where its own string would stand;
the vectors that share its longest prefixes are its neighbours there. Ascent:
all trees go up together, one bit at a time, and take in every vector that
shares the shorter prefix with the query, until a tree holds the wanted share
of all vectors on average. All that were taken in are compared exactly.

The share is a parameter, or fitted: for FIT_QUERIES of the queries (the first
by a hash of their ids) the true neighbours are found among all vectors, and
the share is what the trees must hold to take in RECALL of them. So it is small
on data with structure, and as large as needed on vectors of random directions,
whose nearest neighbours are hardly nearer than the rest.

How it is spread: the vectors are dealt into blocks by a hash of their id, and
each block keeps the forest's sorted arrays of its own vectors; a prefix's
vectors are those of all blocks, so counts add up. A first pass counts, for
each query and level, what the trees of every block hold; the sums decide each
query's level. A second pass compares, and keeps the best of each block, one
row of each id; the best of those are the answer. A vector that a third of all
rows repeats is thus spread over all blocks; rows that repeat an id with its
vector are made one before. Queries go to every block in groups of GROUP_BYTES.

Defined cases: vectors that are NULL, empty, zero, of another length than most,
or hold NULL or non-finite components take no part; repeated ids are one
candidate each; a query id with several vectors asks with the smallest of them;
a query with fewer candidates than NEAREST gets all; ties go to the smaller id;
without vectors there are no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txquality.llm import textkit as tk
from txquality.session import stored

TREES = 192
AXES = 16
SYMBOLS = 3
SYMBOL_BITS = 5
SIDES = 20
LENGTH = SYMBOLS * SYMBOL_BITS + SIDES
NEAREST = 10
FIT_QUERIES = 128
RECALL = 0.95
BLOCK_ROWS = 20_000
LEAST_BLOCKS = 16
GROUP_BYTES = 32 << 20
CHUNK_QUERIES = 256
SEED = 11


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector takes part, with the vector as doubles."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(vector).isNotNull()).withColumn("v", v).where((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0.0)).drop(vector)
    return rows


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@functools.lru_cache(maxsize=2)
def axes(width: int) -> np.ndarray:
    """The axes of each tree's symbols, at right angles where the vectors are long enough."""
    draw = np.random.default_rng(SEED).standard_normal((TREES, SYMBOLS, width, AXES))
    turned = np.linalg.qr(draw)[0] if width >= AXES else draw / np.linalg.norm(draw, axis=2, keepdims=True)
    return turned.transpose(0, 2, 1, 3).reshape(TREES, width, SYMBOLS * AXES).astype(np.float32)


def hash_strings(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """One string of LENGTH bits for each vector and tree, as the integer it spells."""
    away = points - centre
    away = away / np.maximum(np.abs(away).max(1, keepdims=True), np.finfo(float).tiny)
    away = away.astype(np.float32)
    strings = np.zeros((len(points), TREES), np.uint64)
    for tree, turn in enumerate(axes(points.shape[1])):
        along = away @ turn
        by_symbol = along.reshape(len(points), SYMBOLS, AXES)
        nearest = np.abs(by_symbol).argmax(2)
        side = np.take_along_axis(by_symbol, nearest[:, :, None], 2)[:, :, 0] > 0
        symbols = (nearest * 2 + side).astype(np.uint64)
        for i in range(SYMBOLS):
            strings[:, tree] = (strings[:, tree] << np.uint64(SYMBOL_BITS)) | symbols[:, i]
        sides = (along[:, :SIDES] > 0) @ (np.uint64(1) << np.arange(SIDES, dtype=np.uint64))
        strings[:, tree] = (strings[:, tree] << np.uint64(SIDES)) | sides
    return strings


def prefix_ranges(array: np.ndarray, strings: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where in a sorted array the strings lie that share the first ``level`` bits with each query's."""
    drop = np.uint64(LENGTH) - np.asarray(level, np.uint64)
    low = (strings >> drop) << drop
    return np.searchsorted(array, low, "left"), np.searchsorted(array, low + (np.uint64(1) << drop), "left")


def _levels(width: int, centre: np.ndarray):
    """How many vectors of a block the trees hold at each level, added up over the trees, for each query."""

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        if not block.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "level": pa.array([], pa.int32()), "taken": pa.array([], pa.int64())})
        mine = hash_strings(_matrix(block.column("v"), width), centre)
        asked = hash_strings(_matrix(queries.column("v"), width), centre)
        taken = np.zeros((len(asked), LENGTH + 1), np.int64)
        taken[:, 0] = TREES * len(mine)
        for tree in range(TREES):
            array = np.sort(mine[:, tree])
            some = np.argsort(asked[:, tree])  # in order, so that searches run along the array
            for level in range(1, LENGTH + 1):
                low, high = prefix_ranges(array, asked[some, tree], level)
                held = high > low
                some = some[held]
                if not len(some):
                    break
                taken[some, level] += (high - low)[held]
        row, level = np.nonzero(taken)
        ids = queries.column("query_id").to_numpy()
        return pa.table({"query_id": pa.array(ids[row]), "level": pa.array(level.astype(np.int32)), "taken": pa.array(taken[row, level])})

    return run


def shared_bits(mine: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The longest prefix that any tree has in common, row by row."""
    return LENGTH - np.frexp((mine ^ asked).min(-1).astype(float))[1]


def _longest(mine: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The longest prefix that any tree has in common, for each query and vector."""
    return np.stack([shared_bits(mine, strings) for strings in asked])


def _best(ids: np.ndarray, far: np.ndarray, nearest: int) -> np.ndarray:
    """Places of the nearest, one for each id, ties to the smaller id."""
    best = np.lexsort((ids, far))
    return best[np.sort(np.unique(ids[best], return_index=True)[1])[:nearest]]


def _distances(points: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - wanted) ** 2).sum(1))


def _taken_in(strings: np.ndarray, asked: np.ndarray, level: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the vectors whose prefix of ``level`` bits it shares in any tree."""
    order = np.argsort(strings, axis=0, kind="stable").astype(np.int32)
    arrays = np.take_along_axis(strings, order, 0).T.copy()
    for start in range(0, len(asked), CHUNK_QUERIES):
        chunk = slice(start, start + CHUNK_QUERIES)
        near = np.zeros((len(asked[chunk]), len(strings)), bool)
        near[level[chunk] == 0] = True
        below = np.flatnonzero(level[chunk] > 0)
        for tree in range(TREES if len(below) else 0):
            low, high = prefix_ranges(arrays[tree], asked[chunk][below, tree], level[chunk][below])
            near[np.repeat(below, high - low), order[tk.ragged(low, high - low), tree]] = True
        for i in range(len(near)):
            yield start + i, np.flatnonzero(near[i])


def _compare(width: int, centre: np.ndarray, nearest: int):
    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        columns = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0)]}
        if block.num_rows and queries.num_rows:
            points, wanted = _matrix(block.column("v"), width), _matrix(queries.column("v"), width)
            ids, owner = block.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
            level = queries.column("level").to_numpy()
            for i, some in _taken_in(hash_strings(points, centre), hash_strings(wanted, centre), level):
                some = some[ids[some] != owner[i]]
                far = _distances(points[some], wanted[i])
                best = _best(ids[some], far, nearest)
                columns["query_id"].append(np.full(len(best), owner[i]))
                columns["vec_id"].append(ids[some[best]])
                columns["score"].append(far[best])
        return pa.table({k: pa.array(np.concatenate(v)) for k, v in columns.items()})

    return run


def _true_neighbours(width: int, centre: np.ndarray, nearest: int, owner: np.ndarray, wanted: np.ndarray):
    """The nearest of a task's vectors to each of a few queries, and the prefix that they share with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, width)))] * len(owner)
        for batch in batches:
            batch = pa.Table.from_batches([batch])
            if not batch.num_rows:
                continue
            points, ids = _matrix(batch.column("v"), width), batch.column("vec_id").to_numpy()
            for i in range(len(owner)):
                other = ids != owner[i]
                every = np.concatenate([best[i][0], ids[other]])
                far = np.concatenate([best[i][1], _distances(points, wanted[i])[other]])
                kept = _best(every, far, nearest)
                old = len(best[i][0])
                vectors = np.where((kept < old)[:, None], best[i][2][np.minimum(kept, old - 1)] if old else 0.0, points[other][np.maximum(kept - old, 0)] if other.any() else 0.0)
                best[i] = every[kept], far[kept], vectors
        row = np.repeat(np.arange(len(owner)), [len(ids) for ids, _, _ in best])
        if len(row):
            ids, far, vectors = (np.concatenate(part) for part in zip(*best))
            level = shared_bits(hash_strings(vectors, centre), hash_strings(wanted, centre)[row])
            yield pa.RecordBatch.from_arrays([pa.array(owner[row]), pa.array(ids), pa.array(far), pa.array(level)], ["query_id", "vec_id", "score", "level"])

    return run


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= nearest)


def fitted_share(single: DataFrame, asked: DataFrame, counts: DataFrame, count: int, width: int, centre: np.ndarray, nearest: int) -> float:
    """The share that takes in RECALL of the true neighbours of FIT_QUERIES queries, found among all vectors."""
    sample = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(FIT_QUERIES).select("query_id", "v").collect()
    owner, wanted = np.array([r["query_id"] for r in sample], np.int64), np.array([r["v"] for r in sample], float)
    near = single.select("vec_id", "v").mapInArrow(_true_neighbours(width, centre, nearest, owner, wanted), "query_id long, vec_id long, score double, level int")
    once = near.groupBy("query_id", "vec_id").agg(F.min(F.struct("score", (-F.col("level")).alias("up"))).alias("best"))
    true = _ranked(once.select("query_id", "vec_id", "best.score", (-F.col("best.up")).alias("level")), nearest)
    held = {(r["query_id"], r["level"]): r["taken"] for r in counts.where(F.col("query_id").isin(owner.tolist())).collect()}
    needed = sorted(held[r["query_id"], r["level"]] / TREES for r in true.select("query_id", "level").collect())
    return needed[math.ceil(RECALL * len(needed)) - 1] / count if needed else 1.0


def search(vectors: DataFrame, queries: DataFrame, id_column: str, vector: str, nearest: int = NEAREST, share: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest vectors found for each query, by Euclidean distance.

    ``share``: how many of all vectors a tree must hold on average before the ascent ends; fitted if not given.
    """
    rows = stored(usable(vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("raw")).where("vec_id is not null"), "raw"), "vectors")
    asked = usable(queries.select(F.col(id_column).cast("long").alias("query_id"), F.col(vector).alias("raw")).where("query_id is not null"), "raw")
    spark = vectors.sparkSession
    common = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = common["width"]
    same = F.size("v") == width
    means = rows.where(same).select(*[F.col("v")[i].alias(f"c{i}") for i in range(width)]).agg(*[F.avg(f"c{i}") for i in range(width)]).first()
    centre = np.array(means, float)
    single = stored(rows.where(same).dropDuplicates(["vec_id", "v"]), "single-vectors")
    count, of_one_id = single.groupBy("vec_id").count().agg(F.sum("count"), F.max("count")).first()
    blocks = max(LEAST_BLOCKS, math.ceil(count / BLOCK_ROWS))
    asked = stored(asked.where(same).groupBy("query_id").agg(F.min("v").alias("v")), "queries")
    groups = max(1, math.ceil(asked.count() * width * 8 / GROUP_BYTES))
    dealt = single.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    spread = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) if groups > 1 else dealt.withColumn("part", F.lit(0))
    grouped = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    key = ["block", "part"]

    def with_blocks(queries: DataFrame):
        return queries.select("*", everywhere).groupBy(*key)

    taken = spread.groupBy(*key).cogroup(with_blocks(grouped)).applyInArrow(_levels(width, centre), "query_id long, level int, taken long")
    counts = stored(taken.groupBy("query_id", "level").agg(F.sum("taken").alias("taken")), "level-counts")
    if share is None:
        share = fitted_share(single, asked, counts, count, width, centre, nearest)
    # some tree then holds as many rows, so NEAREST ids and the query's own, however often one is repeated
    enough = min(count, max((nearest + 1) * of_one_id, share * count))
    levels = counts.where(F.col("taken") >= TREES * enough).groupBy("query_id").agg(F.max("level").cast("long").alias("level"))
    levelled = stored(grouped.join(levels, "query_id"), "levels")
    found = spread.groupBy(*key).cogroup(with_blocks(levelled)).applyInArrow(_compare(width, centre, nearest), "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return _ranked(once, nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
