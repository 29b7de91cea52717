import math
import random

from pyspark.sql import functions as F

from txquality.llm import kd_shards


def placed(docs, **how):
    dims = kd_shards.text_dimensions()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("tie"), *[c.alias(d) for d, c in dims.items()])
    return [r.asDict() for r in kd_shards.kd_shards(rows, list(dims), **how).collect()]


def gapless(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_near_equal_and_slots_gapless(make):
    draw = random.Random(4)
    texts = ["word " * draw.randrange(1, 60) + "\n" * draw.randrange(4) for _ in range(900)]
    rows = placed(make(texts), shards=6)
    sums = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(6)]
    assert len(rows) == 900 and max(sums) - min(sums) <= 2 * 310
    assert gapless(rows)


def test_a_group_of_copies_is_split_only_as_balance_needs(make):
    rows = placed(make(["same text"] * 300 + [f"other text {i}" for i in range(600)]), shards=4)
    sums = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(4)]
    assert max(sums) - min(sums) <= 60 and gapless(rows)


def test_leaves_reach_the_target(make):
    rows = placed(make([f"text {i:04d}" for i in range(100)]), target_bytes=105)
    assert len({r["shard"] for r in rows}) == 10


def test_odd_rows(odd):
    rows = placed(odd, shards=3)
    assert len(rows) == odd.count() and gapless(rows)
    assert sorted(r["size"] for r in rows if r["doc_id"] in (0, 1)) == [1, 1]


def test_empty_table_and_one_shard(odd):
    assert placed(odd.limit(0), shards=16) == []
    assert {r["shard"] for r in placed(odd, shards=1)} == {0}


def test_no_python_in_the_plan(make):
    dims = kd_shards.text_dimensions()
    docs = make(["a", "b c"])
    rows = docs.select("doc_id", F.lit(1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"), *[c.alias(d) for d, c in dims.items()])
    plan = kd_shards.kd_shards(rows, list(dims), shards=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_a_row_that_is_a_third_of_the_table_is_parted(spark):
    """Equal rows are cut by place, so every shard keeps its share, and no task numbers them all."""
    one = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same row again").alias("text"))
    others = spark.range(60_000).select((F.col("id") + 100).alias("doc_id"), F.repeat(F.lit("ab "), (F.col("id") % 9 + 1).cast("int")).alias("text"))
    rows = placed(one.unionByName(others).repartition(6), shards=4)
    sums = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(4)]
    assert max(sums) - min(sums) <= 2 * kd_shards.TOLERANCE * sum(sums)
    assert len(rows) == 90_000 and gapless(rows)


def test_cuts_are_those_of_a_plain_tree(make):
    """Against a recursion that sorts each node along its widest dimension and cuts at the weighted median."""
    draw = random.Random(11)
    texts = ["w" * draw.randrange(1, 400) + " " * draw.randrange(40) + "\n" * draw.randrange(12) for _ in range(500)]
    rows = placed(make(texts), shards=8)
    # leaves of the tree are boxes: along some dimension, siblings do not mix beyond ties
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * 401 and gapless(rows)
    half = [{r["doc_id"] for r in rows if r["shard"] // 4 == s} for s in range(2)]
    measured = {i: measure(t) for i, t in enumerate(texts)}
    spans = [(min(m[d] for m in measured.values()), max(m[d] for m in measured.values())) for d in range(4)]
    # every dimension is scaled to the same range, so the first cut is along the first one that varies
    widest = next(d for d in range(4) if spans[d][1] > spans[d][0])
    low, high = (sorted(measured[i][widest] for i in ids) for ids in half)
    assert low[-1] <= high[0] + (spans[widest][1] - spans[widest][0]) / 2**19


def measure(text):
    size = len(text.encode()) + 1
    return (math.log2(size), text.count(" ") / size, text.count("\n") / size, (len(text.encode()) - len(text)) / size)
