import os

import numpy as np

from txquality.llm import prefix_forest as pf

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).repartition(3)


def nearest(points, ids, q, n=10):
    far = np.sqrt(((points - points[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, far)) if i != q][:n]
    return [(int(ids[i]), float(far[i])) for i in order]


def test_recall_on_clusters_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    points = (rng.standard_normal((12, 16))[rng.integers(0, 12, 1500)] + 0.3 * rng.standard_normal((1500, 16))).astype(np.float32).astype(float)
    ids = np.arange(1500)
    df = table(spark, [(int(i), p.tolist()) for i, p in zip(ids, points)])
    found = {}
    for r in pf.search(df, df.where("vec_id % 100 = 0"), "vec_id", "embedding", share=0.1).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 100):
        rows = sorted(found[q])
        assert [r[0] for r in rows] == list(range(1, 11)) and [r[2] for r in rows] == sorted(r[2] for r in rows)
        assert all(abs(s - np.sqrt(((points[v] - points[q]) ** 2).sum())) < 1e-12 for _, v, s in rows)
        hits += len({v for _, v, _ in rows} & {v for v, _ in nearest(points, ids, q)})
    assert hits >= 0.9 * 150


def test_longest_prefix_is_the_common_bits(spark):
    mine = np.random.default_rng(2).integers(0, 1 << 10, (40, pf.TREES), dtype=np.uint64) << np.uint64(22)
    asked = mine[:3] ^ np.uint64(1 << 25)
    got = pf._longest(mine, asked)
    for q in range(3):
        for i in range(40):
            want = max(pf.LENGTH - int(int(a) ^ int(b)).bit_length() for a, b in zip(mine[i], asked[q]))
            assert got[q, i] == want


def test_odd_vectors_take_no_part(spark):
    df = table(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (9, [1.0, 1.0]), (100, [1.0, 0.0]), (None, [1.0, 1.0])])
    rows = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in pf.search(df, df.where("vec_id % 100 = 0"), "vec_id", "embedding").collect())
    assert rows == [(0, 1, 100, 0.0), (0, 2, 9, 1.0), (0, 3, 1, 1.414214), (100, 1, 0, 0.0), (100, 2, 9, 1.0), (100, 3, 1, 1.414214)]


def test_many_copies_and_ties(spark):
    df = table(spark, [(i, [1.0, 2.0]) for i in range(150)] + [(i, [3.0, 2.0]) for i in range(150, 160)])
    rows = [r for r in pf.search(df, df.where("vec_id % 100 = 0"), "vec_id", "embedding").collect() if r.query_id == 100]
    assert [r.vec_id for r in sorted(rows, key=lambda r: r.rank)] == list(range(10)) and {r.score for r in rows} == {0.0}


def test_repeated_ids_take_one_place_in_their_block(spark, monkeypatch):
    monkeypatch.setattr(pf, "LEAST_BLOCKS", 1)
    same, moving = [(7, [1.0, 1.5])] * 15, [(8, [1.0, 1.5 + k / 100]) for k in range(1, 16)]
    others = [(i, [float(i), 1.0]) for i in range(10, 40)]
    df = table(spark, [(0, [1.0, 1.0]), *same, *moving, *others])
    rows = sorted((r.rank, r.vec_id, round(r.score, 6)) for r in pf.search(df, df.where("vec_id = 0"), "vec_id", "embedding", share=1.0).collect())
    assert rows == [(1, 7, 0.5), (2, 8, 0.51), *[(k + 3, k + 10, k + 9.0) for k in range(8)]]


def test_empty_tables(spark):
    df = table(spark, [(0, [1.0, 0.0])])
    assert pf.search(df.limit(0), df.limit(0), "vec_id", "embedding").collect() == []
    assert pf.search(df, df, "vec_id", "embedding").collect() == []


def test_fitted_share_reaches_the_recall_on_random_directions_and_is_small_on_clusters(spark):
    rng = np.random.default_rng(4)
    uniform = rng.standard_normal((3000, 64))
    clusters = rng.standard_normal((300, 64))[rng.integers(0, 300, 3000)] + 0.05 * rng.standard_normal((3000, 64))
    shares = []
    for points in (uniform, clusters):
        points = points / np.linalg.norm(points, axis=1, keepdims=True)
        points = points.astype(np.float32).astype(float)
        df = table(spark, [(i, p.tolist()) for i, p in enumerate(points)])
        seen, fit = [], pf.fitted_share
        pf.fitted_share = lambda *a: seen.append(fit(*a)) or seen[-1]
        try:
            found = {(r.query_id, r.vec_id) for r in pf.search(df, df.where("vec_id % 100 = 0"), "vec_id", "embedding").collect()}
        finally:
            pf.fitted_share = fit
        shares += seen
        want = {(q, v) for q in range(0, 3000, 100) for v, _ in nearest(points, np.arange(3000), q)}
        assert len(found) == 300 and len(found & want) >= 0.9 * len(want)
    assert shares[0] < 0.1 and shares[1] < 0.01


def test_registered_query_has_recall_on_the_whole_table(spark):
    from txquality.llm import queries

    rows = pf.usable(spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id is not null"), "embedding").select("vec_id", "v").collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.v for r in rows])
    found = {(r.query_id, r.vec_id) for r in queries.op5_prefix_forest(spark, SF_DIR).collect()}
    want = {(int(ids[q]), v) for q in np.flatnonzero(ids % 100 == 0) for v, _ in nearest(points, ids, q)}
    assert len(found) == len(want) and len(found & want) >= 0.9 * len(want)


def test_a_query_id_with_several_vectors_asks_with_the_smallest(spark):
    df = table(spark, [(0, [9.0, 9.0]), (0, [1.0, 1.0]), *[(i, [1.0, 1.0 + i]) for i in range(1, 15)]])
    rows = sorted((r.rank, r.vec_id) for r in pf.search(df, df.where("vec_id = 0"), "vec_id", "embedding").collect())
    assert rows == [(i, i) for i in range(1, 11)]
