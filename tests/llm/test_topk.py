import math

import numpy as np

from accesslens.llm import topk

KIND = "vec_id long, embedding array<float>, label int, id string, vector string, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], KIND)


def brute(rows, k, every):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in good:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_equals_brute_force_over_shards(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(700)]
    assert found(topk.top_k(frame(spark, rows), k=5, every=50, shard=100)) == brute(rows, 5, 50)


def test_ties_and_one_common_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [0.5, -0.25] if i % 3 else rng.integers(-2, 3, 2).astype(float).tolist()) for i in range(400, 0, -1)]
    assert found(topk.top_k(frame(spark, rows), k=5, every=20, shard=64)) == brute(rows, 5, 20)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [float("nan"), 1.0]), (150, [float("inf"), 1.0]), (200, [None, 1.0]), (None, [1.0, 1.0]),
        (250, [3.0, 4.0]), (1, [-1.0, 0.001]), (300, [1.0, 2.0, 3.0]), (350, []), (400, []), (2, [0.0, 0.0]),
    ]
    assert found(topk.top_k(frame(spark, rows), k=3, every=50)) == brute(rows, 3, 50)


def test_repeated_ids_are_rows_but_never_their_own_result(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])]
    got = found(topk.top_k(frame(spark, rows), k=5, every=50))
    assert {r[2] for r in got} == {1, 2} and max(r[1] for r in got) == 5


def test_large_components_are_exact(spark):
    rows = [(0, [3e6, 7e6]), (1, [3e6, 7e6]), (2, [1e30, 1e30]), (3, [-3e6, 1.0])]
    got = found(topk.top_k(frame(spark, rows), k=5, every=50))
    want = [(q, n, v, max(-topk.LONG, min(topk.LONG, s))) for q, n, v, s in brute(rows, 5, 50)]
    assert got == want


def test_boxes_bound_products_and_cut_nodes():
    rng = np.random.default_rng(4)
    points = topk.whole(rng.normal(size=(2000, 3)))
    tree = topk.Tree(np.arange(2000), points)
    queries = topk.whole(rng.normal(size=(10, 3)))
    bounds = tree.bounds(queries)
    for node, (a, b) in enumerate(zip(tree.first, tree.last)):
        assert ((tree.points[a:b] @ queries.T).max(axis=0) <= bounds[:, node]).all()
    floors = np.sort(points @ queries.T, axis=0)[-5]
    cut = (bounds < floors[:, None]).mean()
    assert cut > 0.5


def test_queries_only_visit_cells_that_can_win(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 4)) * 10
    rows = [(i, (centres[i % 40] + rng.normal(size=4) / 10).astype(np.float32).tolist()) for i in range(4000)]
    assert found(topk.top_k(frame(spark, rows), k=5, every=50, shard=100)) == brute(rows, 5, 50)
    queries = spark.createDataFrame([(-1, 7, [1.0, 0.0], 600.0), (-1, 8, [1.0], 0.0)], "home long, id long, vector array<double>, floor double")
    boxes = {0: (np.array([0.0, -9.0]), np.array([2.0, 9.0])), 1: (np.array([3.0, 0.0]), np.array([4.0, 0.0]))}
    parts = spark.createDataFrame([(0, 1), (1, 2)], "cell long, parts long")
    sent = sorted((r.id, r.shard) for r in topk.visits_of(queries, boxes, 2, 2, parts).collect())
    # 256 * 2 is below 600, 256 * 4 is not; a query of another length goes everywhere.
    assert sent == [(7, 1 << 32), (7, (1 << 32) + 1), (8, 0), (8, 1 << 32), (8, (1 << 32) + 1)]


def test_empty_vectors_in_several_shards(spark):
    rows = [(i, []) for i in range(1, 61)]
    assert found(topk.top_k(frame(spark, rows), k=5, every=50, shard=10)) == brute(rows, 5, 50)


def test_repeated_ids_spread_over_shards(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(1, 400)] + [(403, [0.5, 0.5, 0.5])] * 300
    seen = []
    searched = topk.searched
    topk.searched = lambda rows, k: seen.append(rows.filter("kind = 0").groupBy("shard").count().agg({"count": "max"}).first()[0]) or searched(rows, k)
    try:
        got = found(topk.top_k(frame(spark, rows), k=5, every=50, shard=50))
    finally:
        topk.searched = searched
    assert got == brute(rows, 5, 50) and max(seen) < 150


def test_empty_table(spark):
    assert topk.top_k(frame(spark, [])).collect() == []
