import math

import numpy as np

from accesslens.llm import negatives

KIND = "vec_id long, embedding array<float>, label int, row string, id string, part string, windows string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "w", "x", "y", "z") for i, v, label in rows], KIND)


def brute(rows, k=5, every=100):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, q, mine in good:
        if a % every:
            continue
        kept = [(sum(x * y for x, y in zip(q, v)), i, label) for i, v, label in good if i != a and len(v) == len(q)]
        scores = [(max(-negatives.LONG, min(negatives.LONG, s)), i, label) for s, i, label in kept]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scores if s[2] == mine][:k]:
            hard = [s for s in scores if s[2] != mine and 80 * p <= 100 * s[0] <= 100 * p][:k]
            out += [(a, pid, n + 1, i, p, s) for n, (s, i, _) in enumerate(hard)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def clustered(seed, n, sides=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, sides))
    return [(i, (centres[i % 8] + 0.3 * rng.normal(size=sides)).tolist(), int(rng.integers(0, 10))) for i in range(n)]


def test_equals_brute_force_over_many_blocks(spark):
    rows = clustered(1, 900)
    got = found(negatives.hard_negatives(frame(spark, rows), values=300))
    assert got == brute(rows) and len(got) > 100


def test_ties_and_one_common_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [0.5, -0.25] if i % 3 else rng.integers(-2, 3, 2).astype(float).tolist(), i % 4) for i in range(500, -1, -1)]
    assert found(negatives.hard_negatives(frame(spark, rows), k=4, every=20, values=100)) == brute(rows, 4, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 9), (100, None, 1), (200, [nan, 1.0], 1), (300, [inf, 1.0], 1), (400, [None, 1.0], 1), (None, [1.0, 1.0], 1),
        (500, [3.0, 4.0], None), (600, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.9, 2.0], 2), (3, [0.9, 1.9], 1), (4, [1.0, 2.0, 3.0], 1),
        (700, [1.0, 2.0, 3.0], 0), (5, [1.0, 1.9, 3.0], 2), (800, [], 1), (6, [], 1), (8, [], 2), (7, [-1.0, -1.0], 0), (9, [0.0, 0.0], 1),
    ]
    got = found(negatives.hard_negatives(frame(spark, rows)))
    assert got == brute(rows) and {600, 700, 800} <= {r[0] for r in got}


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(100, [1.0], 1), (100, [1.0], 1), (3, [1.0], 1), (3, [1.0], 1), (4, [0.9], 2), (4, [0.9], 2)]
    got = found(negatives.hard_negatives(frame(spark, rows)))
    assert got == brute(rows) and len(got) == 2 * 2 * 2


def test_large_components_are_exact(spark):
    rows = [(0, [3e6, 7e6], 9), (1, [3e6, 7e6], 0), (2, [2.9e6, 7e6], 1), (3, [3e6, 6.9e6], 2), (100, [1e30, 1.0], 1), (5, [1e30, 2.0], 1), (6, [1e30, 3.0], 2)]
    assert found(negatives.hard_negatives(frame(spark, rows))) == brute(rows)


def test_the_scan_reads_few_candidates_to_the_end():
    rng = np.random.default_rng(5)
    points = np.floor(256 * np.sort(rng.normal(size=(32, 3000)) * np.linspace(3, 0.05, 32)[:, None], axis=0)[::-1])
    block = {"ids": list(range(3000)), "labels": [0] * 3000, "columns": points.ravel(), "low": points.min(axis=1), "high": points.max(axis=1)}
    opened = negatives.Opened(block)
    query = points[:, 7].copy()
    exact = points.T @ query
    window = (int(np.quantile(exact, 0.6)), int(np.quantile(exact, 0.9)))
    sizes = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple):
                sizes.append(len(np.ravel(key[1])))
            return np.asarray(super().__getitem__(key))

    opened.columns = opened.columns.view(Counted)
    (got,) = opened.scan(query, np.ones(3000, bool), [window], 5)
    inside = sorted(((-s, i) for i, s in enumerate(exact) if window[0] <= s <= window[1]))[:5]
    assert got == [(i, int(-s)) for s, i in inside]
    assert sizes[-1] < 300


def test_cells_part_the_sample_evenly():
    rng = np.random.default_rng(6)
    points = rng.normal(size=(1000, 4))
    cuts = negatives.cuts_of(points, 16)
    counts = np.bincount(negatives.cells_of(points, cuts))
    assert len(counts) == 16 and counts.min() > 40
    assert negatives.cuts_of(np.ones((100, 3)), 8) == []


def test_empty_table(spark):
    assert negatives.hard_negatives(frame(spark, [])).collect() == []
