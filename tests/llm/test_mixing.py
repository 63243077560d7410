from collections import defaultdict

import pytest

from accesslens.llm import mixing


def share(sizes):
    """Targets by capping and sharing again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        goal = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and goal[s] > 3 * sizes[s]}
        if not over:
            return goal
        capped |= over


def docs(make_docs, counts):
    rows, n = [], 0
    for source, sizes in counts.items():
        for size in sizes:
            rows.append((n, " ".join(["w"] * size), source))
            n += 1
    return make_docs(rows)


COUNTS = {
    "a": [5] * 200 + [50] * 3,
    "é": [7, 9, 11],
    None: [3] * 40,
    "b": [1],
    "Z": [0, 0],
    "hot": [10] * 300,
    "": [2] * 10,
}


def test_targets_and_taken_words(make_docs):
    rows = mixing.mix(docs(make_docs, COUNTS)).collect()
    goal = share({s: sum(v) for s, v in COUNTS.items()})
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(goal[r.source]) and r.source_size == sum(COUNTS[r.source])
        assert r.taken == r.size * r.copies <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert len(rows) == sum(map(len, COUNTS.values()))
    for s in COUNTS:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6


def test_reruns_agree_on_other_partitions(make_docs):
    df = docs(make_docs, COUNTS)
    first = sorted(map(str, mixing.mix(df).collect()))
    assert first == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_mixed_repeats_documents_as_planned(make_docs):
    df = docs(make_docs, COUNTS)
    want = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    got = defaultdict(int)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert {k: got[k] for k in want} == want


def test_nulls_repeats_and_an_empty_table(make_docs):
    rows = [(None, "a b", "s"), (None, "a b", "s"), (1, None, None), (1, "a b c", "s"), (2, "", "t")]
    got = mixing.mix(make_docs(rows)).collect()
    assert sorted((r.doc_id is None, r.size) for r in got) == [(False, 0), (False, 0), (False, 3), (True, 2), (True, 2)]
    assert len({r.copies for r in got if r.doc_id is None}) == 1
    assert mixing.mix(make_docs([])).collect() == [] == mixing.mixed(make_docs([])).collect()


def test_unequal_odds_order():
    # Pareto order: the same draw ranks earlier where the inclusion odds are larger.
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(0.5, 0.1), (0.5, 0.9), (0.2, 0.1), (0.5, 0.0)], "u double, part double")
    ranks = [r[0] for r in df.select(mixing.pareto_rank(F.col("u"), F.col("part"))).collect()]
    assert ranks[1] < ranks[0] and ranks[2] < ranks[0] and ranks[3] is None


def test_texts_under_null_or_equal_ids_are_drawn_apart(make_docs):
    rows = [(None if i % 2 else 7, f"text {i} " + "w " * (i % 40), "s" if i < 500 else "t") for i in range(1000)]
    rows += [(5000, "v " * 200_000, "u")]  # a very long text
    got = mixing.mix(make_docs(rows)).collect()
    taken, goal = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) <= 21 for s in ("s", "t")) and taken["u"] in (0, 200_000, 400_000, 600_000)
    kept = defaultdict(int)
    for r in mixing.mixed(make_docs(rows)).collect():
        kept[r.source] += len(r.text.split())
    assert {s: kept[s] for s in "st"} == {s: taken[s] for s in "st"}
