import random

import numpy as np
import pytest

from accesslens.llm import quality

LABELS = "doc_id long, quality int, toxic int, text string, grade string"


def made(n, seed=0):
    """Documents of three grades in made-up words."""
    rng = random.Random(seed)
    clean, rude = [f"word{i}" for i in range(300)], ["vile", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(20, 200))]
        grade = rng.choice([0, 1, 2, 2, 2])
        if grade == 0:
            words = [w + "%%%" for w in words]
        if grade == 1:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(rude)
        rows.append((i, " ".join(words)))
        labels.append((i, int(grade > 0), int(grade == 1), "x", "y"))
    return rows, labels


def test_held_out_documents(spark, make_docs):
    rows, labels = made(600)
    fit, test = labels[:400], labels[400:]
    got = {r.doc_id: r for r in quality.classify(make_docs(rows), spark.createDataFrame(fit, LABELS)).collect()}
    good = sum(got[i].kept == (q == 1 and t == 0) for i, q, t, *_ in test)
    assert good >= 0.97 * len(test)
    means = [np.mean([got[i].expected_grade for i, q, t, *_ in test if q + (q and not t) == g]) for g in (0, 1, 2)]
    assert means[0] < means[1] < means[2]


def test_given_labels(spark, sf):
    """Trained on half the labels of the test tables, judged on the other half."""
    docs, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r.kept for r in got if r.quality == 1 and r.toxic == 0]
    poor = [r.kept for r in got if r.quality == 0]
    assert np.mean(clean) > 0.9 and np.mean(poor) < 0.1


def test_words_that_hardly_tell_get_no_weight():
    rng = random.Random(4)
    rows = []
    for i in range(400):
        bad = i % 10 == 0
        words = {rng.randrange(100, 3000) for _ in range(60)} | ({rng.randrange(5)} if bad else set())
        words |= {50} if rng.random() < (0.9 if bad else 0.6) else set()  # common, goes along a little
        places = np.array(sorted(words), np.int32)
        rows.append((places, np.ones(len(places), np.float32), 1 if bad else 2))
    model = quality.fit(rows)
    assert (model.weights[:5] < 0).all() and np.flatnonzero(model.weights).max() < 5


def test_minimum_finds_the_lowest_point():
    a = np.array([[3.0, 1.0], [1.0, 2.0]])
    b = np.array([1.0, -4.0])
    x = quality.minimum(lambda x: (x @ a @ x / 2 - b @ x, a @ x - b), np.zeros(2))
    assert np.allclose(a @ x, b, atol=1e-3)


def test_gradient_equals_differences(monkeypatch):
    """The loss that the fit hands to the minimiser, at a random point."""
    rng = np.random.default_rng(0)
    rows = [(np.array([k % 6]), np.array([1.0 + k % 2], np.float32), k % 3) for k in range(120)]
    seen = []

    def probe(loss, x, *_):
        at = rng.normal(size=len(x))
        _, grad = loss(at)
        eye = np.eye(len(x)) * 1e-6
        seen.append(np.abs(grad - [(loss(at + e)[0] - loss(at - e)[0]) / 2e-6 for e in eye]).max())
        return x

    monkeypatch.setattr(quality, "minimum", probe)
    quality.fit(rows)
    assert seen[0] < 1e-6


def test_thresholds_are_ordered_and_grades_told_apart():
    rows = [(np.array([k]), np.array([1.0], np.float32), k % 3) for k in range(9)] * 12
    model = quality.fit(rows)
    tails = model.tails(model.weights[:9])
    assert (np.diff(model.thresholds) > 0).all() and (tails[:, 0] >= tails[:, 1]).all()
    grades = (tails > 0.5).sum(axis=1)
    assert grades.tolist() == [0, 1, 2] * 3


def test_odd_rows_and_labels(spark, make_docs):
    rows, labels = made(60)
    rows += [(None, "word1 word2"), (100, None), (101, ""), (5, "again"), (102, "long " * 50_000), (103, "%%%")]
    labels += [(None, 1, 1, "", ""), (1, None, None, "", ""), (2, 0, None, "", ""), (2, 1, None, "", ""), (999, 1, 0, "", "")]
    df = make_docs(rows)
    got = quality.classify(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 and r.kept == (r.tail >= quality.KEEP) for r in got)
    stay = quality.keep_good(df, spark.createDataFrame(labels, LABELS))
    assert stay.columns == df.columns and stay.count() == sum(r.kept for r in got)


@pytest.mark.parametrize("labels", [[], [(0, 1, 0, "", "")]])
def test_without_two_grades_everything_stays(spark, make_docs, labels):
    got = quality.classify(make_docs([(0, "a"), (1, None)]), spark.createDataFrame(labels, LABELS)).collect()
    assert [(r.expected_grade, r.tail, r.kept) for r in got] == [(2.0, 1.0, True)] * 2


def test_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([(0, 1, 0, "", "")], LABELS)
    assert quality.classify(make_docs([]), labels).collect() == []


def test_sample_is_bounded(spark, make_docs):
    rows, labels = made(50)
    twice = make_docs(rows + rows)
    assert quality.graded(twice, spark.createDataFrame(labels, LABELS), bound=7).count() == 7
