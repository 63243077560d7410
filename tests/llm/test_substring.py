import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from accesslens.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in df.collect()), key=repr)


def corpus():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 3)))
    phrase = [word() for _ in range(60)]
    rows = []
    for i in range(30):
        text = [word() for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            a = rng.randint(0, 20)
            text = text[:20] + phrase[a : a + rng.randint(20, 40)] + text[20:]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    rows += [(100, rows[3][1]), (100, rows[3][1]), (101, None), (102, ""), (None, rows[0][1]), (None, None)]
    rows += [(103, "x " * 500), (104, "y " * 60 + "z"), (105, "a b   " * 50)]
    rows += [(106, " ".join(f"w{i}" for i in range(40_000))), (107, " ".join(f"w{i}" for i in range(39_000, 39_034)))]
    return rows


def test_equals_brute_force(make_docs):
    rows = corpus()
    got = substring.deduplicate(make_docs(rows), window=35)
    assert rows_of(got) == brute(rows, 35)


def test_short_windows_and_many_buckets(make_docs, monkeypatch):
    monkeypatch.setattr(substring, "BUCKET", 2000)
    rows = corpus()
    got = substring.deduplicate(make_docs(rows), window=12, gram=4)
    assert rows_of(got) == brute(rows, 12)


def test_a_third_of_all_rows_alike(spark, make_docs, monkeypatch):
    monkeypatch.setattr(substring, "TIMES", 1000)
    long, short = " ".join(f"h{i}" for i in range(90)), "too short to repeat"
    single = corpus() + [(500, long + " and more")]
    hot = [(None, long, 20_000), (None, short, 10_001), (7, long, 3), (8, None, 2)]
    docs = make_docs(single)
    for doc_id, text, times in hot:
        docs = docs.unionByName(make_docs([(doc_id, text)]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("n"))
    rows, alike = substring.rows_once(docs)
    assert alike and rows.count() <= len(single) + 2 * len(hot)
    assert rows.agg(F.sum("times")).first()[0] == len(single) + sum(times for *_, times in hot)
    got = substring.deduplicate(docs, window=35)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    # Two of each say the same as all of them.
    want = brute(single + [(i, text) for i, text, _ in hot for _ in range(2)], 35)
    times = Counter(tuple(r) for r in want)
    for (doc_id, text, n) in hot:
        row = brute([(doc_id, text)] * 2, 35)[0]
        times[row] += n - 2
    assert Counter(map(tuple, got.collect())) == times


def test_empty_table(make_docs):
    assert substring.deduplicate(make_docs([])).collect() == []


def test_overlapping_patterns_are_all_found():
    automaton = substring.Automaton([b"a b c d", b"c d", b"d e f"])
    assert automaton.covered(b"x a b c d e f c c d".split()).tolist() == [
        False, True, True, True, True, True, True, False, True, True,
    ]


def test_hash_collisions_on_one_half_are_told_apart():
    known = np.array([5, 5, 9], np.uint64), np.array([1, 3, 2], np.uint64)
    got = substring.among(np.array([5, 5, 5, 9, 9, 1], np.uint64), np.array([1, 2, 3, 2, 1, 1], np.uint64), known)
    assert got.tolist() == [True, False, True, True, False, False]
