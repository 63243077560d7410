import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from accesslens.llm import exact_dedup

ROWS = [
    (1, "a"), (2, "b"), (3, "a"), (4, ""), (5, None), (6, "A"), (7, "a "), (None, "a"), (None, "only"), (None, "only"),
    (8, "x" * 300_000), (9, "x" * 300_000), (10, "é"), (11, "é"), (12, "twice"), (12, "twice"), (None, None),
]


def check(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    kept = defaultdict(int)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in got:
        ids = groups[by_hash[r.text_sha256]]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_groups(make_docs):
    check(ROWS, exact_dedup.report(make_docs(ROWS)).collect())


def test_directory_doubles_and_covers_every_slot(make_docs):
    rows = [(i, f"text {i % 400}") for i in range(1000)]
    index = exact_dedup.build_index(make_docs(rows), capacity=16)
    slots = [r.slot for r in index.directory.collect()]
    assert sorted(slots) == list(range(2**index.depth)) and index.depth >= 5
    sizes = index.entries.groupBy("bucket", "depth").count().collect()
    assert max(r["count"] for r in sizes) <= 16 and sum(r["count"] for r in sizes) == 400
    assert len({r.depth for r in sizes}) > 1  # only overfull buckets split
    check(rows, exact_dedup.report(make_docs(rows), capacity=16).collect())


def test_the_result_comes_through_the_directory(make_docs, monkeypatch):
    """Without the right directory rows find no entry."""
    rows = [(i, f"text {i % 150}") for i in range(400)]
    real = exact_dedup.directory

    def wrong(keys, capacity):
        slots, depth = real(keys, capacity)
        return slots.filter("slot < 3"), depth

    monkeypatch.setattr(exact_dedup, "directory", wrong)
    assert 0 < exact_dedup.report(make_docs(rows), capacity=8).count() < 400
    monkeypatch.setattr(exact_dedup, "directory", lambda keys, capacity: (real(keys, capacity)[0].limit(1).withColumn("slot", F.lit(0).cast("long")), real(keys, capacity)[1]))
    assert exact_dedup.report(make_docs(rows), capacity=8).count() < 400


def test_a_third_of_all_rows_alike(make_docs):
    rows = [(i, f"text {i}") for i in range(2000)] + [(7, "same")] * 600 + [(5000 + i, "same") for i in range(600)] + [(None, "x")] * 300
    check(rows, exact_dedup.report(make_docs(rows), capacity=64).collect())
    assert exact_dedup.keep_one(make_docs(rows)).count() == 2002


def test_hot_keys_are_dealt_over_owners(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT", 10)
    rows = [(i, f"text {i % 50}") for i in range(300)] + [(1000 + i, "hot") for i in range(200)] + [(2000 + i, "") for i in range(100)]
    seen = []
    real = exact_dedup.chains
    monkeypatch.setattr(exact_dedup, "chains", lambda docs, shared, hot: seen.append(len(hot)) or real(docs, shared, hot))
    check(rows, exact_dedup.report(make_docs(rows), capacity=16).collect())
    assert seen == [2]


def test_colliding_keys_form_a_chain(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "hash_key", lambda text: F.length(text).cast("long"))
    rows = [(i, t) for i, t in enumerate(["ab", "cd", "ef", "ab", "x", "cd", "", None])]
    check(rows, exact_dedup.report(make_docs(rows)).collect())
    index = exact_dedup.build_index(make_docs(rows))
    assert sorted(r.chain for r in index.entries.filter("key = 2").collect()) == [1, 2, 3]


def test_keep_one_returns_whole_rows(make_docs):
    df = make_docs(ROWS)
    got = exact_dedup.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect()) == sorted(
        [(False, 2, "b"), (False, 3, "a"), (False, 5, ""), (False, 6, "A"), (False, 7, "a "), (True, 0, "only"),
         (False, 9, "x" * 300_000), (False, 10, "é"), (False, 11, "é"), (False, 12, "twice")]
    )


def test_empty_table(make_docs):
    assert exact_dedup.report(make_docs([])).collect() == [] == exact_dedup.keep_one(make_docs([])).collect()
