import math
import random
import re
from collections import Counter

from accesslens.llm import ranked

ITEM = "item_id long, text string, m int, w string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(found[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], ITEM)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    lengths = [rng.choice([1, 3, 10, 10, 10, 40, 200]) for _ in range(n)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=length))) for i, length in enumerate(lengths)]


def test_equals_brute_force_over_many_blocks(spark, make_docs):
    docs = corpus(1, 400)
    items = [(i, " ".join(random.Random(i).sample([f"w{j}" for j in range(70)], 12))) for i in range(12)]
    got = found(ranked.ranked(make_docs(docs), items_frame(spark, items), k=20, postings=64))
    assert got == brute(docs, items, 20)


def test_one_length_and_one_text_hold_most_rows(spark, make_docs):
    docs = [(i, "same words here") for i in range(300)] + corpus(2, 100) + [(400 + i, "other words there") for i in range(200)]
    items = [(1, "same words"), (2, "words"), (3, "there w1 w2")]
    got = found(ranked.ranked(make_docs(docs), items_frame(spark, items), k=50, postings=100))
    assert got == brute(docs, items, 50)


def test_odd_rows(spark, make_docs):
    docs = [
        (1, None), (2, ""), (3, " ., "), (4, "A-b a"), (None, "a b"), (None, "a b"), (5, "a b"), (5, "a b"),
        (6, "É é ÀB"), (7, "x" * 5000 + " a"), (8, "a " * 5000), (9, "12 12,12"), (10, "kK K"),
    ]
    items = [(0, "a B"), (0, "zz"), (1, None), (2, ""), (None, "a"), (3, "é"), (4, "12"), (5, "nothing"), (6, "k K àb"), (0, "a B")]
    got = found(ranked.ranked(make_docs(docs), items_frame(spark, items), k=5, postings=4))
    assert got == brute(docs, items, 5)


def test_a_term_in_every_document_weighs_nothing(spark, make_docs):
    docs = [(i, "all" + (" some" if i % 2 else "")) for i in range(1200)]
    items = [(1, "all"), (2, "some all")]
    got = found(ranked.ranked(make_docs(docs), items_frame(spark, items)))
    assert got == brute(docs, items)


def test_an_index_of_all_terms_gives_the_same(spark, make_docs):
    docs = corpus(3, 150)
    items = items_frame(spark, [(1, "w1 w5 w50"), (2, "w3")])
    asked = ranked.item_terms(items)
    whole = ranked.Index(make_docs(docs), postings=50)
    assert found(ranked.search(whole, asked, 7)) == found(ranked.ranked(make_docs(docs), items, 7))
    assert whole.held.count() == len({t for _, x in docs for t in terms(x)})


def test_bounds_leave_blocks_unvisited(spark, make_docs, monkeypatch):
    docs = [(i, f"rare common {'filler ' * (i % 7)}") for i in range(70)] + [(100 + i, "common " + "filler " * (50 + i)) for i in range(300)]
    items = [(1, "rare common")]
    sent = []
    visited = ranked.visited
    monkeypatch.setattr(ranked, "visited", lambda index, visits, k: sent.append(visits.count()) or visited(index, visits, k))
    index = ranked.Index(make_docs(docs), postings=40)
    got = found(ranked.search(index, ranked.item_terms(items_frame(spark, items)), 5))
    assert got == brute(docs, items, 5)
    assert sum(sent) < index.blocks.count()


def test_empty_tables(spark, make_docs):
    assert found(ranked.ranked(make_docs([]), items_frame(spark, [(1, "a")]))) == []
    assert found(ranked.ranked(make_docs([(1, "a")]), items_frame(spark, []))) == []
