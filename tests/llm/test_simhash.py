import random
import re
from itertools import combinations

import numpy as np
import xxhash

from accesslens.llm import golay, simhash
from accesslens.llm.components import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(40):
        base = [f"W{rng.randint(0, 400)}É" for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            rows.append((1000 - len(rows), rng.choice([" ", "\n"]).join(copy)))
    rows += [(5, ""), (4, None), (6, " \t"), (7, "one"), (8, "ONE"), (9, "one two"), (9, "one two"), (None, "one")]
    rows += [(10, "long " * 30_000), (11, "KK  x")]
    return rows


def test_equals_brute_force(make_docs):
    rows = corpus()
    got = simhash.near_duplicates(make_docs(rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    root = roots(range(len(rows)), links)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]] = min(doc_id, least.get(root[i], doc_id))
    want = [(d, f"{prints[i]:016x}", least.get(root[i])) for i, (d, _) in enumerate(rows)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)


def test_links_lose_no_pair_in_dense_groups(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(8):
        base = rng.getrandbits(64)
        values |= {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    want = {tuple(sorted((a, b))) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert len(got) == len(want) and {(r.u, r.v) for r in got} == want


def test_golay_code():
    rng = np.random.default_rng(1)
    info = np.arange(4096) << golay.CHECKS
    codewords = info | golay.remainders(info)
    words = rng.integers(0, 1 << 23, 500)
    distance = np.bitwise_count(words[:, None] ^ codewords[None, :])
    assert distance.min(axis=1).max() <= 3  # perfect
    near = golay.nearby(words)
    for w, d in zip(near, distance):
        assert sorted(w[w >= 0].tolist()) == np.flatnonzero(d <= 4).tolist() if (d == 3).any() else d.min() < 3
    for bit in range(23):  # one differing bit: a shared index
        other = golay.nearby(words ^ (1 << bit))
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(near, other))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 40)] + [(139, 100)]
    edges = [(b, a) if (a + b) % 3 else (a, b) for a, b in chain + star + chain[:5]]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {n: r for n, r in roots({x for e in edges for x in e}, edges).items() if n != r}
    assert got == want


def test_keep_one(make_docs):
    rows = [(3, "same text here now"), (2, "same text here now"), (None, "same text here now"), (9, "other words"), (None, "alone")]
    df = make_docs(rows)
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(
        map(str, [(2, "same text here now"), (9, "other words"), (None, "alone")])
    )


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == [] == simhash.keep_one(make_docs([])).collect()
