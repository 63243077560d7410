import random
from collections import Counter

import corpus_pipeline
from accesslens.llm import queries

LABELS = "doc_id long, quality int, toxic int, text string, grade string"

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(folder, spark):
    rng = random.Random(9)
    words = [f"Word{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(240):
        text = [rng.choice(words) for _ in range(rng.randint(30, 150))]
        grade = (2, 2, 2, 0, 1)[i % 5]
        if grade == 0:
            text = [w + "$$$" for w in text]
        if grade == 1:
            text[3:3] = ["vile", "nasty", "rotten"]
        rows.append((i, " ".join(text), "en", "hot" if i % 3 else f"s{i % 4}", None))
        labels.append((i, int(grade > 0), int(grade == 1), "", ""))
    rows += [(1000 + i, rows[0][1], "en", "hot", 1) for i in range(50)] + [(2000, rows[1][1].upper(), None, None, 2)]
    rows += [(3000, None, None, None, None), (3001, "", None, "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return rows, labels


def test_stages_take_effect(spark, tmp_path):
    folder = str(tmp_path)
    rows, labels = corpus(folder, spark)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}.parquet")
        docs = spark.read.parquet(f"{folder}/{name}.parquet")
        kept[name] = docs.collect()
        if name != "subword":
            assert docs.columns == COLUMNS
    grade = {i: q + (q and not t) for i, q, t, *_ in labels}
    first = {r.doc_id for r in kept["quality"]}
    assert {i for i, g in grade.items() if g == 2} <= first
    assert not first & {i for i, g in grade.items() if g == 0} and not first & {i for i, g in grade.items() if g == 1}
    texts = Counter(r.text or "" for r in kept["exact_dedup"])
    assert set(texts) == {r.text or "" for r in kept["quality"]} and set(texts.values()) == {1}
    assert 1049 in {r.doc_id for r in kept["exact_dedup"]}
    near = {r.doc_id for r in kept["near_dedup"]}
    assert 1 in near and 2000 not in near  # differ in capitals only
    times = Counter(r.doc_id for r in kept["mixing"])
    assert set(times) <= near and max(times.values()) <= 3
    assert Counter(r.doc_id for r in kept["subword"]) == times and all(r.lossless for r in kept["subword"])


def test_run_is_the_stages_in_a_row(spark, tmp_path):
    folder = str(tmp_path)
    corpus(folder, spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(str, docs.collect())) == sorted(map(str, corpus_pipeline.run(spark, folder).collect()))


def test_no_documents(spark, tmp_path):
    folder = str(tmp_path)
    corpus(folder, spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_one_query_per_operator():
    numbers = [name.split("_")[0] for name in queries.QUERIES]
    assert numbers == [f"op{n}" for n in range(1, 14)]
