"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades are ordered: 0 for poor text, 1 for good text that is toxic, 2 for good
text. One weight per hashed feature is shared by all thresholds:
``P(grade >= k) = sigmoid(w . x - theta_k)`` with theta_1 <= theta_2. A document
gets its expected grade and the tail probability ``P(grade >= 2)``; selection
keeps those whose tail probability reaches ``KEEP``.

Features of the whole text, hashed to 2^22 places: its distinct words without
surrounding punctuation, in lower case, and their beginnings; the punctuation that surrounds words,
by share of words; capitals, repeats and length by share or size class.

The fit uses at most ``SAMPLE`` labelled documents, those whose ids have the
smallest hashes; that bound also bounds the one task which fits (L-BFGS
from zero, rows in id order: reruns agree).

Defined cases: a null text is empty; an empty text has only its length class;
labels without quality are ignored, toxic null is 0, several labels of one
document count as their worst; without labels everything is kept with grade 2;
null and repeated ids are scored row by row; other columns are carried along.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import stored, text_of

PLACES = 1 << 22
BEGINNINGS = (4, 5)  # code points
SAMPLE = 10_000
ROUNDS = 150
# Labelled documents that must have a feature, and how surely and strongly it must tell grades apart.
LEAST, Z, STRONG = 3, 5.0, 0.3
PENALTY = 1e-5
KEEP = 0.9
TOP = 2
CACHED = 150_000
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Places(dict):
    """Word to (places of its core and beginnings, its surrounding punctuation, all capitals); bounded."""

    def __missing__(self, word: str) -> tuple[tuple[int, ...], str, bool]:
        core = word.strip(EDGE)
        start = word.find(core) if core else len(word)
        edge = word[:start] + "_" + word[start + len(core) :] if core else word
        low = core.lower()
        names = [f"w:{low}", *(f"b:{low[:n]}" for n in BEGINNINGS if len(low) > n)] if core else []
        found = (tuple(map(place, names)), edge, len(core) > 1 and core.isupper())
        if len(self) >= CACHED:
            self.clear()
        self[word] = found
        return found


def place(name: str) -> int:
    return xxhash.xxh64_intdigest(name, 1) % PLACES


PLACES_OF = Places()
SHARES = ("capitals", "repeats", "edges")
GENERAL = [place(f"s:{s}") for s in SHARES] + [place(f"s:{s}:{k}") for s in SHARES for k in range(11)]
GENERAL += [place(f"n:{k}") for k in range(64)]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places (distinct) and values."""
    words = text.split()
    n = len(words)
    times = Counter(words)
    found: dict[int, float] = {}
    edges: Counter[str] = Counter()
    capitals = 0
    for (own, edge, upper), k in zip(map(PLACES_OF.__getitem__, times), times.values()):
        for at in own:
            found[at] = 1.0
        if upper:
            capitals += k
        if edge != "_":
            edges[edge] += k
    for edge, k in edges.items():
        at = place(f"e:{edge}")
        found[at] = found.get(at, 0.0) + 4 * k / n
    if n:
        for name, share in zip(SHARES, (capitals / n, 1 - len(times) / n, edges.total() / n)):
            for at, value in ((place(f"s:{name}:{int(share * 10)}"), 1.0), (place(f"s:{name}"), 4 * share)):
                found[at] = found.get(at, 0.0) + value
    at = place(f"n:{n.bit_length()}")
    found[at] = found.get(at, 0.0) + 1.0
    return np.fromiter(found, np.int32, len(found)), np.fromiter(found.values(), np.float32, len(found))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # one per grade above 0

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... as columns."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], top: int = TOP) -> Model:
    """Maximum likelihood of ``P(y = k) = P(y >= k) - P(y >= k + 1)`` with a quadratic penalty.

    The thresholds are a first one and gaps of exp(g), so they stay ordered.
    Features that do not go along with a grade keep weight 0: rare words would only learn the sample by heart.
    """
    weights = np.zeros(PLACES)
    grades = np.array([g for _, _, g in rows], np.int64)
    if len(set(grades.tolist())) < 2:
        return Model(weights, np.full(top, -1e9 if not rows or grades[0] == top else 1e9))
    places, column = np.unique(np.concatenate([p for p, _, _ in rows]), return_inverse=True)
    values = np.concatenate([v for _, v, _ in rows])
    of = np.repeat(np.arange(len(rows), dtype=np.int32), [len(p) for p, _, _ in rows])
    n, here = len(rows), np.arange(len(rows))
    telling = correlated(column, values, of, grades, np.isin(places, GENERAL), top)
    used, kept = places[telling], telling[column]
    column, values, of = (np.cumsum(telling) - 1)[column[kept]], values[kept].astype(np.float64), of[kept]
    m = len(used)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, first, gaps = x[:m], x[m], x[m + 1 :]
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        scores = np.bincount(of, w[column] * values, n)
        tails = sigmoid(scores[:, None] - thresholds[None, :])
        edged = np.concatenate([np.ones((n, 1)), tails, np.zeros((n, 1))], axis=1)
        upper, lower = edged[here, grades], edged[here, grades + 1]
        likely = np.maximum(upper - lower, 1e-12)
        # For logistic links d log P / d score is 1 - upper - lower.
        d_w = np.bincount(column, ((upper + lower - 1) / n)[of] * values, m) + PENALTY * w
        steep = tails * (1 - tails)
        d_theta = np.array(
            [((grades == k + 1).astype(float) - (grades == k)) @ (steep[:, k] / likely) for k in range(top)]
        ) / n
        d_gaps = [d_theta[k + 1 :].sum() * np.exp(gaps[k]) for k in range(top - 1)]
        value = -np.log(likely).mean() + PENALTY / 2 * (w @ w)
        return value, np.concatenate([d_w, [d_theta.sum()], d_gaps])

    x = minimum(loss, np.zeros(m + top))
    weights[used] = x[:m]
    return Model(weights, x[m] + np.concatenate([[0.0], np.cumsum(np.exp(x[m + 1 :]))]))


def correlated(
    column: np.ndarray, values: np.ndarray, of: np.ndarray, grades: np.ndarray, general: np.ndarray, top: int
) -> np.ndarray:
    """Columns that tell some ``grade >= k`` apart: their correlation is ``Z`` standard errors from
    none, and among the texts that have them the share of such grades is off by ``STRONG``.

    Common words that hardly tell are so left out: long texts have most of them, and their sum would
    drown the few words that do. Shares and sizes (``general``) need the first test alone.
    """
    n, m = len(grades), len(general)
    often = np.bincount(column, minlength=m)
    mean = np.bincount(column, values, m) / n
    spread = np.sqrt(np.maximum(np.bincount(column, values**2, m) / n - mean**2, 1e-12))
    telling = np.zeros(m, bool)
    for k in range(1, top + 1):
        y = (grades >= k).astype(np.float32)
        if 0 < y.mean() < 1:
            along = np.bincount(column, values * y[of], m) / n - mean * y.mean()
            sure = np.abs(along) / (spread * y.std()) * np.sqrt(n) >= Z
            share = np.bincount(column, y[of], m) / often
            telling |= sure & (general | (np.abs(share - y.mean()) >= STRONG))
    return telling & (often >= LEAST)


def minimum(loss, x: np.ndarray, rounds: int = ROUNDS, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving."""
    value, grad = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, scales = -grad, []
        for s, y in reversed(pairs):
            scales.append((s @ way) / (s @ y))
            way = way - scales[-1] * y
        if pairs:
            s, y = pairs[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), scale in zip(pairs, reversed(scales)):
            way = way + (scale - (y @ way) / (s @ y)) * s
        slope, step = grad @ way, 1.0
        while step > 1e-8:
            there, grad_there = loss(x + step * way)
            if there <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = step * way, grad_there - grad
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory :], (s, y)]
        done = value - there < 1e-7
        x, value, grad = x + s, there, grad_there
        if done:
            break
    return x


def graded(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """Up to ``bound`` labelled documents: ``doc_id``, ``text``, ``grade``."""
    grade = F.when(F.col("quality") < 1, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    worst = usable.select("doc_id", grade.alias("grade")).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # Rows of one id count once, so the bound also holds for the documents.
    rows = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("grade"),
                    pa.array([p.tolist() for p, _ in found], pa.list_(pa.int32())),
                    pa.array([v.tolist() for _, v in found], pa.list_(pa.float32())),
                ],
                ["doc_id", "grade", "places", "values"],
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (np.array(p.values, np.int32), np.array(v.values, np.float32), g.as_py())
            for batch in batches
            for p, v, g in zip(batch.column("places"), batch.column("values"), batch.column("grade"))
        ]
        model = fit(rows)
        used = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([used.tolist()]), pa.array([model.weights[used].tolist()]), pa.array([model.thresholds.tolist()])],
            ["places", "weights", "thresholds"],
        )

    rows = graded(docs, labels, bound)
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, grade int, places array<int>, values array<float>"
    sample = stored(rows.mapInArrow(extract, kind), "graded")
    one = sample.repartition(1).sortWithinPartitions("doc_id")
    found = one.mapInArrow(fitted, "places array<long>, weights array<double>, thresholds array<double>").first()
    weights = np.zeros(PLACES)
    if found is None:
        return Model(weights, np.full(TOP, -1e9))
    weights[np.array(found.places, np.int64)] = found.weights
    return Model(weights, np.array(found.thresholds))


def scored(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``expected_grade``, ``tail``, ``kept``."""
    used = np.flatnonzero(model.weights)
    shared = docs.sparkSession.sparkContext.broadcast((used, model.weights[used], model.thresholds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, own, thresholds = shared.value
        weights = np.zeros(PLACES, np.float32)
        weights[used] = own
        for batch in batches:
            row = batch.column("row")
            scores = np.zeros(batch.num_rows)
            for k, t in enumerate(row.field("text")):
                places, values = features(t.as_py() or "")
                scores[k] = weights[places] @ values
            tails = sigmoid(scores[:, None] - thresholds[None, :])
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep)],
                ["row", "expected_grade", "tail", "kept"],
            )

    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = packed.select("row", F.lit(0.0).alias("expected_grade"), F.lit(0.0).alias("tail"), F.lit(True).alias("kept")).schema
    return packed.mapInArrow(score, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``expected_grade``, ``tail``, ``kept``."""
    model = train(docs, labels)
    slim = docs.select("doc_id", "text")
    return scored(slim, model).select(F.col("row.doc_id").alias("doc_id"), "expected_grade", "tail", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with the columns of ``docs``."""
    model = train(docs, labels)
    return scored(docs, model).filter("kept").select("row.*")
