"""Substring de-duplication by repeated-phrase automata.

A window of ``WINDOW`` consecutive words is repeated if its word sequence starts
anywhere else, in the same text or another; every word covered by a repeated
window goes. Windows are judged on the input.

1. Anchors. Of the ``GRAM``-word grams in a window the one with the smallest hash is
   its anchor; equal windows have equal anchors, and neighbouring windows mostly
   share theirs, so there is about one anchor for 13 words. Only windows whose
   anchor occurs twice can repeat; runs of them are the candidate passages.
2. Confirmation. The windows of candidate passages are counted by a 128-bit hash of
   their words, over all texts, combining counts in each task. What is
   counted twice is confirmed; runs of confirmed windows are the recurring passages.
3. Automata. Texts are dealt into buckets of about ``BUCKET`` bytes. For each bucket
   the passages that recur in it are compiled into one Aho-Corasick automaton over
   word numbers: a shard that holds all patterns its texts can contain. Every
   text of the bucket is streamed through it, and all occurrences, overlapping ones
   too, are located by comparing words.

What moves: one number per anchor, the texts twice (to their bucket), and the
windows of candidate passages as hashes. Nothing is collected by anchor, window
or passage, so a passage that a third of all documents share costs no task more
than others; buckets are bounded by their size in bytes (a longer text is a
bucket of its own kind) as rows are dealt by a hash of id and text. Rows alike in both, which
would all be dealt to one bucket, go through the stages as two rows, enough to repeat
each other, and their results are multiplied at the end.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: a null text has no words; texts
shorter than a window lose nothing; rows alike in id and text are repeats of
each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import stored, text_of

WINDOW, GRAM = 35, 10
BUCKET = 2 << 20
GROUP = 600_000  # bytes of texts taken together
SEGMENT = 1 << 18  # bytes hashed at once
TIMES = 1 << 16  # rows alike written by one task at a time
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


BASE = 0xC2B2AE3D27D4EB4F  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, np.uint8)
SPACE[[32, 9, 10, 11, 12, 13]] = 1


@cache
def powers(base: int) -> np.ndarray:
    """base^0, base^1, ... for one segment."""
    out = np.full(SEGMENT + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * BASES[0]
    return x ^ (x >> np.uint64(29))


def rolling(hashes: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """A hash of every n consecutive words."""
    count = len(hashes) - n + 1
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= base
        out += hashes[k : count + k]
    return mixed(out)


def windows_of(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return rolling(hashes, window, BASES[1]), rolling(hashes, window, BASES[2])


def word_hashes(bytes_: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes between edges 0 and 1, 2 and 3, ...: polynomials modulo 2^64.

    They are differences of one running sum, taken segment by segment, so
    memory does not depend on how long a text or word is.
    """
    sums = np.zeros(len(edges), np.uint64)
    back = np.ones(len(edges), np.uint64)
    up, down = powers(BASE), powers(INVERSE)
    full = (1 << 64) - 1
    carry, scale, unscale = np.uint64(0), 1, 1
    for at in range(0, max(1, len(bytes_)), SEGMENT):
        part = bytes_[at : at + SEGMENT]
        running = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * up[: len(part)], out=running[1:])
        running = running * np.uint64(scale) + carry
        last = at + SEGMENT >= len(bytes_)
        a, b = np.searchsorted(edges, [at, at + len(part) + last])
        own = edges[a:b] - at
        sums[a:b] = running[own]
        back[a:b] = down[own] * np.uint64(unscale)
        carry = running[-1]
        scale, unscale = scale * int(up[SEGMENT]) & full, unscale * int(down[SEGMENT]) & full
    return mixed((sums[1::2] - sums[::2]) * back[::2] + (edges[1::2] - edges[::2]).astype(np.uint64))


def leftmost_least(values: np.ndarray, n: int) -> np.ndarray:
    """Place of the first smallest of every n consecutive values, by doubling."""
    at, size = np.arange(len(values)), 1
    while size < n:
        step = min(size, n - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        size += step
    return at


class Words:
    """The words of some texts in a row, as byte ranges and hashes; ``ends[i]`` is where text i ends."""

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join(texts)
        bytes_ = np.frombuffer(self.data, np.uint8)
        edges = np.flatnonzero(np.diff(SPACE[bytes_], prepend=1, append=1))
        self.start, self.stop = edges[::2], edges[1::2]
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.ends = np.searchsorted(self.start, begins[1:])
        self.lengths = np.diff(self.ends, prepend=0)
        self.hashes = word_hashes(bytes_, edges)

    def slice(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` - 1, joined by one space."""
        return b" ".join(self.data[self.start[first] : self.stop[last - 1]].split())

    def runs(self, flags: np.ndarray) -> Iterator[tuple[int, int]]:
        """Maximal ranges of set flags; a flag is for the window that starts at a word, and no
        window of a text is followed by one of the next, so ranges stay inside texts."""
        edges = np.flatnonzero(np.diff(flags.view(np.int8), prepend=0, append=0))
        yield from zip(edges[::2].tolist(), edges[1::2].tolist())

    def valid(self, window: int) -> np.ndarray:
        """Whether the window that starts at a word lies in one text."""
        count = max(0, len(self.hashes) - window + 1)
        return (np.repeat(self.ends, self.lengths)[:count] - np.arange(count)) >= window

    def anchors(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window start: place and hash of its anchor."""
        if len(self.hashes) < window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        grams = rolling(self.hashes, gram, BASES[0])
        at = leftmost_least(grams, window - gram + 1)
        return at, grams[at]


def batched(texts: list[bytes]) -> Iterator[tuple[int, Words]]:
    """Consecutive texts in groups of a bounded number of bytes, or one longer text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP:
            yield first, Words(texts[first:i])
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, Words(texts[first:])


def texts_in(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``anchor``, ``bucket``, ``n``: how often an anchor occurs in some texts of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            for first, words in batched(texts_in(batch.column("text"))):
                at, hashes = words.anchors(window, gram)
                valid = words.valid(window)
                at, hashes = at[valid], hashes[valid]
                # Places rise with the window, so equal places are neighbours.
                new = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
                of = np.repeat(np.arange(len(words.lengths)), words.lengths)
                pairs = np.stack([hashes[new].view(np.int64), buckets[first + of[at[new]]].astype(np.int64)], axis=1)
                rows, n = np.unique(pairs, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[:, 0]), pa.array(rows[:, 1].astype(np.int32)), pa.array(n.astype(np.int64))],
                    ["anchor", "bucket", "n"],
                )

    return docs.select("bucket", "text").mapInArrow(run, "anchor long, bucket int, n long")


def candidate_passages(docs: DataFrame, marks: DataFrame, window: int, gram: int) -> DataFrame:
    """``bucket``, ``passage``: runs of windows whose anchor recurs; ``marks`` (bucket, anchor)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        marked = np.unique(right.column("anchor").to_numpy().view(np.uint64)) if right.num_rows else np.zeros(0, np.uint64)
        found: list[bytes] = []
        if len(marked):
            for _, words in batched(texts_in(left.column("text"))):
                _, hashes = words.anchors(window, gram)
                valid = words.valid(window)
                hit = np.isin(hashes, marked) & valid
                found += [words.slice(a, b + window - 1) for a, b in words.runs(hit)]
        bucket = (left if left.num_rows else right).column("bucket")[0].as_py()
        return pa.table({"bucket": pa.array([bucket] * len(found), pa.int32()), "passage": pa.array(found).cast(pa.string()) if found else pa.array([], pa.string())})

    both = docs.select("bucket", "text").groupBy("bucket").cogroup(marks.groupBy("bucket"))
    return both.applyInArrow(run, "bucket int, passage string")


def window_rows(passages: DataFrame, window: int) -> DataFrame:
    """``h1``, ``h2``, ``bucket``, ``n``: the windows of candidate passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            for first, words in batched(texts_in(batch.column("passage"))):
                h1, h2 = windows_of(words.hashes, window)
                valid = words.valid(window)
                of = np.repeat(np.arange(len(words.lengths)), words.lengths)[: len(valid)][valid]
                keyed = np.empty(len(of), [("a", "<i8"), ("b", "<i8"), ("c", "<i4")])
                keyed["a"], keyed["b"], keyed["c"] = h1[valid].view(np.int64), h2[valid].view(np.int64), buckets[first + of]
                order = np.lexsort((keyed["c"], keyed["b"], keyed["a"]))
                keyed = keyed[order]
                new = np.concatenate([[True], keyed[1:] != keyed[:-1]])
                n = np.diff(np.concatenate([np.flatnonzero(new), [len(keyed)]]))
                rows = keyed[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["a"].copy()), pa.array(rows["b"].copy()), pa.array(rows["c"].copy()), pa.array(n)],
                    ["h1", "h2", "bucket", "n"],
                )

    return passages.mapInArrow(run, "h1 long, h2 long, bucket int, n long")


def among(h1: np.ndarray, h2: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each pair is one of the known pairs, which are sorted."""
    k1, k2 = known
    found = np.zeros(len(h1), bool)
    at = np.searchsorted(k1, h1)
    open_ = np.arange(len(h1))
    while len(open_):
        inside = at < len(k1)
        open_, at = open_[inside], at[inside]
        same = k1[at] == h1[open_]
        open_, at = open_[same], at[same]
        found[open_] |= k2[at] == h2[open_]
        at = at + 1
    return found


def recurring_passages(passages: DataFrame, confirmed: DataFrame, window: int) -> DataFrame:
    """``bucket``, ``passage``: distinct runs of confirmed windows; ``confirmed`` (bucket, h1, h2)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: set[bytes] = set()
        if right.num_rows:
            k1, k2 = (right.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            order = np.lexsort((k2, k1))
            known = k1[order], k2[order]
            for _, words in batched(texts_in(left.column("passage"))):
                h1, h2 = windows_of(words.hashes, window)
                hit = among(h1, h2, known) & words.valid(window)
                found |= {words.slice(a, b + window - 1) for a, b in words.runs(hit)}
        bucket = (left if left.num_rows else right).column("bucket")[0].as_py()
        rows = sorted(found)
        return pa.table({"bucket": pa.array([bucket] * len(rows), pa.int32()), "passage": pa.array(rows).cast(pa.string()) if rows else pa.array([], pa.string())})

    both = passages.groupBy("bucket").cogroup(confirmed.groupBy("bucket"))
    return both.applyInArrow(run, "bucket int, passage string")


class Automaton:
    """Aho-Corasick over word numbers; words of no pattern are 0."""

    def __init__(self, patterns: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for pattern in patterns:
            words = pattern.split()
            self.matcher.add_word(tuple(self.number.setdefault(w, len(self.number) + 1) for w in words), len(words))
        self.empty = not patterns
        if patterns:
            self.matcher.make_automaton()

    def covered(self, words: list[bytes]) -> np.ndarray:
        """Whether each word lies in an occurrence of a pattern."""
        deltas = np.zeros(len(words) + 1, np.int64)
        if not self.empty and words:
            number = self.number.get
            for end, size in self.matcher.iter(tuple([number(w, 0) for w in words])):
                deltas[end - size + 1] += 1
                deltas[end + 1] -= 1
        return np.cumsum(deltas[:-1]) > 0


def located(docs: DataFrame, passages: DataFrame, texts: bool) -> DataFrame:
    """Every text of a bucket through the bucket's automaton; ``docs`` (doc_id, text, times, bucket)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        automaton = Automaton(texts_in(right.column("passage")))
        counts, removed, digests, kept = [], [], [], []
        for text in texts_in(left.column("text")):
            words = text.split()
            gone = automaton.covered(words)
            stay = b" ".join(compress(words, (~gone).tolist()) if gone.any() else words)
            counts.append(len(words))
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(stay).hexdigest())
            if texts:
                kept.append(stay)
        columns = {
            "doc_id": left.column("doc_id"),
            "times": left.column("times"),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        if texts:
            columns["kept"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(columns)

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, times long, n_words long, n_removed long, kept_sha256 string"
    both = docs.groupBy("bucket").cogroup(passages.groupBy("bucket"))
    return both.applyInArrow(run, kind + (", kept string" if texts else ""))


def rows_once(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc_id``, ``text``, ``times``, and whether any rows are alike: of rows alike in id and text two are
    left, the second standing for all but one of them."""
    text = text_of(docs)
    rows = docs.select("doc_id", text.alias("text"), F.lit(1).cast("long").alias("times"))
    keyed = rows.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))
    several = keyed.groupBy("doc_id", "h", "size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = stored(several.select(F.col("doc_id").alias("d"), "h", "size"), "several")
    if several.isEmpty():
        return rows, False
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("h")) & (F.octet_length("text") == F.col("size"))
    # Combined in each task first, so a text moves once per task however many rows have it.
    found = rows.join(several, same, "left_semi").groupBy("doc_id", "text").agg(F.sum("times").alias("n"))
    # Texts that only share a hash are counted apart here, and may turn out to be single.
    times = F.when(F.col("n") > 1, F.array(F.lit(1).cast("long"), F.col("n") - 1)).otherwise(F.array("n"))
    found = stored(found.select("doc_id", "text", F.explode(times).alias("times")), "alike")
    return rows.join(several, same, "left_anti").unionAll(found), True


def multiplied(found: DataFrame) -> DataFrame:
    """Every row as often as ``times`` says, in pieces of ``TIMES`` rows spread over the tasks."""
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {TIMES}"))).alias("piece")
    many = found.filter("times > 1").select("*", pieces).repartition("doc_id", "kept_sha256", "piece")
    last = F.least(F.lit(TIMES).cast("long"), F.col("times") - F.col("piece") * TIMES)
    many = many.select("*", F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("one"))
    return found.filter("times = 1").unionAll(many.select(found.columns))


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked
    for, ``kept``: the words that stay, joined by one space."""
    rows, alike = rows_once(docs)
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))

    anchors = stored(anchor_rows(dealt, window, gram), "anchors")
    twice = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    marks = stored(anchors.join(stored(twice, "twice"), "anchor").select("bucket", "anchor").distinct(), "marks")
    passages = stored(candidate_passages(dealt, marks, window, gram), "candidates")

    windows = window_rows(passages, window)
    repeated = windows.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2")
    confirmed = stored(windows.drop("n").join(stored(repeated, "repeated"), ["h1", "h2"]).select("bucket", "h1", "h2"), "confirmed")
    recurring = stored(recurring_passages(passages, confirmed, window), "recurring")
    found = located(dealt, recurring, texts)
    return (multiplied(stored(found, "located")) if alike else found).drop("times")
