"""Ranked lexical search over a length-stratified index.

A document's score for an item sums ``w * ((1000000000 * tf) div (1000 * tf + 20 * m))``
over the item's terms, where ``w`` falls with the number of documents that hold the
term and the normaliser ``m`` grows with the document's length. Documents of equal
``m`` form a stratum, and in a stratum the score of a term depends on ``tf`` alone.

1. Terms are counted once per text and written, with the text's length. Asked for
   with the items, only terms that an item may hold are kept: a bitmap of ``BITS``
   bits, whatever the number of items, tells them; a wrong yes costs a posting.
2. Index. Strata are cut into blocks of about ``POSTINGS`` postings, documents dealt
   by their row, so a length that a third of all documents share is spread like any
   other. A block holds its documents by id, and per term its postings by falling tf.
3. Bounds. A term's highest tf in a block bounds its impact there; summed over an
   item's terms that bounds every score of the block.
4. Visits. An item first visits the blocks with its ``FIRST`` highest bounds (those
   that can fill all its ranks before smaller ones); the k-th score found is a floor
   for the whole table. Then it visits every other block whose bound reaches the
   floor. In a block the impacts are computed once per tf and added up per document.

What moves: kept postings once to their block, and per visit the block and the
item. A task holds one block; its items come in a stream after it.

Terms are maximal runs of digits, letters and characters beyond ASCII, only A-Z
lower-cased. Defined cases: a null text has no terms; documents without terms
count nowhere; rows alike are documents of their own, each with its rank; a null
``doc_id`` ranks behind others of its score; rows of one ``item_id`` make one item,
items without an id take no part; scores of 0 are no results; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import stored, text_of
from accesslens.operators.select import top_per_group

BITS = 1 << 23  # of the bitmap of terms: a megabyte
POSTINGS = 1 << 18  # per block, on average
FIRST = 4  # blocks of an item's first visit

# Bytes of UTF-8: digits, letters and what is beyond ASCII stay, the rest parts terms.
TERMS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

BLOCK = "struct<ids:array<long>,terms:array<string>,ends:array<int>,tfs:array<int>,tf_ends:array<int>,places:array<int>>"


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(TERMS).split()


def term_counts(rows: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """``rows`` (_text and others): instead of the text ``n`` (its terms with repeats), ``terms`` and ``tfs``.

    ``wanted``: a bitmap of the checksums of the terms that are kept.
    """
    others = [f for f in rows.schema.fields if f.name != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                yield counts_of(part)

    def counts_of(part: pa.RecordBatch) -> pa.RecordBatch:
        n, ends, terms, tfs = [], [0], [], []
        for text in part.column("_text"):
            found = terms_of(text.as_py())
            n.append(len(found))
            counts = Counter(found)
            if wanted is not None:
                counts = {t: c for t, c in counts.items() if wanted[(h := crc32(t) % BITS) >> 3] >> (h & 7) & 1}
            terms.extend(counts)
            tfs.extend(counts.values())
            ends.append(len(terms))
        offsets = pa.array(ends, pa.int32())
        columns = {f.name: part.column(f.name) for f in others} | {
            "n": pa.array(n, pa.int64()),
            "terms": pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
            "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
        }
        return pa.RecordBatch.from_pydict(columns)

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    return rows.mapInArrow(run, f"{kind}, n long, terms array<string>, tfs array<int>")


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id``, ``term``: the distinct terms of each item."""
    rows = items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), text_of(items).alias("_text"))
    return term_counts(rows).select("item_id", F.explode("terms").alias("term")).distinct()


def bitmap_of(terms: DataFrame) -> bytes:
    """A bit per checksum of a term; its size does not depend on how many there are."""
    at = F.pmod(F.crc32("term"), F.lit(BITS)) + 1
    parts = (
        terms.groupBy(F.bitmap_bucket_number(at).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .collect()  # of BITS / 32768 rows at most
    )
    whole = bytearray(BITS // 8)
    for part in parts:
        start = (part["part"] - 1) * 4096
        whole[start : start + len(part["bits"])] = part["bits"]
    return bytes(whole)


class Index:
    """Blocks (``m``, ``part``, ``block``), and per term the number of documents that hold it."""

    def __init__(self, docs: DataFrame, items: DataFrame | None = None, postings: int = POSTINGS):
        """``docs`` (doc_id, text); with ``items`` (item_id, term) only what these may hold is indexed."""
        wanted = None if items is None else bitmap_of(items)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(docs).alias("_text"))
        counted = stored(term_counts(rows, wanted).filter("n > 0"), "counted")
        total = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        self.docs, self.terms = total["docs"], total["terms"] or 1
        m = F.expr(f"50L + ((50L * n * {self.docs}L) div {self.terms}L)")
        kept = counted.filter("size(terms) > 0").withColumn("m", m)
        self.held = kept.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        strata = kept.groupBy("m").agg(F.ceil(F.sum(F.size("terms")) / F.lit(postings)).alias("parts"))
        dealt = kept.join(strata, "m").withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int"))
        self.blocks = stored(blocks_of(dealt), "blocks")


def blocks_of(dealt: DataFrame) -> DataFrame:
    """The inverted form of each (m, part): terms, for each its tfs falling, for each tf the documents by id."""

    def inverted(m: int, part: int, ids: list, terms: list[np.ndarray], tfs: list[np.ndarray]) -> pa.RecordBatch:
        sizes = [len(t) for t in tfs]
        place = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        words, number = np.unique(np.concatenate(terms), return_inverse=True)
        tf = np.concatenate(tfs)
        order = np.lexsort((place, -tf, number))
        number, tf, place = number[order], tf[order], place[order]
        new_term = np.diff(number) != 0
        new_tf = np.flatnonzero(new_term | (np.diff(tf) != 0)) + 1
        starts = np.concatenate([[0], new_tf])
        block = {
            "ids": ids,
            "terms": words.tolist(),
            "ends": np.append(np.searchsorted(starts, np.flatnonzero(new_term) + 1), len(starts)).astype(np.int32),
            "tfs": tf[starts].astype(np.int32),
            "tf_ends": np.append(new_tf, len(place)).astype(np.int32),
            "places": place,
        }
        kinds = {"ids": pa.int64(), "terms": pa.string()}
        fields = {c: pa.array([v], pa.list_(kinds.get(c, pa.int32()))) for c, v in block.items()}
        packed = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        best = pa.array([tf[starts[np.concatenate([[0], block["ends"][:-1]])]]], pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(
            {"m": pa.array([m], pa.int64()), "part": pa.array([part], pa.int32()), "docs": pa.array([len(ids)], pa.int32()),
             "terms": fields["terms"], "best": best, "block": packed}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, terms, tfs = None, [], [], []
        for batch in batches:
            ms, parts = batch.column("m").to_numpy(), batch.column("part").to_numpy()
            words, counts, names = batch.column("terms"), batch.column("tfs"), batch.column("doc_id").to_pylist()
            cuts = np.flatnonzero(np.diff(ms) | np.diff(parts)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ms)]):
                if a == b:
                    continue
                if at and at != (ms[a], parts[a]):
                    yield inverted(*at, ids, terms, tfs)
                    ids, terms, tfs = [], [], []
                at = ms[a], parts[a]
                ids += names[a:b]
                terms.append(words.slice(a, b - a).flatten().to_numpy(zero_copy_only=False))
                tfs += [counts[i].values.to_numpy() for i in range(a, b)]
        if at:
            yield inverted(*at, ids, terms, tfs)

    rows = dealt.select("m", "part", "doc_id", "row", "terms", "tfs").repartition("m", "part")
    rows = rows.sortWithinPartitions("m", "part", F.col("doc_id").asc_nulls_last(), "row").drop("row")
    return rows.mapInArrow(run, f"m long, part int, docs int, terms array<string>, best array<int>, block {BLOCK}")


def impact(tf: str, m: str) -> str:
    return f"((1000000000L * {tf}) div (1000L * {tf} + 20L * {m}))"


class Opened:
    """A block in a task, its impacts computed once per tf."""

    def __init__(self, m: int, block: dict):
        self.m, self.ids = m, block["ids"]
        tfs = np.array(block["tfs"], np.int64)
        tf_ends = np.array(block["tf_ends"], np.int64)
        self.places = np.array(block["places"], np.int64)
        impacts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)
        self.impacts = np.repeat(impacts, np.diff(tf_ends, prepend=0))
        ends = np.concatenate([[0], tf_ends[np.array(block["ends"], np.int64) - 1]]).tolist()
        self.postings = {t: (a, b) for t, a, b in zip(block["terms"], ends, ends[1:])}

    def best(self, terms: list[str], weights: list[int], floor: int, k: int) -> list[tuple[int | None, int]]:
        """Up to k (doc_id, score) that reach the floor, best first."""
        scores = np.zeros(len(self.ids), np.int64)
        for term, weight in zip(terms, weights):
            if term in self.postings:
                a, b = self.postings[term]
                scores[self.places[a:b]] += weight * self.impacts[a:b]
        at = np.flatnonzero(scores >= max(floor, 1))
        if len(at) > k:
            kth = np.partition(scores[at], -k)[-k]
            at = at[scores[at] >= kth]
        at = at[np.argsort(-scores[at], kind="stable")][:k]  # places go by id
        return [(self.ids[i], int(scores[i])) for i in at]


def visited(index: Index, visits: DataFrame, k: int) -> DataFrame:
    """``visits`` (m, part, item_id, terms, weights, floor): each item's k best of the blocks it visits."""
    wanted = index.blocks.join(visits.select("m", "part").distinct(), ["m", "part"], "left_semi")
    blocks = wanted.select(
        "m", "part", F.lit(0).alias("kind"), "block", F.lit(None).cast("long").alias("item_id"),
        F.lit(None).cast("array<string>").alias("terms"), F.lit(None).cast("array<long>").alias("weights"),
        F.lit(None).cast("long").alias("floor"),
    )
    asked = visits.select("m", "part", F.lit(1).alias("kind"), F.lit(None).cast(BLOCK).alias("block"), "item_id", "terms", "weights", "floor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None
        for batch in batches:
            items, docs, scores = [], [], []
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                if kind == 0:
                    opened = Opened(batch.column("m")[i].as_py(), batch.column("block")[i].as_py())
                    continue
                item, floor = batch.column("item_id")[i].as_py(), batch.column("floor")[i].as_py()
                terms, weights = batch.column("terms")[i].as_py(), batch.column("weights")[i].as_py()
                for doc, score in opened.best(terms, weights, floor, k):
                    items.append(item)
                    docs.append(doc)
                    scores.append(score)
                if len(items) > 1 << 16:
                    yield answers(items, docs, scores)
                    items, docs, scores = [], [], []
            yield answers(items, docs, scores)

    def answers(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    dealt = blocks.unionAll(asked).repartition("m", "part").sortWithinPartitions("m", "part", "kind")
    return dealt.mapInArrow(run, "item_id long, doc_id long, score long")


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """``items`` (item_id, term): ``item_id``, ``rank``, ``doc_id``, ``score`` of each item's k best documents."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    weight = F.expr(f"CAST(floor(1000 * ln(CAST(2 * {index.docs}L + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS LONG)")
    weighed = stored(items.join(index.held, "term").select("item_id", "term", weight.alias("w")).filter("w > 0"), "weighed")
    whole = weighed.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("held"))
    whole = whole.select("item_id", F.col("held.term").alias("terms"), F.col("held.w").alias("weights"))

    peaks = index.blocks.select("m", "part", "docs", F.explode(F.arrays_zip("terms", "best")).alias("p"))
    peaks = peaks.select("m", "part", "docs", F.col("p.terms").alias("term"), F.col("p.best").alias("tf"))
    bound = F.sum(F.col("w") * F.expr(impact("tf", "m"))).alias("bound")
    bounds = stored(peaks.join(weighed, "term").groupBy("item_id", "m", "part", "docs").agg(bound), "bounds")

    by_bound = [F.desc(F.col("docs") >= k), F.desc("bound"), F.asc("m"), F.asc("part")]
    first = stored(top_per_group(bounds, "item_id", by_bound, FIRST).select("item_id", "m", "part"), "first")
    lead = first.join(whole, "item_id").withColumn("floor", F.lit(1).cast("long"))
    near = stored(top_per_group(visited(index, lead, k), "item_id", order, k), "near")
    floors = near.groupBy("item_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(1).alias("floor"))

    rest = bounds.join(floors, "item_id", "left").withColumn("floor", F.coalesce("floor", F.lit(1).cast("long")))
    rest = rest.filter("bound >= floor").join(first, ["item_id", "m", "part"], "left_anti")
    rest = rest.select("item_id", "m", "part", "floor").join(whole, "item_id")
    found = top_per_group(near.unionAll(visited(index, rest, k)), "item_id", order, k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return found.select("item_id", rank.cast("int").alias("rank"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, postings: int = POSTINGS) -> DataFrame:
    """``docs`` (doc_id, text) ranked for each of ``items`` (item_id, text)."""
    asked = stored(item_terms(items), "asked")
    return search(Index(docs, asked, postings), asked, k)
