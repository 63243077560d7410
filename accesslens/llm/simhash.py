"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits form three segments of 22, 21 and 21 bits. If two
fingerprints differ in at most two bits then, for one of the pairs (1, 2),
(2, 3), (3, 1), the first segment is equal and the second differs in one bit at
most (one segment is free of errors; of the two that follow it at most one has
two). So every fingerprint gets keys of an exact segment and the index of each
codeword near the next segment: one or six per pair. Distinct fingerprints are
joined on these keys and verified by counting differing bits inside the join.

Defined cases: texts without words (null, empty, blank) have fingerprint zero
and are linked like any other; a null ``doc_id`` loses against any other and a
component of nulls only has a null id; repeated rows share their result; an
empty table gives an empty result. Copies meet in one distinct fingerprint
before anything is joined, so no group of copies is expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm import golay
from accesslens.llm.common import stored, text_of
from accesslens.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
# (shift, bits) of the segments, and which segment follows which.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (1, 2), (2, 0))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64 bits: those set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashed = xxhash.xxh64_intdigest
    hashes = [hashed(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):  # bounds the bits held at once
        part = np.array(hashes[k : k + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint's bits as a long."""
    rows = docs.select(*[docs[c] for c in keep], text_of(docs).alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(t.as_py(), shingle) for t in batch.column("_text")]
            found = pa.array(np.array(bits, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], [*keep, "fp"])

    schema = rows.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema
    return rows.mapInArrow(hashed, schema)


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(key, row)`` of all keys: two bits for the pair, the exact segment, the codeword's index."""
    words = fps.view(np.uint64)
    parts = [(words >> np.uint64(s)).astype(np.int64) & ((1 << n) - 1) for s, n in SEGMENTS]
    keys, rows = [], []
    for pair, (exact, fuzzy) in enumerate(PAIRS):
        near = golay.nearby(parts[fuzzy])
        at, column = np.nonzero(near >= 0)
        keys.append((pair << 34) | (parts[exact][at] << 12) | near[at, column])
        rows.append(at)
    return np.concatenate(keys), np.concatenate(rows)


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fps``: distinct ``fp``. All pairs (u, v), u < v, that differ in ``distance`` bits at most."""
    if distance > DISTANCE:
        raise ValueError(f"the keys find at most {DISTANCE} differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(bits), 65536):
                key, row = keys_of(bits[k : k + 65536])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bits[k : k + 65536][row])], ["key", "fp"])

    keys = fps.select("fp").mapInArrow(keyed, "key long, fp long")
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)
    left, right = keys.withColumnRenamed("fp", "u"), keys.select(F.col("key").alias("k"), F.col("fp").alias("v"))
    return left.join(right, (F.col("key") == F.col("k")) & near).select("u", "v").distinct()


def grouped(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``rows`` (id, fp), stored. One row per distinct fingerprint: ``fp``, ``root`` (names the
    component) and ``least``, the component's smallest id."""
    fps = stored(rows.groupBy("fp").agg(F.min("id").alias("id")), "fingerprints")
    found = components(links(fps, distance))
    rooted = fps.join(found, fps["fp"] == found["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    least = stored(rooted.groupBy("root").agg(F.min("id").alias("least")), "least")
    return stored(rooted.join(least, "root").select("fp", "root", "least"), "components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex), ``component_id``."""
    rows = stored(fingerprints(docs.select(docs["doc_id"].alias("id"), docs["text"]), ["id"], shingle), "simhash")
    groups = grouped(rows, distance)
    return rows.join(groups, "fp").select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Of each component the document with the smallest id, of several texts under that id one;
    rows alike in id and text count as one document. Returns the columns of ``docs``."""
    body = F.xxhash64(text_of(docs))
    order = F.struct(docs["doc_id"].isNull().alias("unnamed"), docs["doc_id"], body.alias("body"))
    slim = docs.select(order.alias("id"), docs["text"])
    rows = stored(fingerprints(slim, ["id"], shingle), "simhash")
    stay = stored(grouped(rows, distance).select("least.*").distinct(), "stay")
    stay = stay.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("id"), body.alias("body"))
    same = packed["id"].eqNullSafe(stay["_id"]) & (packed["body"] == stay["_body"])
    return packed.join(stay, same, "semi").select("row.*")
