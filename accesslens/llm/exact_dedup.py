"""Exact de-duplication over an extendible-hash index on shared files.

1. Rows are written as hashes: row number, ``doc_id``, 64-bit key and digest of the text.
2. Directory. It starts with one slot and doubles while a bucket holds more than
   ``capacity`` keys; only overfull buckets split. A bucket is a range of keys, a
   slot the first bits of a key, and the directory says which bucket a slot is in.
3. Owners. Of keys that one row has there is nothing to compare. Texts of the
   other keys go to the owner of their bucket, which chains the different texts of a key,
   comparing bytes, and finds the row that stays of each. A key that more than
   one in ``HOT`` rows has (so there are fewer than ``HOT``) is dealt over ``PARTS``
   owners, whose chains are then put together.
4. Look-up. Every row finds its bucket through the directory, and in that
   bucket its key and text.

So texts move once, and only those whose key occurs twice; what else moves are hashes.
Keys to be compared are broadcast if their measured size allows, else joined.

Defined cases: a null text counts as the empty text; a null ``doc_id`` loses
against any other and groups of nulls only have a null ``keep_id``; rows alike
in ``doc_id`` and text are one document written several times, of which one
row is kept; an empty table gives an empty result; other columns are ignored
by the report and carried along by ``keep_one``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import stored, text_of

CAPACITY = 16384
# Levels that the histogram reaches below the even split; a bucket still overfull there keeps its keys as overflow.
SPARE = 4
HOT, PARTS = 1000, 64
BROADCAST_KEYS = 2_000_000  # of 16 bytes each


@dataclass
class Index:
    """``rows``: row, doc_id, key, text_sha256 of every row. ``entries``: bucket, depth, key, chain, text_sha256,
    keep_id, group_size of every distinct text. ``directory``: slot at the global depth, the bucket (prefix) it
    points to, the bucket's depth."""

    rows: DataFrame
    entries: DataFrame
    directory: DataFrame
    depth: int


def hash_key(text: Column) -> Column:
    return F.xxhash64(text)


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The slots and the global depth, from a histogram of some 2^SPARE slots per bucket."""
    finest = (keys.count() // capacity).bit_length() + SPARE
    open_ = stored(
        keys.groupBy(prefix(F.col("key"), finest).alias("slot")).agg(F.count(F.lit(1)).alias("n")), "histogram"
    )
    closed, depth = None, 0
    while True:
        at = F.shiftrightunsigned(F.col("slot"), finest - depth).alias("bucket")
        counts = stored(open_.groupBy(at).agg(F.sum("n").alias("n")), "buckets")
        over = counts.filter(F.col("n") > capacity) if depth < finest else counts.limit(0)
        full = counts.filter(F.col("n") <= capacity) if depth < finest else counts
        full = full.select("bucket", F.lit(depth).alias("depth"))
        closed = full if closed is None else closed.unionAll(full)
        if over.isEmpty():
            break
        open_ = open_.withColumn("bucket", at).join(over.select("bucket"), "bucket", "semi").drop("bucket")
        depth += 1
    span = F.pow(F.lit(2), F.lit(depth) - F.col("depth")).cast("long")
    first = F.col("bucket") * span
    slots = closed.select(F.explode(F.sequence(first, first + span - 1)).alias("slot"), "bucket", "depth")
    return stored(slots, "directory"), depth


def in_bucket(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``rows`` (key and others) with the ``bucket`` and ``depth`` that the directory gives their key."""
    return rows.withColumn("slot", prefix(F.col("key"), depth)).join(slots, "slot").drop("slot")


def chains(docs: DataFrame, shared: DataFrame, hot: list[int]) -> DataFrame:
    """The entries of keys that several rows have; ``shared`` (key, bucket, depth)."""
    text = text_of(docs)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS))
    rows = docs.select(hash_key(text).alias("key"), text.alias("body"), F.col("doc_id").alias("id"), salt.alias("salt"))
    rows = rows.withColumn("part", F.when(F.col("key").isin(hot), F.col("salt")).otherwise(0)).drop("salt")
    small = shared.count() <= BROADCAST_KEYS
    owned = rows.join(F.broadcast(shared) if small else shared, "key").repartition("bucket", "depth", "part")
    # Groups lie within the owner's rows, so nothing moves here: bytes are compared where they are.
    texts = owned.groupBy("bucket", "depth", "part", "key", "body").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    parts = texts.select("bucket", "depth", "key", digest(F.col("body")).alias("text_sha256"), "keep_id", "group_size")
    whole = parts.groupBy("bucket", "depth", "key", "text_sha256").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    order = Window.partitionBy("bucket", "depth", "key").orderBy("text_sha256")
    return whole.withColumn("chain", F.row_number().over(order))


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> Index:
    text = text_of(docs)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", hash_key(text).alias("key"), digest(text).alias("text_sha256")
    )
    rows = stored(rows, "rows")
    keys = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
    slots, depth = directory(keys, capacity)
    several = in_bucket(keys.filter("n > 1"), slots, depth)
    shared = stored(several.select("key", "bucket", "depth", "n"), "shared")
    most = rows.count() // HOT
    hot = [r["key"] for r in shared.filter(F.col("n") > max(most, 1)).select("key").collect()] if most else []
    single = in_bucket(rows, slots, depth).join(keys.filter("n = 1").select("key"), "key").select(
        "bucket", "depth", "key", "text_sha256", F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(1).alias("chain"),
    )
    chained = chains(docs, shared.drop("n"), hot).select(single.columns)
    return Index(rows, stored(single.unionAll(chained), "index"), slots, depth)


def looked_up(index: Index) -> DataFrame:
    """Every row with its entry: row, doc_id, key, text_sha256, bucket, depth, keep_id, group_size, chain."""
    return in_bucket(index.rows, index.directory, index.depth).join(index.entries, ["bucket", "depth", "key", "text_sha256"])


def kept_rows(found: DataFrame) -> DataFrame:
    """``row`` of the first row of each entry that has the id that stays."""
    staying = found.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return staying.groupBy("key", "text_sha256").agg(
        F.min("row").alias("row"), F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("times")
    )


def report(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    found = stored(looked_up(build_index(docs, capacity)), "found")
    kept = kept_rows(found).select(F.col("row").alias("_kept"))
    marked = found.join(kept, F.col("row") == F.col("_kept"), "left")
    return marked.select("doc_id", "keep_id", "group_size", F.col("_kept").isNotNull().alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with all columns of ``docs``; of rows alike in id and text that
    differ in other columns the one with the largest of these."""
    kept = stored(kept_rows(looked_up(build_index(docs, capacity))).drop("row"), "kept")
    kept = kept.withColumnsRenamed({c: f"_kept_{c}" for c in kept.columns})
    same = (hash_key(text_of(docs)) == F.col("_kept_key")) & (digest(text_of(docs)) == F.col("_kept_text_sha256"))
    same &= docs["doc_id"].eqNullSafe(F.col("_kept_keep_id"))
    once = docs.join(kept.filter("_kept_times = 1"), same).select(docs.columns)
    whole = F.struct(F.col("text").isNull(), F.struct(*docs.columns).alias("row"))
    several = docs.join(kept.filter("_kept_times > 1"), same)
    several = several.groupBy("_kept_key", "_kept_text_sha256").agg(F.max(whole).alias("w")).select("w.row.*")
    return once.unionAll(several.select(docs.columns))
