"""An index of networks: disjoint intervals of addresses, in sorted blocks.

Networks may nest, overlap or repeat; an address belongs to the smallest range
that holds it, of equally small ones to the one that begins last, of equal
ones to the largest values. A sweep along the addresses decides that once, when the index is
built, and leaves disjoint intervals:

1. Equal ranges become one. Fences, taken from a sample of at most ``SAMPLE`` first and
   last addresses, cut the address space into cells of about ``CELL`` of them.
2. A range goes to the cells that its ends lie in. Of the ranges that cover
   a cell from end to end only the smallest can count there, so each task keeps
   one per cell: a table of nested networks as wide as ``::/0`` multiplies nothing.
3. Every cell is swept by itself: at each end of a range the smallest open one
   is on top. Its intervals are cut into blocks of at most ``BLOCK``.

A lookup finds the block by binary search among the blocks' first addresses,
an array for all of them, joins that one block, and finds the interval by
binary search in it. Both are SQL; only the sweep runs in Python.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens import session
from accesslens.functions.addresses import address
from accesslens.functions.hosting import hosting_flag
from accesslens.functions.values import first_filled

BLOCK = 256  # intervals per block
CELL = 1 << 16  # ends of ranges swept together
SAMPLE = 1 << 14


def network_table(nets: DataFrame, columns: Sequence[str], keywords: Iterable[str] | None = None) -> DataFrame:
    """Network columns plus the looked-up ``columns``, empty values filled in.

    The country falls back to the registered one. The hosting keywords are
    tested once per network, not once per event.
    """
    registered = F.col("registered_country") if "registered_country" in nets.columns else F.lit("")
    values = {
        "country": lambda: first_filled(F.col("country"), registered),
        "city": lambda: F.expr("coalesce(city, '')"),
        "asn": lambda: F.expr("coalesce(CAST(asn AS BIGINT), 0L)"),
        "as_org": lambda: F.expr("coalesce(as_org, '')"),
        "is_hosting": lambda: hosting_flag("coalesce(as_org, '')", keywords),
    }
    where = ("start_ip", "end_ip") if "start_ip" in nets.columns else ("network",)
    return nets.select(*where, *[values[c]().alias(c) for c in columns])


def _mask(bits: str) -> str:
    """SQL of a BIGINT with the lowest ``bits`` bits set."""
    return f"CASE WHEN {bits} >= 64 THEN -1L WHEN {bits} <= 0 THEN 0L ELSE ~shiftleft(-1L, {bits}) END"


def _ranges(nets: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``family``, first and last address as (hi, lo), the looked-up values."""
    hit = F.struct(*columns).alias("hit")
    if "start_ip" in nets.columns:
        return nets.select(
            F.lit(4).alias("family"), F.col("start_ip").alias("s_hi"), F.lit(0).cast("bigint").alias("s_lo"),
            F.col("end_ip").alias("e_hi"), F.lit(0).cast("bigint").alias("e_lo"), hit,
        ).filter("s_hi <= e_hi")
    parsed = nets.select(
        address("substring_index(network, '/', 1)").alias("a"),
        F.expr("try_cast(substring_index(network, '/', -1) AS INT)").alias("len"),
        hit,
    ).filter("a.family > 0 AND len BETWEEN 0 AND IF(a.family = 4, 32, 128)")
    hi, lo = _mask("IF(a.family = 4, 32 - len, 64 - len)"), f"IF(a.family = 4, 0L, {_mask('128 - len')})"
    return parsed.selectExpr("a.family AS family", "a.hi AS hi", "a.lo AS lo", f"{hi} AS h", f"{lo} AS l", "hit").selectExpr(
        "family", "hi & ~h AS s_hi", "lo & ~l AS s_lo", "hi | h AS e_hi", "lo | l AS e_lo", "hit"
    )


def _ordered(value: str) -> str:
    """SQL of a BIGINT that orders as ``value`` does as an unsigned number."""
    return f"({value} ^ shiftleft(1L, 63))"



# A place among all addresses: family, then the number as two BIGINTs ordered as unsigned.
PLACE = "struct<f:int,hi:bigint,lo:bigint>"
_TOP = 1 << 63


def _number(f: int, hi: int, lo: int) -> int:
    return f << 128 | (hi + _TOP) << 64 | lo + _TOP


def _place(number: int) -> dict[str, int]:
    return {"f": number >> 128, "hi": (number >> 64 & (1 << 64) - 1) - _TOP, "lo": (number & (1 << 64) - 1) - _TOP}


def sweep(ranges: Sequence[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """Disjoint (first, last, which) of ranges (first, last, size, begin): the smallest size on top, then the
    latest begin. Intervals that touch and have the same range on top are one."""
    order = sorted(range(len(ranges)), key=lambda i: ranges[i][0])
    edges = sorted({r[0] for r in ranges} | {r[1] + 1 for r in ranges})
    found: list[tuple[int, int, int]] = []
    open_: list[tuple[int, int, int]] = []
    at = 0
    for edge, following in zip(edges, edges[1:]):
        while at < len(order) and ranges[order[at]][0] == edge:
            _, _, size, begin = ranges[order[at]]
            heapq.heappush(open_, (size, -begin, order[at]))
            at += 1
        while open_ and ranges[open_[0][2]][1] < edge:
            heapq.heappop(open_)
        if open_:
            which = open_[0][2]
            if found and found[-1][2] == which and found[-1][1] == edge - 1:
                found[-1] = (found[-1][0], following - 1, which)
            else:
                found.append((edge, following - 1, which))
    return found


_ENDS = ("s_hi", "s_lo", "e_hi", "e_lo")


def _celled(ranges: DataFrame, fences: list[int]) -> DataFrame:
    """``ranges`` with ``cell``: once for each cell an end lies in, and per task the smallest that covers a cell."""
    if not fences:
        return ranges.withColumn("cell", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covers: dict[int, tuple[tuple[int, int], pa.RecordBatch]] = {}
        for batch in batches:
            rows, cells = [], []
            columns = [batch.column(c).to_pylist() for c in ("f", *_ENDS)]
            for i, (f, s_hi, s_lo, e_hi, e_lo) in enumerate(zip(*columns)):
                first, last = _number(f, s_hi, s_lo), _number(f, e_hi, e_lo)
                a, b = bisect_right(fences, first), bisect_right(fences, last)
                for cell in {a, b}:
                    rows.append(i)
                    cells.append(cell)
                size = (last - first, -first)
                for cell in range(a + 1, b):
                    if cell not in covers or size < covers[cell][0]:
                        covers[cell] = size, batch.slice(i, 1)
            yield with_cells(batch.take(pa.array(rows, pa.int64())), cells)
        for cell, (_, row) in covers.items():
            yield with_cells(row, [cell])

    def with_cells(batch: pa.RecordBatch, cells: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"])

    kind = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in ranges.schema)
    return ranges.mapInArrow(run, f"{kind}, cell int")


def _swept(celled: DataFrame, fences: list[int], hit: str) -> DataFrame:
    """``first``, ``starts``, ``ends``, ``hits``: the blocks of every cell."""

    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        low = fences[cell - 1] if cell else 0
        high = fences[cell] - 1 if cell < len(fences) else _number(15, _TOP - 1, _TOP - 1)
        ranges = []
        for f, s_hi, s_lo, e_hi, e_lo in zip(*(table.column(c).to_pylist() for c in ("f", *_ENDS))):
            first, last = _number(f, s_hi, s_lo), _number(f, e_hi, e_lo)
            ranges.append((max(first, low), min(last, high), last - first, first))
        found = sweep(ranges)
        place = pa.struct([("f", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])
        starts = pa.array([_place(a) for a, _, _ in found], place)
        ends = pa.array([_place(b) for _, b, _ in found], place)
        hits = table.column("hit").combine_chunks().take(pa.array([i for _, _, i in found], pa.int64()))
        cuts = list(range(0, len(found), BLOCK))
        offsets = pa.array([*cuts, len(found)], pa.int32())
        return pa.table(
            {
                "first": starts.take(pa.array(cuts, pa.int64())),
                "starts": pa.ListArray.from_arrays(offsets, starts),
                "ends": pa.ListArray.from_arrays(offsets, ends),
                "hits": pa.ListArray.from_arrays(offsets, hits),
            }
        )

    kind = f"first {PLACE}, starts array<{PLACE}>, ends array<{PLACE}>, hits array<{hit}>"
    return celled.groupBy("cell").applyInArrow(run, kind)


@dataclass(frozen=True)
class NetworkIndex:
    """``blocks``: first address, and the sorted intervals with their values. ``fences``: the first addresses of all
    blocks in one row, ``count`` of them. ``bytes`` is what both take, by a count of the index itself."""

    blocks: DataFrame
    fences: DataFrame
    values: tuple[str, ...]
    bytes: int
    count: int


def index_networks(nets: DataFrame, values: Sequence[str], keywords: Iterable[str] | None = None) -> NetworkIndex:
    """Build, store and measure the index: a few jobs, to be run once per refresh of the networks."""
    spark = nets.sparkSession
    ranges = _ranges(network_table(nets, values, keywords), values)
    ranges = ranges.selectExpr("family AS f", *[f"{_ordered(c)} AS {c}" for c in _ENDS], "hit")
    path = session.scratch(spark, "ranges")
    ranges.groupBy("f", *_ENDS).agg(F.max("hit").alias("hit")).write.parquet(path)
    ranges = spark.read.schema(ranges.schema).parquet(path)
    ends = 2 * ranges.count()
    fences: list[int] = []
    if ends > CELL:
        both = ranges.select("f", F.col("s_hi").alias("hi"), F.col("s_lo").alias("lo")).unionAll(ranges.select("f", "e_hi", "e_lo"))
        # Hashes stand for chance, so that the same networks give the same index.
        some = both.orderBy(F.xxhash64("f", "hi", "lo")).limit(SAMPLE).collect()
        places = sorted({_number(*row) for row in some})
        cells = min(len(places), -(-ends // CELL))
        fences = [places[i * len(places) // cells] for i in range(1, cells)]
    hit = ranges.schema["hit"].dataType.simpleString()
    path = session.scratch(spark, "networks")
    blocks = _swept(_celled(ranges, fences), fences, hit)
    blocks.write.parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    # Text length, four times over for objects and the hash table around them.
    size, count = blocks.agg(
        F.coalesce(F.sum(F.octet_length(F.struct("first", "starts", "ends", "hits").cast("string"))), F.lit(0)), F.count(F.lit(1))
    ).first()
    firsts = blocks.agg(F.sort_array(F.collect_list("first")).alias("firsts"))
    return NetworkIndex(blocks, firsts, tuple(values), 4 * size, count)


def _found(sorted_: str, key: str, count: int) -> str:
    """SQL of the last place in a sorted array of up to ``count`` values that is not above ``key``; -1 if all are.
    ``p`` grows by halving steps, as binary search does."""
    steps = ", ".join(str(1 << bit) for bit in reversed(range(max(1, count.bit_length()))))
    return f"aggregate(array({steps}), -1, (p, step) -> IF(get({sorted_}, p + step) <= {key}, p + step, p))"


def lookup(df: DataFrame, index: NetworkIndex, *, small: bool, tag: str = "") -> tuple[DataFrame, dict[str, Column]]:
    """Look the routable address in ``_addr`` up: one equi-join, at most one row each.

    Returns the joined frame and the expression of each looked-up column.
    """
    if not index.count:
        return df, {c: F.lit(None) for c in index.values}
    key, block, at, best = (f"_{tag}{name}" for name in ("key", "block", "at", "best"))
    place = f"named_struct('f', _addr.family, 'hi', {_ordered('_addr.hi')}, 'lo', {_ordered('_addr.lo')})"
    keyed = df.withColumn(key, F.expr(f"IF(_routable, {place}, NULL)")).withColumn(f"{block}s", index.fences.scalar())
    found = F.expr(f"get({block}s, {_found(f'{block}s', key, index.count)})")
    blocks = index.blocks.selectExpr(f"first AS {block}_first", f"starts AS {block}_s", f"ends AS {block}_e", f"hits AS {block}_h")
    joined = keyed.withColumn(block, found).drop(f"{block}s").join(
        F.broadcast(blocks) if small else blocks, F.col(block) == F.col(f"{block}_first"), "left"
    )
    # Columns of their own, so that each search is made once for all values.
    joined = joined.withColumn(at, F.expr(_found(f"{block}_s", key, BLOCK)))
    joined = joined.withColumn(best, F.expr(f"IF({key} <= get({block}_e, {at}), get({block}_h, {at}), NULL)"))
    return joined, {c: F.col(best)[c] for c in index.values}
