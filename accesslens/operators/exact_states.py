"""Mergeable distinct states that stay exact at any size.

Sketches are exact up to 65,536 values of a merged group, which all accounts but a
few never reach. For the few, every distinct value gets a number that never
changes: 1, 2, … within account and measure. A state is then a row per ``SLOT``
numbers with their bits in one BIGINT, merged by OR and counted by its bits: no row
or aggregate is wider than its values need, however sparse or dense they are.

Values are dealt once, by hash part of the account's measure. In a part the known
numbers meet the batch's rows, new values are ranked and begin where the parts
before it end, so no task ranks one account's values alone. Values are told apart by
128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.functions.values import bucket
from accesslens.operators.rollups import merged_count

PARTS = 1024
SLOT = 64  # bits of one row
PER_TASK = 2_000_000  # rows dealt to one task, about
# An account with more values than this in any measure, ever, counts as large. Half of what sketches hold
# exactly, so that no estimate of a larger number can fall below it.
LARGE = 1 << 15

KEY = ("user_id", "kind", "h1", "h2")
PART = ("user_id", "kind", "part")
# Measure -> state column of the connection and of the request rollup.
CONN_KINDS = {"ips": "ips", "prefixes": "prefixes", "asns": "asns", "countries": "countries", "nodes": "nodes", "hosting_ips": "hosting_ips"}
SUB_KINDS = {"sub_ips": "ips", "sub_uas": "uas"}
KINDS = (*CONN_KINDS, *SUB_KINDS)


def large_accounts(conn: DataFrame, sub: DataFrame, limit: int = LARGE) -> DataFrame:
    """``user_id`` of accounts that are large by the rollups' sketches."""

    def over(partials: DataFrame, states: Sequence[str]) -> DataFrame:
        counted = partials.groupBy("user_id").agg(*[merged_count(F.col(s)).alias(s) for s in states])
        return counted.filter(F.greatest(*states) > limit).select("user_id")

    return over(conn, list(CONN_KINDS.values())).unionByName(over(sub, list(SUB_KINDS.values()))).distinct()


def _values(facts: DataFrame, **kinds: Column) -> DataFrame:
    made = [
        F.struct(
            F.lit(k).alias("kind"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(7), v).alias("h2"), v.isNotNull().alias("has")
        )
        for k, v in kinds.items()
    ]
    rows = facts.select(bucket(F.col("ts")).alias("ts5"), "user_id", F.inline(F.array(*made)))
    return rows.filter("has").drop("has")


def connection_values(facts: DataFrame) -> DataFrame:
    """``ts5``, ``user_id``, ``kind``, ``h1``, ``h2``: the values of connection facts, with repeats."""
    return _values(
        facts, ips=F.col("ip"), prefixes=F.col("ip_prefix"), asns=F.col("asn").cast("string"),
        countries=F.when(F.col("country") != "", F.col("country")), nodes=F.col("node_id").cast("string"),
        hosting_ips=F.when(F.col("is_hosting") == 1, F.col("ip")),
    )


def request_values(facts: DataFrame) -> DataFrame:
    return _values(facts, sub_ips=F.col("ip"), sub_uas=F.col("user_agent"))


def frequent(values: DataFrame) -> list[int]:
    """Hashes of the values that have most rows, by a bounded sketch. Of any other one, less than 1/500 of all rows."""
    found = values.agg(F.expr("approx_top_k(xxhash64(user_id, kind, h1), 1000, 10000)").alias("top")).first()["top"]
    return [item["item"] for item in found or []]


def dealt(values: DataFrame, known: DataFrame, tasks: int, often: Sequence[int] = ()) -> DataFrame:
    """Rows of ``values`` (``ts5`` and key) with ``part``, ``number`` (NULL for new values) and ``rank``, the place of a
    new value among those of its part; ``first`` marks one row per new value.

    All rows cross the network once; repeats of ``often`` values are dropped before.
    """
    one = F.xxhash64("user_id", "kind", "h1").isin(list(often))
    rows = values.filter(~one).unionByName(values.filter(one).distinct()) if often else values
    rows = rows.withColumn("number", F.lit(None).cast("long"))
    rows = rows.unionByName(known.select(F.lit(None).cast("timestamp_ntz").alias("ts5"), *KEY, "number"))
    # What varies least comes first, so that the shuffle's compression meets long runs.
    part = F.pmod("h1", F.lit(PARTS)).cast("int")
    rows = rows.select("user_id", "kind", "number", "ts5", "h1", "h2").repartition(tasks, "user_id", "kind", part)
    rows = rows.withColumn("part", part)
    # One order serves all: a value's known number comes before its rows.
    in_part = Window.partitionBy(*PART).orderBy("h1", "h2", F.desc_nulls_last("number"))
    of_value = Window.partitionBy(*PART, "h1", "h2").orderBy(F.desc_nulls_last("number"))
    rows = rows.withColumns({"number": F.first("number").over(of_value), "place": F.row_number().over(of_value)})
    rows = rows.withColumn("first", F.col("number").isNull() & (F.col("place") == 1))
    in_order = Window.partitionBy(*PART).orderBy("h1", "h2").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("rank", F.sum(F.col("first").cast("int")).over(in_order))
    return rows.filter("ts5 IS NOT NULL").drop("place")


def numbered(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``dealt`` rows with the numbers of new values too."""
    account = ["user_id", "kind"]
    before = Window.partitionBy(*account).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.filter("first").groupBy(*PART).agg(F.count(F.lit(1)).alias("n"))
    begins = begins.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    last = known.groupBy(*account).agg(F.max("number").alias("last"))
    begins = begins.join(last, account, "left").withColumn("begin", F.col("begin") + F.coalesce("last", F.lit(0))).drop("last")
    given = rows.join(begins, list(PART), "left")
    return given.withColumn("number", F.coalesce("number", F.col("begin") + F.col("rank"))).drop("begin", "rank")


def new_numbers(values: DataFrame, known: DataFrame, tasks: int = 16) -> DataFrame:
    """Numbers (``user_id``, ``kind``, ``h1``, ``h2``, ``number``) of the values that ``known`` does not have.

    The same values and the same ``known`` give the same numbers.
    """
    return first_seen(numbered(dealt(values, known, tasks), known))


def first_seen(rows: DataFrame) -> DataFrame:
    return rows.filter("first").select(*KEY, "number")


def bit_states(rows: DataFrame) -> DataFrame:
    """``ts5``, ``user_id``, ``kind``, ``slot``, ``bits`` of numbered rows; parts are not merged, so nothing moves."""
    slot, bit = F.expr(f"number DIV {SLOT}"), F.expr(f"shiftleft(1L, CAST(number % {SLOT} AS INT))")
    return rows.groupBy("ts5", *PART, slot.alias("slot")).agg(F.bit_or(bit).alias("bits")).drop("part")


def merge_bits(partials: DataFrame, keys: Sequence[str] = ("ts5", "user_id")) -> DataFrame:
    return partials.groupBy(*keys, "kind", "slot").agg(F.bit_or("bits").alias("bits"))


def bit_counts(partials: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """Distinct values per measure, one column each; 0 where there are none."""
    merged = merge_bits(partials, keys).withColumn("n", F.bit_count("bits"))
    return merged.groupBy(*keys).agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in KINDS])
