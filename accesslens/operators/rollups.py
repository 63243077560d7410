"""Five-minute rollups with mergeable distinct-count states.

A rollup is a table of *partials*: any split of the facts into batches may be
aggregated separately and appended, and the merge on read gives the same
answer. Sums are re-added; distinct counts are Theta sketches, exact up to
65,536 distinct values in a merged group and estimated above that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.functions.clients import is_scripted
from accesslens.functions.values import bucket, is_blocked, total

SKETCH_LG_ENTRIES = 16

CONN_STATES = ("ips", "prefixes", "asns", "countries", "nodes", "hosting_ips")
SUB_STATES = ("ips", "prefixes", "asns", "countries", "uas")
SUB_SUMS = ("requests", "scripted", "blocked")


def identity(value: Column) -> Column:
    """64-bit identity of a value.

    Sketches skip empty text, but the empty value counts as one distinct value
    here; hashing first keeps it and makes every sketch input eight bytes wide.
    """
    return F.xxhash64(value)


def distinct_state(value: Column) -> Column:
    """Aggregate: mergeable distinct state of ``value`` (NULLs are left out)."""
    return F.theta_sketch_agg(value, F.lit(SKETCH_LG_ENTRIES))


def merge_state(state: Column) -> Column:
    """Aggregate: union of distinct states."""
    return F.theta_union_agg(state, F.lit(SKETCH_LG_ENTRIES))


def state_count(state: Column) -> Column:
    return F.theta_sketch_estimate(state)


def merged_count(state: Column) -> Column:
    """Aggregate: number of distinct values behind many states."""
    return state_count(merge_state(state))


def usage_5m(facts: DataFrame) -> DataFrame:
    return facts.groupBy(bucket(F.col("ts")).alias("ts5"), "node_id", "user_id").agg(
        total("bytes").alias("bytes")
    )


def user_conn_5m(facts: DataFrame) -> DataFrame:
    keyed = facts.select(
        bucket(F.col("ts")).alias("ts5"),
        "user_id",
        identity(F.col("ip")).alias("ip"),
        identity(F.col("ip_prefix")).alias("prefix"),
        "asn",
        F.when(F.col("country") != "", identity(F.col("country"))).alias("country"),
        "node_id",
        F.when(F.col("is_hosting") == 1, identity(F.col("ip"))).alias("hosting_ip"),
    )
    return keyed.groupBy("ts5", "user_id").agg(
        distinct_state(F.col("ip")).alias("ips"),
        distinct_state(F.col("prefix")).alias("prefixes"),
        distinct_state(F.col("asn")).alias("asns"),
        distinct_state(F.col("country")).alias("countries"),
        distinct_state(F.col("node_id")).alias("nodes"),
        distinct_state(F.col("hosting_ip")).alias("hosting_ips"),
    )


def sub_req_5m(facts: DataFrame) -> DataFrame:
    keyed = facts.select(
        bucket(F.col("ts")).alias("ts5"),
        "user_id",
        identity(F.col("ip")).alias("ip"),
        identity(F.col("ip_prefix")).alias("prefix"),
        "asn",
        F.when(F.col("country") != "", identity(F.col("country"))).alias("country"),
        identity(F.col("user_agent")).alias("ua"),
        is_scripted(F.col("ua_kind")).cast("bigint").alias("scripted"),
        is_blocked(F.col("srr_response_type")).cast("bigint").alias("blocked"),
    )
    return (
        keyed.groupBy("ts5", "user_id")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            distinct_state(F.col("ip")).alias("ips"),
            distinct_state(F.col("prefix")).alias("prefixes"),
            distinct_state(F.col("asn")).alias("asns"),
            distinct_state(F.col("country")).alias("countries"),
            distinct_state(F.col("ua")).alias("uas"),
            F.sum("scripted").alias("scripted"),
            F.sum("blocked").alias("blocked"),
        )
    )


def merge_usage(partials: DataFrame, keep_zero: bool = False) -> DataFrame:
    """One row per (bucket, node, account); summed zeros vanish by default."""
    rows = partials if keep_zero else nonzero(partials)
    # The partition follows from the bucket; as a key it stays there to filter on.
    month = [c for c in ("month",) if c in partials.columns]
    return rows.groupBy("ts5", "node_id", "user_id", *month).agg(total("bytes").alias("bytes"))


def nonzero(partials: DataFrame) -> DataFrame:
    """Partials that survive a merge that drops zero sums.

    Byte counts are never negative, so a merged sum is zero exactly when every
    partial is: filtering the partials needs no merge and reaches the scan.
    """
    return partials.filter(F.col("bytes") > 0)


def merge_conn(partials: DataFrame, keys: Sequence[str] = ("ts5", "user_id")) -> DataFrame:
    return partials.groupBy(*keys).agg(*[merge_state(F.col(c)).alias(c) for c in CONN_STATES])


def merge_sub(partials: DataFrame, keys: Sequence[str] = ("ts5", "user_id")) -> DataFrame:
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUB_SUMS],
        *[merge_state(F.col(c)).alias(c) for c in SUB_STATES],
    )


def counts(df: DataFrame, states: Sequence[str]) -> DataFrame:
    """Replace sketch columns by their distinct counts."""
    return df.withColumns({c: state_count(F.col(c)) for c in states})
