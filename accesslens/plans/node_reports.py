"""Node-load reports, all on the five-minute traffic rollup.

Sums over partials need no prior merge, so each report aggregates straight to
its own grain; names are resolved on the aggregated rows and equal names are
then added together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions.values import as_bigint, bucket, in_range, or_zero, ratio, round_even, total, total_bigint
from accesslens.operators.rollups import nonzero
from accesslens.operators.select import quantile_exact, top, top_per_group
from accesslens.plans.views import (
    Tables, named_users, nodes_named, with_node_key, with_node_name, with_user, with_user_key,
)

BUCKET_S = 300


def _usage(t: Tables, t_from, t_to, nodes: Sequence[str] | None) -> DataFrame:
    """Non-zero partials in the window, of the named nodes (None means all)."""
    rows = in_range(nonzero(t.usage_5m), "ts5", t_from, t_to)
    if nodes is None:
        return rows
    return rows.join(nodes_named(t.dim_nodes, nodes), "node_id", "semi")


def _per_user(t: Tables, t_from, t_to, nodes) -> DataFrame:
    return _usage(t, t_from, t_to, nodes).groupBy("user_id").agg(total("bytes").alias("b"))


def _bits_per_second(seconds: int):
    return (total("bytes") * 8).cast("double") / F.lit(float(seconds))


def r_node_names(t: Tables, t_from, t_to) -> DataFrame:
    ids = _usage(t, t_from, t_to, None).select("node_id").distinct()
    return with_node_name(ids, t.dim_nodes).select("node_name").distinct().orderBy("node_name")


def r_traffic_total(t: Tables, t_from, t_to, nodes=None) -> DataFrame:
    return _usage(t, t_from, t_to, nodes).agg(or_zero(total_bigint("bytes")).alias("bytes"))


def r_active_users(t: Tables, t_from, t_to, nodes=None) -> DataFrame:
    return _usage(t, t_from, t_to, nodes).agg(F.count_distinct("user_id").alias("users"))


def r_peak_node_bps(t: Tables, t_from, t_to, nodes=None) -> DataFrame:
    ids = _usage(t, t_from, t_to, nodes).groupBy("ts5", "node_id").agg(total("bytes").alias("bytes"))
    named = with_node_name(ids, t.dim_nodes).groupBy("ts5", "node_name")
    rates = named.agg(_bits_per_second(BUCKET_S).alias("bps"))
    return rates.agg(F.coalesce(F.max("bps"), F.lit(0.0)).alias("peak_bps"))


def r_heaviest_share(t: Tables, t_from, t_to, nodes=None) -> DataFrame:
    share = ratio(F.max("b") * 100, F.sum("b"))
    return _per_user(t, t_from, t_to, nodes).agg(round_even(share, 1).alias("pct"))


def r_nodes_reporting(t: Tables, t_from, t_to, nodes=None) -> DataFrame:
    return _usage(t, t_from, t_to, nodes).agg(F.count_distinct("node_id").alias("nodes"))


def r_p95_user_traffic(t: Tables, t_from, t_to, nodes=None, level: float = 0.95) -> DataFrame:
    per = _per_user(t, t_from, t_to, nodes).withColumn("b", as_bigint(F.col("b")))
    return quantile_exact(per, "b", level, "p95")


def r_throughput_by_node(t: Tables, t_from, t_to, nodes=None, interval_s: int = 300) -> DataFrame:
    ids = (
        _usage(t, t_from, t_to, nodes)
        .groupBy(bucket(F.col("ts5"), interval_s).alias("time"), "node_id")
        .agg(total("bytes").alias("bytes"))
    )
    return (
        with_node_name(ids, t.dim_nodes)
        .groupBy("time", "node_name")
        .agg(_bits_per_second(interval_s).alias("bps"))
        .orderBy("time", "node_name")
    )


def r_top10_throughput(t: Tables, t_from, t_to, nodes=None, interval_s: int = 300, limit: int = 10) -> DataFrame:
    rows = _usage(t, t_from, t_to, nodes)
    sums = _per_user(t, t_from, t_to, nodes)
    heaviest = top(sums, [F.desc("b"), F.asc("user_id")], limit).select("user_id")
    names = with_user(heaviest, t.dim_users)
    return (
        rows.select(bucket(F.col("ts5"), interval_s).alias("time"), "user_id", "bytes")
        .join(F.broadcast(names), "user_id")
        .groupBy("time", "username")
        .agg(_bits_per_second(interval_s).alias("bps"))
        .orderBy("time", "username")
    )


def r_top_talkers(t: Tables, t_from, t_to, nodes=None, limit: int = 100) -> DataFrame:
    """Heaviest accounts: total, busiest bucket, nodes at once and share of all traffic.

    Aggregates run on numbers that stand for display names; names join the one
    row per account that is left, status and tag what is listed.
    """
    rows = _usage(t, t_from, t_to, nodes).select("ts5", "user_id", "node_id", "bytes")
    keyed = with_node_key(with_user_key(rows, t.dim_users), t.dim_nodes)
    per_bucket = keyed.groupBy("ts5", "user_key", "node_key").agg(total("bytes").alias("bytes"))
    per_bucket = per_bucket.groupBy("ts5", "user_key").agg(
        total("bytes").alias("bytes"), F.count(F.lit(1)).alias("nodes")
    )
    per_name = per_bucket.groupBy("user_key").agg(
        total("bytes").alias("total_bytes"), F.max("bytes").alias("peak"), F.max("nodes").alias("nodes")
    )
    every = rows.agg(total("bytes").alias("all_bytes")).scalar()
    best = top(named_users(per_name, t.dim_users, keep=True), [F.desc("total_bytes"), F.asc("username")], limit)
    # The accounts behind the listed names that have traffic in the window.
    listed = with_user_key(rows.select("user_id"), t.dim_users).join(
        F.broadcast(best.select("user_key")), "user_key", "semi"
    )
    accounts = with_user(listed.distinct(), t.dim_users, "status", "tag").groupBy("user_key").agg(
        F.max("status").alias("status"), F.max("tag").alias("tag")
    )
    peak = (F.col("peak") * 8).cast("double") / F.lit(float(BUCKET_S)) / F.lit(1000000.0)
    return accounts.join(F.broadcast(best), "user_key").select(
        "username", "status", "tag", as_bigint(F.col("total_bytes")).alias("total_bytes"),
        round_even(peak, 2).alias("peak_mbps"), "nodes",
        round_even(ratio(F.col("total_bytes") * 100, every), 2).alias("pct_of_total"),
    ).orderBy(F.desc("total_bytes"), "username")


def r_traffic_by_node(t: Tables, t_from, t_to, nodes=None) -> DataFrame:
    ids = _usage(t, t_from, t_to, nodes).groupBy("node_id").agg(total("bytes").alias("bytes"))
    named = with_node_name(ids, t.dim_nodes).groupBy("node_name").agg(total_bigint("bytes").alias("bytes"))
    return named.orderBy(F.desc("bytes"), "node_name")


def r_top5_per_node(t: Tables, t_from, t_to, nodes=None, limit: int = 5) -> DataFrame:
    """Heaviest accounts per node with their share of the node's traffic.

    The node total comes from an aggregate joined back rather than from a
    window over the node, which would gather all accounts of a node in one
    task; the cut to ``limit`` rows happens before the shuffle.
    """
    ids = _usage(t, t_from, t_to, nodes).groupBy("node_id", "user_id").agg(total("bytes").alias("bytes"))
    named = with_node_name(with_user(ids, t.dim_users), t.dim_nodes)
    per = named.groupBy("node_name", "username").agg(total("bytes").alias("bytes"))
    totals = per.groupBy("node_name").agg(total("bytes").alias("node_bytes"))
    best = top_per_group(per, "node_name", [F.desc("bytes"), F.asc("username")], limit)
    share = round_even(ratio(F.col("bytes") * 100, F.col("node_bytes")), 1)
    return (
        best.join(totals, "node_name")
        .select("node_name", "username", as_bigint(F.col("bytes")).alias("bytes"), share.alias("pct_of_node"))
        .orderBy("node_name", F.desc("bytes"), "username")
    )
