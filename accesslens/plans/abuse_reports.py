"""Abuse reports: flagged accounts, shared addresses, geography."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions.values import bucket, in_range, or_zero
from accesslens.operators.rollups import merged_count
from accesslens.operators.select import top, top_per_group
from accesslens.plans.abuse import account_measures, scored_measures
from accesslens.plans.views import Tables, with_node_name, with_user, named_users, with_node_key, with_user_key


def _measures(t: Tables, t_from, t_to) -> DataFrame:
    return account_measures(t.usage_5m, t.user_conn_5m, t.sub_req_5m, t_from, t_to)


def _scored(t: Tables, t_from, t_to, weights) -> DataFrame:
    return scored_measures(t.usage_5m, t.user_conn_5m, t.sub_req_5m, t_from, t_to, weights)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def r_flagged_accounts(t: Tables, t_from, t_to, at_least: float = 30, weights=None) -> DataFrame:
    return _count(_scored(t, t_from, t_to, weights).filter(F.col("score") >= at_least), "flagged")


def r_multi_country(t: Tables, t_from, t_to) -> DataFrame:
    return _count(_measures(t, t_from, t_to).filter(F.col("countries") > 1), "c")


def r_hosting_accounts(t: Tables, t_from, t_to) -> DataFrame:
    return _count(_measures(t, t_from, t_to).filter(F.col("hosting_ips") > 0), "c")


def r_over_device_limit(t: Tables, t_from, t_to) -> DataFrame:
    limited = with_user(_measures(t, t_from, t_to), t.dim_users, "hwid_device_limit")
    limit = F.col("hwid_device_limit")
    return _count(limited.filter((limit > 0) & (F.col("prefixes") > limit)), "c")


def r_shared_address_count(t: Tables, t_from, t_to) -> DataFrame:
    """Addresses seen with more than one account.

    "More than one distinct" is "smallest differs from largest", which needs
    two numbers per address instead of a set of accounts.
    """
    rows = in_range(t.node_connections, "ts", t_from, t_to)
    spread = rows.groupBy("ip").agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
    return _count(spread.filter(F.col("lo") < F.col("hi")), "c")


def r_scripted_fetches(t: Tables, t_from, t_to) -> DataFrame:
    sub = in_range(t.sub_req_5m, "ts5", t_from, t_to)
    return sub.agg(or_zero(F.sum("scripted")).alias("c"))


def r_abuse_score(t: Tables, t_from, t_to, limit: int = 200, weights=None) -> DataFrame:
    scored = _scored(t, t_from, t_to, weights).filter(F.col("score") > 0)
    best = top(scored, [F.desc("score"), F.asc("user_id")], limit)
    named = with_user(best, t.dim_users, "status", "tag", "hwid_device_limit")
    return named.select(
        "username", "status", "tag", "score", "gigabytes", F.col("prefixes").alias("networks"),
        "countries", "asns", "hosting_ips", "nodes", "ips", "sub_requests", "sub_uas",
        "sub_blocked", "hwid_device_limit",
    ).orderBy(F.desc("score"), "username")


def r_networks_worst10(t: Tables, t_from, t_to, interval_s: int = 300, limit: int = 10) -> DataFrame:
    conn = in_range(t.user_conn_5m, "ts5", t_from, t_to)
    totals = conn.groupBy("user_id").agg(merged_count(F.col("prefixes")).alias("n"))
    worst = top(totals, [F.desc("n"), F.asc("user_id")], limit).select("user_id")
    rows = conn.join(F.broadcast(worst), "user_id", "left_semi").select(
        bucket(F.col("ts5"), interval_s).alias("time"), "user_id", "prefixes"
    )
    names = with_user(worst, t.dim_users)
    return (
        rows.join(F.broadcast(names), "user_id")
        .groupBy("time", "username")
        .agg(merged_count(F.col("prefixes")).alias("networks"))
        .orderBy("time", "username")
    )


def r_shared_addresses(t: Tables, t_from, t_to, limit: int = 200, names: int = 10) -> DataFrame:
    """Addresses used by several accounts, with up to ``names`` display names.

    The ranking runs on fixed-width columns only. Places and names are then
    read together, for the listed addresses alone, and an address keeps at most
    ``names`` of them per task before the shuffle.
    """
    rows = in_range(t.node_connections, "ts", t_from, t_to)
    shared = (
        rows.groupBy("ip", "user_id")
        .agg(F.max("is_hosting").alias("hosting"), F.max("last_seen").alias("last_seen"))
        .groupBy("ip")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            F.max("hosting").alias("hosting"),
            F.max("last_seen").alias("last_seen"),
        )
        .filter(F.col("accounts") > 1)
    )
    listed = top(shared, [F.desc("accounts"), F.desc("last_seen"), F.asc("ip")], limit)
    hits = rows.join(F.broadcast(listed.select("ip")), "ip", "left_semi")
    named = with_user(hits.select("ip", "user_id", "country", "as_org").distinct(), t.dim_users)
    # Names and places in one list: of names the first ones count, of places the largest value.
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in enumerate(("username", "country", "as_org"))])
    values = named.select("ip", F.inline(kinds)).distinct().withColumn("slot", F.struct("ip", "kind"))
    up, down = (F.when((F.col("kind") == 0) == first, F.col("value")) for first in (True, False))
    few = top_per_group(values, "slot", [F.asc(up), F.desc(down)], names)
    of = [F.when(F.col("kind") == k, F.col("value")) for k in range(3)]
    found = few.groupBy("ip").agg(
        F.array_join(F.array_sort(F.collect_list(of[0])), ", ").alias("usernames"),
        F.max(of[1]).alias("country"), F.max(of[2]).alias("as_org"),
    )
    return (
        listed.join(found, "ip")
        .select("ip", "accounts", "usernames", "country", "as_org", "hosting", "last_seen")
        .orderBy(F.desc("accounts"), F.desc("last_seen"), "ip")
    )


def r_hosting_connections(t: Tables, t_from, t_to, limit: int = 200) -> DataFrame:
    place = ("ip", "country", "city", "asn", "as_org")
    ids = (
        in_range(t.node_connections, "ts", t_from, t_to)
        .filter(F.col("is_hosting") == 1)
        .groupBy("user_id", "node_id", *place)
        .agg(F.max("last_seen").alias("last_seen"), F.count(F.lit(1)).alias("snapshots"))
    )
    named = with_node_name(with_user(ids, t.dim_users), t.dim_nodes)
    grouped = named.groupBy("username", "node_name", *place).agg(
        F.max("last_seen").alias("last_seen"), F.sum("snapshots").alias("snapshots")
    )
    ties = [F.asc(c) for c in ("username", "node_name", *place)]
    return top(grouped, [F.desc("last_seen"), *ties], limit)


def r_country_addresses(t: Tables, t_from, t_to, limit: int = 15) -> DataFrame:
    rows = in_range(t.node_connections, "ts", t_from, t_to).filter(F.col("country") != "")
    per = rows.groupBy("country").agg(F.count_distinct("ip").alias("addresses"))
    return top(per, [F.desc("addresses"), F.asc("country")], limit)


def r_account_geography(t: Tables, t_from, t_to, limit: int = 500) -> DataFrame:
    ids = (
        in_range(t.node_connections, "ts", t_from, t_to)
        .groupBy("user_id", "country", "as_org", "ip", "node_id")
        .agg(F.max("last_seen").alias("last_seen"))
    )
    # Numbers stand for names until everything is counted.
    keyed = with_node_key(with_user_key(ids, t.dim_users), t.dim_nodes)
    per = keyed.groupBy("user_key", "country", "as_org").agg(
        F.count_distinct(F.xxhash64("ip"), F.xxhash64(F.lit(7), "ip")).alias("addresses"),
        F.count_distinct("node_key").alias("nodes"),
        F.max("last_seen").alias("last_seen"),
    )
    order = [F.asc("username"), F.desc("addresses"), F.asc("country"), F.asc("as_org")]
    named = named_users(per, t.dim_users)
    return top(named.select("username", "country", "as_org", "addresses", "nodes", "last_seen"), order, limit)
