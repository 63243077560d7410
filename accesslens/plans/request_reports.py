"""Subscription-request reports on the raw request facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions.clients import is_scripted
from accesslens.functions.values import REFUSALS, bucket, in_range, or_zero, ratio, round_even
from accesslens.operators.select import top
from accesslens.plans.views import Tables, named_users, with_user, with_user_key


def _requests(t: Tables, t_from, t_to) -> DataFrame:
    return in_range(t.sub_requests, "ts", t_from, t_to)


def _per_user(t: Tables, t_from, t_to) -> DataFrame:
    return _requests(t, t_from, t_to).groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))


def r_requests(t: Tables, t_from, t_to) -> DataFrame:
    return _requests(t, t_from, t_to).agg(F.count(F.lit(1)).alias("requests"))


def r_request_accounts(t: Tables, t_from, t_to) -> DataFrame:
    return _requests(t, t_from, t_to).agg(F.count_distinct("user_id").alias("users"))


def r_request_ips(t: Tables, t_from, t_to) -> DataFrame:
    return _requests(t, t_from, t_to).agg(F.count_distinct("ip").alias("ips"))


def r_scripted_share(t: Tables, t_from, t_to) -> DataFrame:
    share = ratio(F.count_if(is_scripted(F.col("ua_kind"))) * 100, F.count(F.lit(1)))
    return _requests(t, t_from, t_to).agg(round_even(share, 1).alias("pct"))


def r_hosting_requests(t: Tables, t_from, t_to) -> DataFrame:
    rows = _requests(t, t_from, t_to).filter(F.col("is_hosting") == 1)
    return rows.agg(F.count(F.lit(1)).alias("c"))


def r_busiest_account(t: Tables, t_from, t_to) -> DataFrame:
    return _per_user(t, t_from, t_to).agg(or_zero(F.max("c")).alias("requests"))


def r_requests_by_kind(t: Tables, t_from, t_to, interval_s: int = 300) -> DataFrame:
    return (
        _requests(t, t_from, t_to)
        .groupBy(bucket(F.col("ts"), interval_s).alias("time"), "ua_kind")
        .agg(F.count(F.lit(1)).alias("requests"))
        .orderBy("time", "ua_kind")
    )


def r_busiest10(t: Tables, t_from, t_to, interval_s: int = 300, limit: int = 10) -> DataFrame:
    rows = _requests(t, t_from, t_to).select(bucket(F.col("ts"), interval_s).alias("time"), "user_id")
    busiest = top(_per_user(t, t_from, t_to), [F.desc("c"), F.asc("user_id")], limit).select("user_id")
    return (
        rows.join(F.broadcast(with_user(busiest, t.dim_users)), "user_id")
        .groupBy("time", "username")
        .agg(F.count(F.lit(1)).alias("requests"))
        .orderBy("time", "username")
    )


def r_response_types(t: Tables, t_from, t_to) -> DataFrame:
    rows = _requests(t, t_from, t_to).filter(F.col("srr_response_type") != "")
    return (
        rows.groupBy("srr_response_type")
        .agg(F.count(F.lit(1)).alias("requests"))
        .orderBy(F.desc("requests"), "srr_response_type")
    )


def r_refused_by_rule(t: Tables, t_from, t_to, limit: int = 100) -> DataFrame:
    rule = F.when(F.col("srr_rule_name") == "", "(unnamed)").otherwise(F.col("srr_rule_name"))
    rows = _requests(t, t_from, t_to).filter(F.col("srr_response_type").isin(*REFUSALS))
    grouped = rows.groupBy(rule.alias("rule"), "srr_response_type").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_distinct("user_id").alias("accounts"),
        F.count_distinct("ua_family").alias("clients"),
        F.max("ts").alias("last_seen"),
    )
    return top(grouped, [F.desc("requests"), F.asc("rule"), F.asc("srr_response_type")], limit)


def r_fetch_offenders(t: Tables, t_from, t_to, limit: int = 200) -> DataFrame:
    """Heaviest fetchers by display name and status.

    Requests collapse to one row per account and seen value, sums beside it,
    before both are added up per name; names join the one row per account that
    is left. Unlike in the rollup an unknown country counts as
    one here.
    """
    rows = _requests(t, t_from, t_to)
    sums = {
        "requests": F.count(F.lit(1)),
        "scripted": F.count_if(is_scripted(F.col("ua_kind"))),
        "from_hosting": F.count_if(F.col("is_hosting") == 1),
        "refused": F.count_if(F.col("srr_response_type").isin(*REFUSALS)),
        "last_seen": F.max("ts"),
    }
    kinds = {"ips": "ip", "networks": "ip_prefix", "countries": "country", "user_agents": "user_agent"}
    # Two hashes are 128 bits: fixed width, whatever the text.
    values = [
        F.struct(F.lit(k).alias("kind"), F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(7), c).alias("h2"))
        for k, c in enumerate(kinds.values())
    ]
    # One read for both: every request counts with its first kind, the others only say what was seen.
    counted = ["ua_kind", "is_hosting", "srr_response_type", "ts"]
    seen = rows.select("user_id", *counted, F.inline(F.array(*values)))
    per = seen.groupBy("user_id", "kind", "h1", "h2").agg(*[a.alias(n) for n, a in sums.items()])
    keyed = with_user_key(with_user(per, t.dim_users, "status").drop("username"), t.dim_users)
    added = [F.max(n) if n == "last_seen" else F.sum(n) for n in sums]
    first = F.col("kind") == 0
    per_value = keyed.groupBy("user_key", "status", "kind", "h1", "h2").agg(*[a.alias(n) for n, a in zip(sums, added)])
    per_name = per_value.groupBy("user_key", "status").agg(
        *[F.count_if(F.col("kind") == k).alias(name) for k, name in enumerate(kinds)],
        *[F.sum(F.when(first, F.col(n))).alias(n) for n in sums if n != "last_seen"],
        F.max("last_seen").alias("last_seen"),
    )
    return top(
        named_users(per_name, t.dim_users).select(
            "username", "status", "requests", *kinds, "scripted", "from_hosting", "refused", "last_seen"
        ),
        [F.desc("requests"), F.asc("username"), F.asc("status")], limit,
    )


def r_client_families(t: Tables, t_from, t_to, limit: int = 15) -> DataFrame:
    per = _requests(t, t_from, t_to).groupBy("ua_family").agg(F.count(F.lit(1)).alias("requests"))
    return top(per, [F.desc("requests"), F.asc("ua_family")], limit)


def r_top_countries(t: Tables, t_from, t_to, limit: int = 15) -> DataFrame:
    rows = _requests(t, t_from, t_to).filter(F.col("country") != "")
    per = rows.groupBy("country").agg(F.count(F.lit(1)).alias("requests"))
    return top(per, [F.desc("requests"), F.asc("country")], limit)


def r_top_networks(t: Tables, t_from, t_to, limit: int = 50) -> DataFrame:
    """Busiest autonomous systems; requests first collapse per system and account."""
    rows = _requests(t, t_from, t_to).filter(F.col("asn") != 0)
    ids = rows.groupBy("asn", "as_org", "user_id").agg(
        F.max("is_hosting").alias("hosting"), F.count(F.lit(1)).alias("requests")
    )
    per = ids.groupBy("asn").agg(
        F.max("as_org").alias("as_org"),
        F.max("hosting").alias("hosting"),
        F.sum("requests").alias("requests"),
        F.count_distinct("user_id").alias("accounts"),
    )
    return top(per, [F.desc("requests"), F.asc("asn")], limit)


_RECENT = (
    "ip", "country", "city", "as_org", "ua_family", "ua_kind", "srr_response_type",
    "srr_rule_name", "user_agent",
)


def r_recent_requests(t: Tables, t_from, t_to, limit: int = 500) -> DataFrame:
    """Latest requests; the cut comes first, names are joined to those rows only."""
    rows = _requests(t, t_from, t_to).select("ts", "user_id", *_RECENT)
    order = [F.desc("ts"), F.asc("user_id"), *[F.asc(c) for c in _RECENT]]
    few = with_user(top(rows, order, limit), t.dim_users)
    return few.select("ts", "username", *_RECENT).orderBy(
        F.desc("ts"), "username", *_RECENT
    )
