"""Per-account abuse score over any time range."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.functions.clients import is_scripted
from accesslens.functions.values import bucket, in_range, is_blocked, or_zero, total, total_bigint
from accesslens.operators.exact_states import KINDS, bit_counts
from accesslens.operators.rollups import distinct_state, merged_count, nonzero, state_count, usage_5m
from accesslens.plans.views import with_user

GIGABYTE = 1073741824.0

# Points per unit and the amount each measure may reach for free.
WEIGHTS: dict[str, float] = {
    "gigabyte": 1,
    "network": 2,
    "country": 5,
    "asn": 2,
    "hosting_ip": 4,
    "user_agent": 2,
    "request": 0.2,
    "scripted": 0.5,
    "blocked": 0.5,
}
FREE: dict[str, int] = {
    "network": 2,
    "country": 1,
    "asn": 2,
    "user_agent": 2,
    "request": 20,
    "blocked": 5,
}

# Which unit each measure is counted in.
UNITS = {
    "prefixes": "network", "countries": "country", "asns": "asn", "hosting_ips": "hosting_ip",
    "sub_uas": "user_agent", "sub_requests": "request", "sub_scripted": "scripted", "sub_blocked": "blocked",
}

MEASURES = (
    "bytes", "traffic_nodes", "ips", "prefixes", "asns", "countries", "nodes", "hosting_ips",
    "sub_requests", "sub_scripted", "sub_blocked", "sub_ips", "sub_uas",
)

_STATES = ("c_ips", "c_prefixes", "c_asns", "c_countries", "c_nodes", "c_hosting_ips", "s_ips", "s_uas")
_SUMS = ("requests", "scripted", "blocked")


def active_universe(usage: DataFrame, conn: DataFrame, sub: DataFrame, t_from, t_to) -> DataFrame:
    """Accounts present in any of the three rollups within the range."""
    parts = [in_range(nonzero(usage), "ts5", t_from, t_to)] + [
        in_range(p, "ts5", t_from, t_to) for p in (conn, sub)
    ]
    ids = [p.select("user_id") for p in parts]
    return ids[0].unionByName(ids[1]).unionByName(ids[2]).distinct()


def account_measures(usage: DataFrame, conn: DataFrame, sub: DataFrame, t_from, t_to) -> DataFrame:
    """Every additive measure per account, in one shuffle.

    The three rollups are stacked under common columns and aggregated once;
    an account in any of them has a row, and what it lacks counts as zero.
    The range filter sits below the aggregate, on the scans.
    """
    # A node's buckets of one account add up first: that is most of the rows.
    u = in_range(nonzero(usage), "ts5", t_from, t_to).groupBy("user_id", "node_id").agg(total("bytes").alias("bytes"))
    c = in_range(conn, "ts5", t_from, t_to).select(
        "user_id", F.col("ips").alias("c_ips"), F.col("prefixes").alias("c_prefixes"),
        F.col("asns").alias("c_asns"), F.col("countries").alias("c_countries"),
        F.col("nodes").alias("c_nodes"), F.col("hosting_ips").alias("c_hosting_ips"),
    )
    s = in_range(sub, "ts5", t_from, t_to).select(
        "user_id", "requests", "scripted", "blocked",
        F.col("ips").alias("s_ips"), F.col("uas").alias("s_uas"),
    )
    stacked = u.unionByName(c, allowMissingColumns=True).unionByName(s, allowMissingColumns=True)
    return stacked.groupBy("user_id").agg(
        or_zero(total_bigint("bytes")).alias("bytes"),
        *[or_zero(F.sum(m)).alias(m) for m in _SUMS],
        state_count(distinct_state(F.col("node_id"))).alias("traffic_nodes"),
        *[merged_count(F.col(m)).alias(m) for m in _STATES],
    ).select(
        "user_id", "bytes", "traffic_nodes",
        *[F.col(f"c_{m}").alias(m) for m in ("ips", "prefixes", "asns", "countries", "nodes", "hosting_ips")],
        F.col("requests").alias("sub_requests"),
        F.col("scripted").alias("sub_scripted"),
        F.col("blocked").alias("sub_blocked"),
        F.col("s_ips").alias("sub_ips"),
        F.col("s_uas").alias("sub_uas"),
    )


def score_sql(weights: Mapping[str, float] | None = None, free: Mapping[str, int] | None = None) -> str:
    """SQL of the additive score over the measure columns, rounded to one digit."""
    w, allowed = {**WEIGHTS, **(weights or {})}, {**FREE, **(free or {})}
    points = [f"bytes / {GIGABYTE}D * {float(w['gigabyte'])}D"] + [
        f"CAST(greatest({measure} - {allowed.get(unit, 0)}, 0) AS DOUBLE) * {float(w[unit])}D"
        for measure, unit in UNITS.items()
    ]
    return f"rint(({' + '.join(points)}) * 10D) / 10D"


GIGABYTES_SQL = f"rint(bytes / {GIGABYTE}D * 100D) / 100D"


def score(weights: Mapping[str, float] | None = None, free: Mapping[str, int] | None = None) -> Column:
    return F.expr(score_sql(weights, free))


def scored_measures(
    usage: DataFrame, conn: DataFrame, sub: DataFrame, t_from, t_to,
    weights: Mapping[str, float] | None = None, free: Mapping[str, int] | None = None,
) -> DataFrame:
    """Measures with ``gigabytes`` and ``score``; no names, so no dimension join."""
    measures = account_measures(usage, conn, sub, t_from, t_to)
    return measures.withColumns({"gigabytes": F.expr(GIGABYTES_SQL), "score": score(weights, free)})


def user_abuse(
    usage: DataFrame,
    conn: DataFrame,
    sub: DataFrame,
    dim_users: DataFrame,
    t_from,
    t_to,
    weights: Mapping[str, float] | None = None,
    free: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per account active in the range: identity, measures and score."""
    return named_scores(scored_measures(usage, conn, sub, t_from, t_to, weights, free), dim_users)


def named_scores(scored: DataFrame, dim_users: DataFrame) -> DataFrame:
    return with_user(scored, dim_users, "status", "tag", "hwid_device_limit").select(
        "user_id", "username", "status", "tag", "hwid_device_limit", "bytes", "gigabytes",
        *MEASURES[1:], "score",
    )


def exact_measures(usage: DataFrame, connections: DataFrame, requests: DataFrame, t_from, t_to) -> DataFrame:
    """The measures from raw facts with exact distinct counts at any size.

    Every value becomes a narrow ``(account, kind, hash)`` row that is
    de-duplicated before it is counted; no sketch is involved. The range
    applies to five-minute buckets, as it does on the rollups. Zero sums of a
    bucket vanish as they do there.
    """
    rolled = in_range(nonzero(usage_5m(usage)), "ts5", t_from, t_to)
    conn = in_range(connections.withColumn("ts5", bucket(F.col("ts"))), "ts5", t_from, t_to)
    sub = in_range(requests.withColumn("ts5", bucket(F.col("ts"))), "ts5", t_from, t_to)
    sums = rolled.select("user_id", "bytes").unionByName(
        sub.select(
            "user_id",
            F.lit(1).alias("requests"),
            is_scripted(F.col("ua_kind")).cast("int").alias("scripted"),
            is_blocked(F.col("srr_response_type")).alias("blocked"),
        ),
        allowMissingColumns=True,
    )

    def values(df: DataFrame, **kinds: Column) -> DataFrame:
        # Two hashes are 128 bits: fixed width, whatever the text.
        made = [
            F.struct(
                F.lit(k).alias("kind"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(7), v).alias("h2"),
                v.isNotNull().alias("has"),
            )
            for k, v in kinds.items()
        ]
        return df.select("user_id", F.inline(F.array(*made))).filter("has").drop("has")

    country, hosting = F.when(F.col("country") != "", F.col("country")), F.when(F.col("is_hosting") == 1, F.col("ip"))
    seen = (
        values(rolled, traffic_nodes=F.col("node_id"))
        .unionByName(values(
            conn, ips=F.col("ip"), prefixes=F.col("ip_prefix"), asns=F.col("asn").cast("string"), countries=country,
            nodes=F.col("node_id").cast("string"), hosting_ips=hosting,
        ))
        .unionByName(values(sub, sub_ips=F.col("ip"), sub_uas=F.col("user_agent")))
    )
    distinct = ("traffic_nodes", "ips", "prefixes", "asns", "countries", "nodes", "hosting_ips", "sub_ips", "sub_uas")
    counted = seen.distinct().groupBy("user_id").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in distinct])
    added = sums.groupBy("user_id").agg(
        or_zero(total_bigint("bytes")).alias("bytes"),
        *[or_zero(F.sum(c)).alias(f"sub_{c}") for c in ("requests", "scripted", "blocked")],
    )
    joined = counted.join(added.withColumnRenamed("user_id", "_user"), F.col("user_id") == F.col("_user"), "full")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in MEASURES]
    return joined.select(F.coalesce("user_id", "_user").alias("user_id"), *zero)


def exact_rolled_abuse(
    usage: DataFrame, conn: DataFrame, sub: DataFrame, states: DataFrame, dim_users: DataFrame, t_from, t_to,
    weights: Mapping[str, float] | None = None, free: Mapping[str, int] | None = None,
) -> DataFrame:
    """``user_abuse`` from rollups, exact at any number of distinct values.

    ``states`` are the bit states of large accounts; all others have so few values
    that their sketches hold them all. Nodes with traffic are fewer than that for anyone.
    """
    measures = account_measures(usage, conn, sub, t_from, t_to)
    counted = bit_counts(in_range(states, "ts5", t_from, t_to)).withColumnsRenamed({k: f"_{k}" for k in KINDS})
    joined = measures.join(counted.withColumnRenamed("user_id", "_user"), F.col("user_id") == F.col("_user"), "left")
    measures = joined.withColumns({k: F.coalesce(f"_{k}", k) for k in KINDS}).select(measures.columns)
    scored = measures.withColumns({"gigabytes": F.expr(GIGABYTES_SQL), "score": score(weights, free)})
    return named_scores(scored, dim_users)


def exact_abuse(usage, connections, requests, dim_users, t_from, t_to, weights=None, free=None) -> DataFrame:
    """``user_abuse`` from raw facts, exact at any number of distinct values."""
    measures = exact_measures(usage, connections, requests, t_from, t_to)
    scored = measures.withColumns({"gigabytes": F.expr(GIGABYTES_SQL), "score": score(weights, free)})
    return named_scores(scored, dim_users)
