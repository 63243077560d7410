"""Fact views with names resolved, and the bundle of tables they read."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions.values import as_bigint, display_name, is_blocked
from accesslens.operators.latest import latest
from accesslens.operators.rollups import merge_usage


@dataclass
class Tables:
    """Everything the reports read. Rollups may hold unmerged partials."""

    usage_5m: DataFrame | None = None
    user_conn_5m: DataFrame | None = None
    sub_req_5m: DataFrame | None = None
    sub_requests: DataFrame | None = None
    node_connections: DataFrame | None = None
    dim_users: DataFrame | None = None
    dim_nodes: DataFrame | None = None


def v_users(dim_users: DataFrame) -> DataFrame:
    """Newest row per account."""
    return latest(dim_users, "user_id").drop("updated_at")


def v_nodes(dim_nodes: DataFrame) -> DataFrame:
    """Newest row per node."""
    return latest(dim_nodes, "node_id").select(
        "node_id", F.col("name").alias("node_name"), "country_code"
    )


def with_node_name(df: DataFrame, dim_nodes: DataFrame) -> DataFrame:
    """Add ``node_name``; a node without a usable name shows as ``node-<id>``.

    No broadcast is forced: Catalyst and AQE broadcast the dimension while its
    measured size allows and split skewed partitions otherwise.
    """
    names = latest(dim_nodes.select("node_id", "updated_at", "name"), "node_id")
    names = names.select(F.col("node_id").alias("_key"), F.col("name").alias("_name"))
    name = display_name("_name", "node", "node_id")
    return df.join(names, F.expr("node_id = _key"), "left").select(*df.columns, name.alias("node_name"))


def with_user(df: DataFrame, dim_users: DataFrame, *extra: str) -> DataFrame:
    """Add ``username`` and any of ``status``, ``tag``, ``hwid_device_limit``.

    Accounts missing from the dimension get ``user-<id>`` and empty values.
    Only the columns asked for are read from the dimension.
    """
    users = latest(dim_users.select("user_id", "updated_at", "username", *extra), "user_id").select(
        F.col("user_id").alias("_key"), F.col("username").alias("_name"), *[F.col(c).alias(f"_{c}") for c in extra]
    )
    empty = {"hwid_device_limit": "0L"}
    return df.join(users, F.expr("user_id = _key"), "left").select(
        *df.columns,
        display_name("_name", "user", "user_id").alias("username"),
        *[F.expr(f"coalesce(_{c}, {empty.get(c, repr(''))})").alias(c) for c in extra],
    )


def _keys(dim: DataFrame, key: str, name: str, kind: str) -> DataFrame:
    """``_id`` -> ``_key``: the smallest id that shows under the same display name.

    Ids that are not listed are their own key; only those that are not are listed, so
    where names differ the table is empty. Names are counted before they meet, and the
    join back leaves a name that many ids share to AQE's split. A row named ``<kind>-<id>`` shares
    its name with that id if the id has no usable name itself.
    """
    named = latest(dim.select(key, "updated_at", name), key).filter(F.col(name) != "")
    borrowed = F.when(
        F.col(name).rlike(f"^{kind}-(0|[1-9][0-9]{{0,17}})$"), F.substring(name, len(kind) + 2, 20).cast("bigint")
    )
    # Own names win over borrowed ones.
    both = F.array(
        F.struct(F.col(key).alias("_id"), F.lit(1).alias("own"), F.col(name).alias("_name")),
        F.struct(borrowed.alias("_id"), F.lit(0).alias("own"), F.col(name).alias("_name")),
    )
    members = named.select(F.inline(both)).filter("_id IS NOT NULL")
    members = members.groupBy("_id").agg(F.max(F.struct("own", "_name")).alias("m")).select("_id", "m._name")
    shared = members.groupBy("_name").agg(F.min("_id").alias("_key"), F.max("_id").alias("_last")).filter("_last > _key")
    return members.join(shared, "_name").filter("_id > _key").select("_id", "_key")


def with_user_key(df: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Add ``user_key``, a number that stands for the display name of the account.

    Aggregates run on it; ``with_user`` on the key gives the name of what is left.
    """
    joined = df.join(_keys(dim_users, "user_id", "username", "user"), F.expr("user_id = _id"), "left")
    return joined.select(*df.columns, F.coalesce("_key", "user_id").alias("user_key"))


def with_node_key(df: DataFrame, dim_nodes: DataFrame) -> DataFrame:
    """Add ``node_key``, a number that stands for the display name of the node."""
    joined = df.join(_keys(dim_nodes, "node_id", "name", "node"), F.expr("node_id = _id"), "left")
    return joined.select(*df.columns, F.coalesce("_key", "node_id").alias("node_key"))


def nodes_named(dim_nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """``node_id`` of the nodes that show under one of the names."""
    known = latest(dim_nodes.select("node_id", "updated_at", "name"), "node_id")
    shown = known.filter(display_name("name", "node", "node_id").isin(*names)).select("node_id")
    ids = sorted({int(n[5:]) for n in names if re.fullmatch(r"node-(0|[1-9][0-9]{0,17})", n)})
    if not ids:
        return shown
    listed = dim_nodes.sparkSession.range(1).select(F.explode(F.array(*[F.lit(i).cast("bigint") for i in ids])).alias("node_id"))
    return shown.unionByName(listed.join(known.select("node_id"), "node_id", "anti"))


def named_users(df: DataFrame, dim_users: DataFrame, keep: bool = False) -> DataFrame:
    """Replace ``user_key`` by ``username``, or add it."""
    named = with_user(df.withColumn("user_id", F.col("user_key")), dim_users).drop("user_id")
    return named if keep else named.drop("user_key")


def partition_of(df: DataFrame) -> list[str]:
    """The partition column of a stored table, which the views pass on: SQL that filters on it reads less."""
    return [c for c in ("month", "day") if c in df.columns]


def v_usage(usage_5m: DataFrame, dim_users: DataFrame, dim_nodes: DataFrame) -> DataFrame:
    named = with_user(merge_usage(usage_5m), dim_users, "status", "tag")
    return with_node_name(named, dim_nodes).select(
        "ts5", "node_id", "node_name", "user_id", "username", "status", "tag",
        as_bigint(F.col("bytes")).alias("bytes"), *partition_of(usage_5m),
    )


def v_connections(node_connections: DataFrame, dim_users: DataFrame, dim_nodes: DataFrame) -> DataFrame:
    named = with_user(node_connections, dim_users, "status", "hwid_device_limit")
    return with_node_name(named, dim_nodes).select(
        "ts", "node_id", "node_name", "user_id", "username", "status", "hwid_device_limit",
        "ip", "ip_prefix", "last_seen", "country", "city", "asn", "as_org", "is_hosting",
        *partition_of(node_connections),
    )


def v_sub_requests(sub_requests: DataFrame, dim_users: DataFrame) -> DataFrame:
    return with_user(sub_requests, dim_users, "status").select(
        "ts", "user_id", "username", "status", "ip", "ip_prefix", "country", "city", "asn",
        "as_org", "is_hosting", "user_agent", "ua_family", "ua_kind", "srr_response_type",
        "srr_rule_name", is_blocked(F.col("srr_response_type")).alias("is_blocked"),
        *partition_of(sub_requests),
    )
