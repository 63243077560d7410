"""Address and client enrichment of fact rows.

Network tables come as IPv4 ranges (``start_ip``, ``end_ip``) or as CIDR text
(``network``, both families); ``index_networks`` flattens either into disjoint
intervals, and a lookup is one equi-join that never multiplies a fact row.

When the index is measured to be small it is broadcast and no fact row is
shuffled. Otherwise distinct addresses are looked up and the result is joined
back; addresses that cannot match take no part in that join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.functions.addresses import address, prefix_of, routable
from accesslens.functions.clients import ua_classify
from accesslens.operators.networks import NetworkIndex, index_networks, lookup

CITY_COLUMNS = ("country", "city")
ASN_COLUMNS = ("asn", "as_org", "is_hosting")

# What a lookup may send to every executor, all grids together, as rows of the
# index count: see ``NetworkIndex.bytes``.
BROADCAST_BYTES = 256 * 1024 * 1024


def parsed_addresses(df: DataFrame, ip_col: str) -> DataFrame:
    """``df`` with the parsed address and whether it can be looked up."""
    return df.select("*", address(ip_col).alias("_addr")).select("*", routable("_addr").alias("_routable"))


Networks = DataFrame | NetworkIndex


def _index(nets: Networks, values: Sequence[str], keywords: Iterable[str] | None) -> NetworkIndex:
    return nets if isinstance(nets, NetworkIndex) else index_networks(nets, values, keywords)


def geo_enrich(
    df: DataFrame,
    ip_col: str,
    city_nets: Networks | None,
    asn_nets: Networks | None,
    keywords: Iterable[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``ip_prefix``, ``country``, ``city``, ``asn``, ``as_org``, ``is_hosting``.

    Either network table may be None; its columns then stay empty. One table
    passed for both is looked up once. Tables may be indexed beforehand with
    ``index_networks``. Text that is no address leaves everything empty, a
    private address only has a prefix.
    """
    if city_nets is not None and city_nets is asn_nets:
        wanted = [(city_nets, CITY_COLUMNS + ASN_COLUMNS)]
    else:
        wanted = [(n, c) for n, c in ((city_nets, CITY_COLUMNS), (asn_nets, ASN_COLUMNS)) if n is not None]
    indexes = [_index(nets, columns, keywords) for nets, columns in wanted]
    small = sum(index.bytes for index in indexes) <= broadcast_bytes

    def looked_up(addresses: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        found: dict[str, Column] = {}
        for i, index in enumerate(indexes):
            addresses, hit = lookup(addresses, index, small=small, tag=f"t{i}")
            found.update(hit)
        return addresses, found

    parsed = parsed_addresses(df, ip_col)
    if small:
        joined, found = looked_up(parsed)
    else:
        distinct = parsed.filter("_routable").select(F.col(ip_col).alias("_ip"), "_addr", "_routable")
        known, hit = looked_up(distinct.dropDuplicates(["_ip"]))
        known = known.select(F.col("_ip").alias("_known_ip"), *[v.alias(f"_{c}") for c, v in hit.items()])
        # One hot address may hold a large share of the rows; AQE splits its
        # partition on the fact side, the other side has one row per address.
        # What cannot match is spread instead of meeting under one key.
        other = F.concat(F.lit("!"), F.xxhash64(*[df[c] for c in df.columns]).cast("string"))
        key = F.when(F.col("_routable"), F.col(ip_col)).otherwise(other)
        joined = parsed.withColumn("_key", key).join(known, F.col("_key") == F.col("_known_ip"), "left")
        found = {c: F.col(f"_{c}") for c in hit}
    empty = {"asn": F.lit(0).cast("bigint"), "is_hosting": F.lit(0)}
    return joined.select(
        *df.columns,
        prefix_of("_addr").alias("ip_prefix"),
        *[
            F.coalesce(*([found[c]] if c in found else []), empty.get(c, F.lit(""))).alias(c)
            for c in CITY_COLUMNS + ASN_COLUMNS
        ],
    )


def enrich_requests(rows: DataFrame, city_nets=None, asn_nets=None, keywords=None) -> DataFrame:
    """Subscription fetches with address and client columns."""
    out = geo_enrich(rows, "ip", city_nets, asn_nets, keywords)
    return out.select("*", ua_classify("user_agent").alias("_client")).select(
        *out.columns, F.col("_client.family").alias("ua_family"), F.col("_client.kind").alias("ua_kind")
    )


def enrich_connections(rows: DataFrame, city_nets=None, asn_nets=None, keywords=None) -> DataFrame:
    """Node connections with address columns."""
    return geo_enrich(rows, "ip", city_nets, asn_nets, keywords)
