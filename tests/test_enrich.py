"""Network lookups against brute force, on both join strategies."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from accesslens.operators import networks
from accesslens.operators.enrich import ASN_COLUMNS, CITY_COLUMNS, enrich_requests, geo_enrich, parsed_addresses
from accesslens.operators.networks import index_networks, lookup, network_table

COLUMNS = ("country", "city", "asn", "as_org", "is_hosting")


def random_ranges(rng):
    """Disjoint ranges of very different sizes, some touching, some apart."""
    ranges, start = [], int(ipaddress.ip_address("20.0.0.0"))
    for i in range(60):
        size = rng.choice([1, 3, 40, 256, 900, 4096, 5000, 65535, 65536, 70000, 300000])
        start += rng.choice([0, 0, 1, 77, 5000])
        ranges.append((start, start + size - 1, i + 1, f"org {i}"))
        start += size
    return ranges


def test_range_lookup_matches_brute_force(spark):
    rng = random.Random(5)
    ranges = random_ranges(rng)
    probes = {p for lo, hi, _, _ in ranges for p in (lo - 1, lo, (lo + hi) // 2, hi, hi + 1)}
    probes |= {rng.randrange(ranges[0][0], ranges[-1][1] + 100) for _ in range(300)}
    ips = spark.createDataFrame([(str(ipaddress.ip_address(p)),) for p in probes], "ip string")
    nets = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, asn bigint, as_org string")
    index = index_networks(nets, ("asn",))
    for small in (True, False):
        joined, found = lookup(parsed_addresses(ips, "ip"), index, small=small)
        rows = joined.select("ip", found["asn"].alias("asn")).collect()
        assert len(rows) == len(probes)
        for row in rows:
            n = int(ipaddress.ip_address(row.ip))
            assert row.asn == next((a for lo, hi, a, _ in ranges if lo <= n <= hi), None), row.ip


def test_overlapping_and_repeated_ranges(spark):
    """The smallest range counts; rows never multiply."""
    rng = random.Random(11)
    ranges = []
    for i in range(150):
        start = int(ipaddress.ip_address("30.0.0.0")) + rng.randrange(1 << 20)
        ranges.append((start, start + rng.choice([0, 5, 300, 5000, 70000, 1 << 20]), i + 1))
    ranges.append((int(ipaddress.ip_address("0.0.0.0")), int(ipaddress.ip_address("255.255.255.255")), 999))
    probes = {p for lo, hi, _ in ranges for p in (lo, hi, (lo + hi) // 2)} | {5}
    ips = spark.createDataFrame([(str(ipaddress.ip_address(p)),) for p in probes], "ip string")
    nets = spark.createDataFrame(ranges * 2, "start_ip bigint, end_ip bigint, asn bigint")
    joined, found = lookup(parsed_addresses(ips, "ip"), index_networks(nets, ("asn",)), small=True)
    rows = joined.select("ip", found["asn"].alias("asn")).collect()
    assert len(rows) == len(probes)
    for row in rows:
        n = int(ipaddress.ip_address(row.ip))
        if not ipaddress.ip_address(row.ip).is_private:
            assert row.asn == max((lo - hi, lo, a) for lo, hi, a in ranges if lo <= n <= hi)[2], row.ip


def test_lookup_is_an_equi_join(spark):
    ips = spark.range(10).selectExpr("concat('20.0.0.', id) AS ip")
    nets = spark.createDataFrame([("20.0.0.0/30", 3), ("2a00::/20", 4)], "network string, asn bigint")
    joined, _ = lookup(parsed_addresses(ips, "ip"), index_networks(nets, ("asn",)), small=False)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "Generate" not in plan


def test_the_sweep_leaves_disjoint_intervals_with_the_smallest_range_on_top():
    rng = random.Random(3)
    for _ in range(50):
        ranges = [(a, b, b - a, a) for a, b in (sorted((rng.randrange(60), rng.randrange(60))) for _ in range(rng.randrange(1, 30)))]
        found = networks.sweep(ranges)
        assert all(a[1] < b[0] for a, b in zip(found, found[1:])) and all(a <= b for a, b, _ in found)
        for n in range(61):
            holds = [(size, -begin) for first, last, size, begin in ranges if first <= n <= last]
            top = [ranges[i][2:] for a, b, i in found if a <= n <= b]
            assert [(size, -begin) for size, begin in top] == ([min(holds)] if holds else [])


def test_ten_thousand_ranges_inside_one_subnet_and_the_widest_around(spark):
    """Blocks stay bounded whatever the networks: all of IPv6, nested ones, and many within one /64."""
    inner = [(str(ipaddress.ip_network(((0x2A02 << 112) + (i << 20), 112 + i % 16), strict=False)), i) for i in range(10_000)]
    wide = [("::/0", -1), ("2a00::/11", -2), ("2a02::/16", -3), ("2a02::/60", -4), ("0.0.0.0/0", -5)]
    nets = spark.createDataFrame(inner + wide + inner[:50], "network string, asn bigint")
    index = index_networks(nets, ("asn",))
    assert index.blocks.agg(F.max(F.size("starts"))).first()[0] <= networks.BLOCK
    intervals = index.blocks.agg(F.sum(F.size("starts"))).first()[0]
    assert intervals <= 2 * (len(inner) + len(wide))
    parsed = [(ipaddress.ip_network(n), v) for n, v in inner[::97] + wide]
    probes = {str(n.network_address + 1) for n, _ in parsed if n.version == 6} | {"2a02:0:0:1::5", "2a02:1::", "2a1f::1", "f000::1", "8.8.8.8"}
    joined, found = lookup(parsed_addresses(spark.createDataFrame([(p,) for p in probes], "ip string"), "ip"), index, small=True)
    every = [(ipaddress.ip_network(n), v) for n, v in inner + wide]
    for row in joined.select("ip", found["asn"].alias("asn")).collect():
        ip = ipaddress.ip_address(row.ip)
        want = max(((n.prefixlen, v) for n, v in every if n.version == ip.version and ip in n), default=(0, None))[1]
        assert row.asn == (None if ip == ipaddress.ip_address("::1") else want), row.ip


def test_many_cells_give_the_same_index(spark, monkeypatch):
    rng = random.Random(9)
    ranges = []
    for i in range(400):
        start = rng.randrange(1 << 32)
        ranges.append((start, min((1 << 32) - 1, start + rng.choice([0, 9, 1 << 10, 1 << 20, 1 << 28, 1 << 31])), i))
    ips = spark.createDataFrame([(str(ipaddress.ip_address(p)),) for lo, hi, _ in ranges for p in (lo, hi, (lo + hi) // 2)], "ip string")
    nets = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, asn bigint").repartition(3)

    def answers():
        joined, found = lookup(parsed_addresses(ips, "ip"), index_networks(nets, ("asn",)), small=True)
        return sorted((r.ip, r.asn if r.asn is not None else -1) for r in joined.select("ip", found["asn"].alias("asn")).collect())

    want = answers()
    monkeypatch.setattr(networks, "CELL", 16)
    monkeypatch.setattr(networks, "BLOCK", 4)
    assert answers() == want
    celled = networks._celled(networks._ranges(nets, ("asn",)).selectExpr("family AS f", "s_hi", "s_lo", "e_hi", "e_lo", "hit"), [networks._number(4, i << 24, 0) for i in range(1, 250)])
    assert celled.count() <= 2 * 400 + 250 * 3 * 2


def test_longest_prefix_wins(spark):
    rng = random.Random(7)
    nets = [("0.0.0.0/0", 1), ("20.0.0.0/8", 2), ("2a02::/16", 3), ("2a02:6ea0::/32", 4), ("::/0", 5), ("8000::/1", 6)]
    for i in range(80):
        length = rng.choice([9, 12, 16, 20, 24, 30, 32])
        nets.append((str(ipaddress.ip_network((20 << 24 | rng.getrandbits(24), length), strict=False)), 100 + i))
        length = rng.choice([33, 40, 48, 64, 65, 100, 127, 128])
        nets.append(
            (str(ipaddress.ip_network(((0x2A026EA0 << 96) | rng.getrandbits(96), length), strict=False)), 300 + i)
        )
    nets = list(dict(nets).items())
    parsed = [(ipaddress.ip_network(n), v) for n, v in nets]
    ips = {str(n.network_address + rng.randrange(min(n.num_addresses, 1 << 60))) for n, _ in parsed for _ in range(3)}
    ips |= {"8.8.8.8", "2001:db8::1", "f000::1", "10.0.0.1", "junk", "::ffff:20.1.2.3"}
    df = parsed_addresses(spark.createDataFrame([(i,) for i in ips], "ip string"), "ip")
    junk = [("20.0.0.0/40", 7), ("20.0.0.0/x", 8), ("junk/8", 9)]
    index = index_networks(spark.createDataFrame(nets + junk, "network string, asn bigint"), ("asn",))
    joined, found = lookup(df, index, small=True)

    def want(text):
        try:
            ip = ipaddress.ip_address(text)
        except ValueError:
            return None
        ip = getattr(ip, "ipv4_mapped", None) or ip
        if text == "10.0.0.1":
            return None
        return max(((n.prefixlen, v) for n, v in parsed if ip in n), default=(0, None))[1]

    rows = joined.select("ip", found["asn"].alias("asn")).collect()
    assert {r.ip: r.asn for r in rows} == {i: want(i) for i in ips}


RANGES = [
    (int(ipaddress.ip_address("8.8.8.0")), int(ipaddress.ip_address("8.8.8.255")), "US", "", "Reno", 15169, "Google LLC"),
    (int(ipaddress.ip_address("77.0.0.0")), int(ipaddress.ip_address("77.255.255.255")), "", "RU", None, 12389, "Rostelecom"),
    (int(ipaddress.ip_address("10.0.0.0")), int(ipaddress.ip_address("10.255.255.255")), "XX", "", "x", 1, "never"),
]
SCHEMA = (
    "start_ip bigint, end_ip bigint, country string, registered_country string, city string, "
    "asn bigint, as_org string"
)
EXPECTED = {
    "8.8.8.8": ("8.8.8.0/24", "US", "Reno", 15169, "Google LLC", 1),
    " 8.8.8.8 ": ("8.8.8.0/24", "US", "Reno", 15169, "Google LLC", 1),
    "::ffff:8.8.8.8": ("8.8.8.0/24", "US", "Reno", 15169, "Google LLC", 1),
    "77.1.2.3": ("77.1.2.0/24", "RU", "", 12389, "Rostelecom", 0),
    "10.0.0.7": ("10.0.0.0/24", "", "", 0, "", 0),
    "9.9.9.9": ("9.9.9.0/24", "", "", 0, "", 0),
    "2a0b:41:9::1": ("2a0b:41:9::/48", "", "", 0, "", 0),
    "not-an-ip": ("", "", "", 0, "", 0),
    "": ("", "", "", 0, "", 0),
}


@pytest.mark.parametrize("shape", ["ranges", "shuffled", "cidr", "two tables", "mixed", "indexed"])
def test_geo_enrich(spark, shape):
    nets = spark.createDataFrame(RANGES, SCHEMA)
    cidr = spark.createDataFrame(
        [("8.8.8.0/24", *RANGES[0][2:]), ("77.0.0.0/8", *RANGES[1][2:]), ("10.0.0.0/8", *RANGES[2][2:])],
        SCHEMA.replace("start_ip bigint, end_ip bigint", "network string"),
    )
    city, asn, options = {
        "ranges": (nets, nets, {}),
        "shuffled": (nets, nets, {"broadcast_bytes": 0}),
        "cidr": (cidr, cidr, {}),
        "two tables": (nets, nets.select("*"), {}),
        "mixed": (nets, cidr, {}),
        "indexed": (index_networks(cidr, CITY_COLUMNS + ASN_COLUMNS),) * 2 + ({},),
    }[shape]
    df = spark.createDataFrame([(i,) for i in EXPECTED], "ip string")
    out = geo_enrich(df.union(df), "ip", city, asn, **options)
    rows = out.select("ip", "ip_prefix", *COLUMNS).collect()
    assert len(rows) == 2 * len(EXPECTED)
    for row in rows:
        assert tuple(row)[1:] == EXPECTED[row.ip], row.ip


def test_empty_network_table(spark):
    df = spark.createDataFrame([("8.8.8.8",)], "ip string")
    nets = spark.createDataFrame([], SCHEMA)
    row = geo_enrich(df, "ip", nets, nets).select("ip_prefix", *COLUMNS).first()
    assert tuple(row) == ("8.8.8.0/24", "", "", 0, "", 0)


def test_missing_network_tables(spark):
    df = spark.createDataFrame([("8.8.8.8",), ("not-an-ip",)], "ip string")
    rows = geo_enrich(df, "ip", None, None).select("ip_prefix", *COLUMNS).collect()
    assert [tuple(r) for r in rows] == [("8.8.8.0/24", "", "", 0, "", 0), ("", "", "", 0, "", 0)]
    half = geo_enrich(df, "ip", None, spark.createDataFrame(RANGES, SCHEMA)).select("country", "asn").collect()
    assert [tuple(r) for r in half] == [("", 15169), ("", 0)]


def test_custom_keywords(spark):
    nets = spark.createDataFrame(RANGES, SCHEMA)
    df = spark.createDataFrame([("77.1.2.3", "curl/8")], "ip string, user_agent string")
    row = enrich_requests(df, nets, nets, keywords=["ROSTELECOM"]).first()
    assert (row.is_hosting, row.ua_family, row.ua_kind) == (1, "curl", "script")
    assert network_table(nets, ("is_hosting",)).filter("is_hosting = 1").count() == 1


def test_hot_address_is_split(spark):
    """One address with most of the rows: AQE splits its partition in the join back."""
    saved = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in saved}
    try:
        for key, value in saved.items():
            spark.conf.set(key, value)
        df = spark.range(0, 60000, 1, 8).selectExpr(
            "IF(id % 3 = 0, '8.8.8.8', concat('77.', id % 200, '.', id % 251, '.9')) AS ip", "id"
        )
        nets = spark.createDataFrame(RANGES, SCHEMA)
        out = geo_enrich(df, "ip", nets, nets, broadcast_bytes=0)
        counts = {r.country: r["count"] for r in out.groupBy("country").count().collect()}
        assert counts == {"US": 20000, "RU": 40000}
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
