"""Address parsing, prefixes and routability against Python's ipaddress."""

import ipaddress

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accesslens.functions.addresses import address, ip_family, ip_is_routable, ip_prefix, masked

LOCAL = {
    4: ["10.0.0.0/8", "127.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "169.254.0.0/16"],
    6: ["::1/128", "fc00::/7", "fe80::/10"],
}
EDGES = """
1.2.3.4|01.2.3.4|1.2.3|1.2.3.4.5|256.1.1.1|::|::1|1::|1:2:3:4:5:6:7:8|1:2:3:4:5:6:7::|::2:3:4:5:6:7:8
1::2::3|:::|1:2:3:4:5:6:7:8:9|1:2:3:4:5:6:7::8|::ffff:1.2.3.4|::1.2.3.4|1:2:3:4:5:6:1.2.3.4
1:2:3:4:5:6:7:1.2.3.4|1:2:3:4:5:1.2.3.4|fe80::1%eth0|fe80::1%|1.2.3.4%eth0|12345::|g::|::ffff:01.2.3.4
1:0:0:2::|0:0:5:1::|fc00::1|fe80::|febf::1|fec0::|10.0.0.7|172.15.0.1|172.16.0.1|172.31.255.255|172.32.0.1
192.168.1.1|169.254.1.1|127.9.9.9|::ffff:10.0.0.1|0.0.0.0|255.255.255.255|:1|1:|1:2|not-an-ip|8.8.8.8
198.18.7.254|2a0b:41:9:3::77|2606:4700:1f::
""".replace("\n", "|").strip("|").split("|")


def expected(text):
    try:
        found = ipaddress.ip_address(text.strip())
    except ValueError:
        return 0, "", False
    if found.version == 6:
        found = ipaddress.IPv6Address(int(found))
        found = found.ipv4_mapped or found
    length = 24 if found.version == 4 else 48
    prefix = str(ipaddress.ip_network(f"{found}/{length}", strict=False))
    local = any(found in ipaddress.ip_network(n) for n in LOCAL[found.version])
    return found.version, prefix, not local


def check(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", ip_family("t"), ip_prefix("t"), ip_is_routable("t")).collect():
        assert tuple(row)[1:] == expected(row.t), row.t


def test_edge_cases(spark):
    check(spark, EDGES + ["", " 1.2.3.4\n", " 8.8.8.8 "])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.one_of(st.ip_addresses().map(str), st.ip_addresses(v=6).map(lambda a: a.exploded)), min_size=50))
def test_any_address(spark, texts):
    check(spark, texts)


def test_known_prefixes(spark):
    cases = {
        "198.18.7.254": "198.18.7.0/24",
        "2a0b:41:9:3::77": "2a0b:41:9::/48",
        "::ffff:45.6.7.8": "45.6.7.0/24",
        "2606:4700:1f::": "2606:4700:1f::/48",
        "1:0:0:2::": "1::/48",
        "0:0:5:1::": "0:0:5::/48",
        "::1": "::/48",
        "01.2.3.4": "",
        "nonsense": "",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.p for r in df.select("t", ip_prefix("t").alias("p")).collect()} == cases


def test_masks(spark):
    cases = [("2001:db8:ffff:1234:5678::1", n) for n in (0, 32, 48, 64, 65, 100, 128)]
    cases += [("1.2.3.255", n) for n in (0, 8, 24, 25, 32)]
    df = spark.createDataFrame(cases, "t string, n int").select("t", "n", address("t").alias("a"))
    for row in df.select("t", "n", masked("a", "n").alias("m")).collect():
        want = ipaddress.ip_network(f"{row.t}/{row.n}", strict=False).network_address
        if want.version == 4:
            assert (row.m.hi, row.m.lo) == (int(want), 0)
        else:
            got = ((row.m.hi % 2**64) << 64) | (row.m.lo % 2**64)
            assert got == int(want)


def test_parsing_uses_no_python_worker(spark):
    plan = spark.range(1).select(ip_prefix("'1.2.3.4'"))._jdf.queryExecution().toString()
    assert "Python" not in plan and F is not None
