"""Facts, dimensions, networks and messages derived from the test tables.

The tables under test hold none of the engine's own inputs, so every query
derives them from ``events``, ``customer``, ``supplier`` and ``nation``: whole
tables, plain column expressions, nothing random.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession

from accesslens.operators import rollups
from accesslens.operators.decode import CONNECTION_STREAM, REQUEST_STREAM, USAGE_STREAM
from accesslens.operators.enrich import enrich_connections, enrich_requests
from accesslens.sources.dimensions import NODES_PAGE, USERS_PAGE

# The whole span of the events, seen through closed bounds.
T_FROM, T_TO = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
# A range with both edges inside the data.
EDGE_FROM, EDGE_TO = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
# Accounts up to this id are in the facts but in no dimension.
USER_SHIFT = 25
AS_OF, EARLIER = "2024-02-01 00:00:00", "2024-01-31 00:00:00"

USER_AGENTS = (
    "Happ/3.11 Android 14",
    "curl/7.81",
    "python-requests/2.19",
    "iPhone15,2 Streisand/2.0.1",
    "Mozilla/5.0 (X11; Linux x86_64) Chrome/131.0.0.0 Safari/537.36",
    "Some TelegramBot 1.0",
    "",
    "nothing known 0.1",
)
RESPONSES = {"error": "BLOCK", "signup": "STATUS_CODE_404", "click": "XRAY_JSON", "view": "SINGBOX"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _case(value: str, results: dict, other: str = "''") -> str:
    tests = " ".join(f"WHEN {key} THEN {result}" for key, result in results.items())
    return f"CASE {value} {tests} ELSE {other} END"


def _repeated(ev: DataFrame, *columns: str) -> DataFrame:
    """Every event three times, 0, 2 and 4 minutes after its time."""
    at = "CAST(date_trunc('MILLISECOND', ts + k * INTERVAL '2' MINUTE) AS TIMESTAMP_NTZ) AS ts"
    return ev.selectExpr("*", "explode(array(0, 1, 2)) AS k").selectExpr(at, *columns)


_NODE = "event_id % 7 + 1"
_SEEN = "CAST(date_trunc('MILLISECOND', ts) AS TIMESTAMP_NTZ)"


def _bytes(k: str = "k") -> str:
    """Traffic of repetition ``k``; every fiftieth event moves nothing."""
    return f"IF(event_id % 50 = 0, 0L, CAST(round(value * 100) AS BIGINT) * 104857 * ({k} + 1))"


def _ip(k: str = "k") -> str:
    """Address of repetition ``k``: empty, IPv6, private or public."""
    return _case(
        f"(event_id + {k}) % 10",
        {
            0: "''",
            1: "concat('2a02:6ea0:', user_id % 90, '::', event_id % 9 + 1)",
            2: "concat('10.0.', user_id % 5, '.', event_id % 25)",
        },
        "concat(event_id % 23 + 20, '.', user_id % 200, '.', event_id % 13, '.', event_id % 40)",
    )


def _user_agent(k: str = "k") -> str:
    numbered = {i: f"'{agent}'" for i, agent in enumerate(USER_AGENTS)}
    return _case(f"(event_id + {k}) % {len(USER_AGENTS)}", numbered)


_RESPONSE = _case("event_type", {f"'{kind}'": f"'{response}'" for kind, response in RESPONSES.items()})
_RULE = "IF(event_id % 3 = 0, '', concat('rule-', event_id % 4))"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def usage_facts(ev: DataFrame) -> DataFrame:
    return _repeated(ev, f"{_NODE} AS node_id", "user_id", f"{_bytes()} AS bytes")


def request_rows(ev: DataFrame) -> DataFrame:
    return _repeated(
        ev, "user_id", f"{_ip()} AS ip", f"{_user_agent()} AS user_agent",
        f"{_RESPONSE} AS srr_response_type", f"{_RULE} AS srr_rule_name",
    )


def connection_rows(ev: DataFrame) -> DataFrame:
    return _repeated(ev, f"{_NODE} AS node_id", "user_id", f"{_ip()} AS ip", f"{_SEEN} AS last_seen")


def geo_networks(spark: SparkSession, sf: str) -> DataFrame:
    """One /8 range per nation; the ranges start above the lowest addresses, which stay unknown."""
    org = _case(
        "n_nationkey % 4",
        {0: "'Example Hosting Ltd'", 1: "'Residential Telecom'", 2: "'Sample Cloud Inc'"},
        "'Mobile Networks'",
    )
    return table(spark, sf, "nation").selectExpr(
        "(n_nationkey + 24L) * 16777216 AS start_ip",
        "(n_nationkey + 25L) * 16777216 - 1 AS end_ip",
        "n_name AS country",
        "concat('City_', n_nationkey) AS city",
        "n_nationkey + 1000L AS asn",
        f"{org} AS as_org",
    )


def fine_networks(spark: SparkSession, sf: str) -> DataFrame:
    """One disjoint range per supplier, from forty addresses to a whole /16."""
    first = (
        "(s_suppkey DIV 200 + 20) * 16777216 + s_suppkey % 200 * 65536"
        " + IF(s_suppkey % 4 = 0, 0, s_suppkey % 5 * 256 + s_suppkey % 16)"
    )
    size = _case("s_suppkey % 4", {0: 65536, 1: 40, 2: 1500}, "5000")
    return table(spark, sf, "supplier").selectExpr(
        f"{first} AS start_ip", f"{first} + {size} - 1 AS end_ip", "s_suppkey + 1 AS asn", "s_name AS as_org"
    )


def cidr_networks(spark: SparkSession, sf: str) -> DataFrame:
    """Nested networks of both families: /8 per nation, /16, /24 and /48 per supplier."""
    block = "concat(s_nationkey + 20, '.', s_suppkey % 200, '."
    parts = (
        table(spark, sf, "nation").selectExpr(
            "concat(n_nationkey + 20, '.0.0.0/8') AS network", "n_name AS as_org"
        ),
        table(spark, sf, "supplier").selectExpr(
            f"explode(array({block}0.0/16'), {block}', s_suppkey % 13, '.0/24'),"
            " concat('2a02:6ea0:', s_suppkey, '::/48'))) AS network",
            "s_name AS as_org",
        ),
        table(spark, sf, "region").selectExpr("'2a02:6ea0::/32' AS network", "r_name AS as_org"),
    )
    return reduce(DataFrame.unionByName, parts).selectExpr("*", "CAST(length(as_org) AS BIGINT) AS asn")


def overlapping_networks(spark: SparkSession, sf: str) -> DataFrame:
    """The /8 ranges twice, and a range per supplier inside or across them."""
    wide = geo_networks(spark, sf).select("start_ip", "end_ip", "asn", "as_org")
    narrow = table(spark, sf, "supplier").selectExpr(
        "(s_suppkey % 25 + 20L) * 16777216 + s_suppkey % 190 * 65536 AS start_ip",
        "(s_suppkey % 25 + 20L) * 16777216 + (s_suppkey % 190 + 1 + s_suppkey % 3) * 65536 - 1 AS end_ip",
        "s_suppkey + 5000L AS asn", "concat('narrow-', s_suppkey) AS as_org",
    )
    return wide.unionByName(wide).unionByName(narrow)


def published_networks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """City blocks, locations and ASN networks in the published layout; every fifth nation has no
    country of its own, so the registered one, that of the next nation, stands in."""
    nation = table(spark, sf, "nation")
    blocks = nation.selectExpr(
        "explode(array(concat(n_nationkey + 24, '.0.0.0/8'), concat('2a02:6ea0:', n_nationkey, '::/48'))) AS network",
        "CAST(n_nationkey AS BIGINT) AS geoname_id", "CAST((n_nationkey + 1) % 25 AS BIGINT) AS registered_country_geoname_id",
    )
    locations = nation.selectExpr(
        "CAST(n_nationkey AS BIGINT) AS geoname_id", "IF(n_nationkey % 5 = 0, NULL, n_name) AS country_iso_code",
        "concat('City_', n_nationkey) AS city_name",
    )
    return blocks, locations, nation.selectExpr(
        "concat(n_nationkey + 22, '.0.0.0/8') AS network", "n_nationkey + 300L AS asn", "concat('AS of ', n_name) AS as_org"
    )


def dim_users(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts from customers; ids are shifted, so the lowest have no row, and some names are empty."""
    return table(spark, sf, "customer").selectExpr(
        f"c_custkey + {USER_SHIFT} AS user_id",
        "IF(c_custkey % 9 = 0, '', c_name) AS username",
        "IF(c_acctbal < 0, 'DISABLED', 'ACTIVE') AS status",
        "c_mktsegment AS tag",
        "0L AS traffic_limit_bytes",
        "c_custkey % 4 AS hwid_device_limit",
        "TIMESTAMP_NTZ '2025-01-01 00:00:00' AS expire_at",
        f"TIMESTAMP_NTZ '{AS_OF}' AS updated_at",
    )


def dim_users_history(spark: SparkSession, sf: str) -> DataFrame:
    """The accounts above plus an older version of each under another name."""
    new = dim_users(spark, sf)
    old = new.selectExpr(
        "user_id", "concat('old-', username) AS username", "'LIMITED' AS status", "tag",
        "traffic_limit_bytes", "hwid_device_limit", "expire_at",
        f"TIMESTAMP_NTZ '{EARLIER}' AS updated_at",
    )
    return old.unionByName(new)


def dim_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes from suppliers; node 3 has no name and node 7 no row, as ids from 7 on are one higher."""
    return table(spark, sf, "supplier").selectExpr(
        "IF(s_suppkey < 7, s_suppkey, s_suppkey + 1) AS node_id",
        "concat('uuid-', s_suppkey) AS uuid",
        "IF(s_suppkey = 3, '', concat('edge-', s_suppkey)) AS name",
        "CAST(s_nationkey AS STRING) AS country_code",
        f"TIMESTAMP_NTZ '{AS_OF}' AS updated_at",
    )


def sub_requests(spark: SparkSession, sf: str) -> DataFrame:
    nets = geo_networks(spark, sf)
    return enrich_requests(request_rows(events(spark, sf)), nets, nets)


def node_connections(spark: SparkSession, sf: str) -> DataFrame:
    nets = geo_networks(spark, sf)
    return enrich_connections(connection_rows(events(spark, sf)), nets, nets)


class DerivedTables:
    """Inputs of the reports, each built only when a report asks for it."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self._spark, self._sf = spark, sf

    @cached_property
    def _events(self) -> DataFrame:
        return events(self._spark, self._sf)

    @cached_property
    def _networks(self) -> DataFrame:
        return geo_networks(self._spark, self._sf)

    @cached_property
    def sub_requests(self) -> DataFrame:
        return enrich_requests(request_rows(self._events), self._networks, self._networks)

    @cached_property
    def node_connections(self) -> DataFrame:
        return enrich_connections(connection_rows(self._events), self._networks, self._networks)

    @cached_property
    def usage_5m(self) -> DataFrame:
        return rollups.usage_5m(usage_facts(self._events))

    @cached_property
    def user_conn_5m(self) -> DataFrame:
        return rollups.user_conn_5m(self.node_connections)

    @cached_property
    def sub_req_5m(self) -> DataFrame:
        return rollups.sub_req_5m(self.sub_requests)

    @cached_property
    def dim_users(self) -> DataFrame:
        return dim_users(self._spark, self._sf)

    @cached_property
    def dim_nodes(self) -> DataFrame:
        return dim_nodes(self._spark, self._sf)


# --- messages -----------------------------------------------------------------


_STAMP = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def _message(prefix: str, stream: str, fields: dict[str, str]) -> str:
    """SQL of one entry per event; a field whose SQL gives NULL is left out.

    Maps of one field are joined, as Spark compiles these and no lambda over a map.
    """

    def one(name: str, value: str) -> str:
        pair = f"map('{name}', CAST({value} AS STRING))"
        return f"IF({value} IS NULL, CAST(map() AS MAP<STRING, STRING>), {pair})" if "NULL" in value.upper() else pair

    pairs = ", ".join(one(name, value) for name, value in fields.items())
    return f"named_struct('entry_id', concat('{prefix}-', event_id), 'stream', '{stream}', 'fields', map_concat({pairs}))"


def _entries(ev: DataFrame, *entries: str) -> DataFrame:
    # The generator keeps message building apart from message decoding, as a
    # stored stream would: filters on the fields do not rebuild them.
    # A message takes far longer than its event to read, and a file of few row
    # groups is read by few tasks: every core gets events.
    spread = ev.repartition(2 * ev.sparkSession.sparkContext.defaultParallelism, "event_id")
    built = spread.selectExpr(*[f"{entry} AS e{i}" for i, entry in enumerate(entries)])
    return built.selectExpr(f"explode(array({', '.join(built.columns)})) AS m").select("m.*")


def _usage_message() -> str:
    """Three records of the account, an empty one, and one of its neighbour."""
    own = ", ".join(f"concat(user_id, ':', {_bytes(str(k))})" for k in range(3))
    records = f"concat_ws(';', {own}, '', concat(user_id + 1, ':0'))"
    return _message("u", USAGE_STREAM, {"v": "1", "nodeId": _NODE, "ts": _STAMP, "records": records})


def _request_message() -> str:
    """A fetch whose response type travels under either spelling."""
    fields = {
        "v": "1", "userId": "user_id", "requestAt": _STAMP,
        "requestIp": f"nullif({_ip('0')}, '')", "userAgent": _user_agent("0"),
        "ssrResponseType": f"IF(event_id % 2 = 1, {_RESPONSE}, NULL)",
        "srrResponseType": f"IF(event_id % 2 = 1, 'IGNORED_IF_FIRST_FILLED', {_RESPONSE})",
        "srrRuleName": _RULE,
    }
    return _message("r", REQUEST_STREAM, fields)


def _connection_message() -> str:
    """A snapshot with the account on three addresses and its neighbour on none."""
    seen = ", ".join(f"named_struct('ip', {_ip(str(k))}, 'lastSeen', {_STAMP})" for k in range(3))
    users = f"""to_json(array(
        named_struct('userId', CAST(user_id AS STRING), 'ips', array({seen})),
        named_struct('userId', CAST(user_id + 1 AS STRING), 'ips', slice(array({seen}), 1, 0))))"""
    return _message("c", CONNECTION_STREAM, {"v": "1", "nodeId": _NODE, "ts": _STAMP, "users": users})


def _broken_messages() -> tuple[str, str, str]:
    """One faulty message per stream, cycling through the faults."""

    def cycle(*values: str) -> str:
        return _case(f"event_id % {len(values)}", dict(enumerate(values)), "NULL")

    ts, one, pair = _STAMP, "'1'", "'1:2'"
    usage = {
        "v": cycle("'2'", *[one] * 7),
        "nodeId": cycle(one, "NULL", "'+5'", "'18446744073709551616'", *[one] * 4),
        "ts": cycle(ts, ts, ts, ts, "'yesterday'", ts, ts, ts),
        "records": cycle(*[pair] * 5, "'1:2;1-2'", "';;'", "'1:2:3'"),
    }
    requests = {
        "v": cycle("NULL", one, one, one),
        "userId": cycle(one, "''", "' 5 '", one),
        "requestAt": cycle(ts, ts, ts, "'2024-13-01T00:00:00Z'"),
    }
    good_ip = '[{"ip":"1.2.3.4","lastSeen":"2024-01-01T00:00:00Z"}]'
    bad_ip = '[{"ip":"1.2.3.4","lastSeen":"now"}]'
    users = cycle(
        "'{not json'", "'{}'", "'[] x'",
        f"""'[{{"userId":42,"ips":{good_ip}}}]'""",
        f"""'[{{"userId":"42","ips":{bad_ip}}}]'""",
        "''",
    )
    connections = {"v": one, "nodeId": one, "ts": ts, "users": users}
    return (
        _message("bu", USAGE_STREAM, usage),
        _message("br", REQUEST_STREAM, requests),
        _message("bc", CONNECTION_STREAM, connections),
    )


def large_messages(ev: DataFrame) -> DataFrame:
    """Usage messages with node ids and byte counts up to 2^64-1."""
    node = "CAST(18446744073709551615 - event_id % 7 AS STRING)"
    records = "concat(user_id, ':18446744073709551615;', user_id, ':9223372036854775807;9223372036854775808:', event_id)"
    return _entries(ev, _message("l", USAGE_STREAM, {"v": "1", "nodeId": node, "ts": _STAMP, "records": records}))


def usage_messages(ev: DataFrame) -> DataFrame:
    return _entries(ev, _usage_message())


def request_messages(ev: DataFrame) -> DataFrame:
    return _entries(ev, _request_message())


def messages(ev: DataFrame) -> DataFrame:
    """Good and faulty messages of all three streams, six per event."""
    return _entries(
        ev, _usage_message(), _request_message(), _connection_message(), *_broken_messages()
    )


def user_pages(spark: SparkSession, sf: str) -> DataFrame:
    """API pages of accounts, one page per account, with absent and bad values."""
    user = """named_struct('id', c_custkey, 'username', c_name, 'status', 'ACTIVE',
        'tag', nullif(c_mktsegment, 'HOUSEHOLD'), 'trafficLimitBytes', c_acctbal,
        'hwidDeviceLimit', nullif(c_custkey % 4, 0),
        'expireAt', IF(c_custkey % 5 = 0, 'never', '2025-01-01T03:00:00.5+03:00'))"""
    page = f"to_json(named_struct('response', named_struct('users', array({user}))))"
    return (
        table(spark, sf, "customer")
        .selectExpr(f"from_json({page}, '{USERS_PAGE}') AS page")
        .select("page.*")
    )


def node_pages(spark: SparkSession, sf: str) -> DataFrame:
    """API pages of nodes, one page per supplier; nodes of nation 0 carry no id."""
    node = """named_struct('id', IF(s_nationkey <> 0, s_suppkey + 1, NULL),
        'uuid', concat('uuid-', s_suppkey), 'name', s_name,
        'countryCode', IF(s_nationkey <> 1, CAST(s_nationkey AS STRING), NULL))"""
    page = f"to_json(named_struct('response', array({node})))"
    return (
        table(spark, sf, "supplier")
        .selectExpr(f"from_json({page}, '{NODES_PAGE}') AS page")
        .select("page.*")
    )
