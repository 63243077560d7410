"""Independent SQL answers for the catalogue, on the same test tables.

Every statement starts from the raw tables: fixtures, enrichment, rollups and
reports are all expressed again in SQL, with exact distinct counts instead of
sketches and plain joins instead of the engine's operators.
"""

from __future__ import annotations

from accesslens.fixtures import EDGE_FROM, EDGE_TO, RESPONSES, T_FROM, T_TO, USER_AGENTS, USER_SHIFT
from accesslens.operators.decode import CONNECTION_STREAM, REQUEST_STREAM, USAGE_STREAM
from accesslens.plans.severity import BANDS, STAT_BANDS, STAT_BASE, STAT_LIKE, TABLE_BASE

# What is expected, written out once more so that a wrong rule in the engine shows.
REFUSALS = ("BLOCK", "STATUS_CODE_404", "STATUS_CODE_451", "SOCKET_DROP")
CLIENT_RULES = (
    ("happ", "Happ", "client"),
    ("streisand", "Streisand", "client"),
    ("hiddify", "Hiddify", "client"),
    ("v2rayng", "v2rayNG", "client"),
    ("v2raytun", "v2RayTun", "client"),
    ("v2rayn", "v2rayN", "client"),
    ("nekobox", "NekoBox", "client"),
    ("nekoray", "NekoRay", "client"),
    ("shadowrocket", "Shadowrocket", "client"),
    ("stash", "Stash", "client"),
    ("loon", "Loon", "client"),
    ("quantumult", "Quantumult", "client"),
    ("surge", "Surge", "client"),
    ("clash-verge", "Clash Verge", "client"),
    ("clashx", "ClashX", "client"),
    ("clash", "Clash", "client"),
    ("mihomo", "Mihomo", "client"),
    ("sing-box", "sing-box", "client"),
    ("singbox", "sing-box", "client"),
    ("foxray", "FoXray", "client"),
    ("karing", "Karing", "client"),
    ("throne", "Throne", "client"),
    ("husi", "Husi", "client"),
    ("exclave", "Exclave", "client"),
    ("matsuri", "Matsuri", "client"),
    ("v2box", "V2Box", "client"),
    ("sfa", "sing-box for Android", "client"),
    ("sfi", "sing-box for iOS", "client"),
    ("sfm", "sing-box for macOS", "client"),
    ("curl", "curl", "script"),
    ("wget", "wget", "script"),
    ("python-requests", "python-requests", "script"),
    ("python-urllib", "python-urllib", "script"),
    ("aiohttp", "aiohttp", "script"),
    ("httpx", "httpx", "script"),
    ("go-http-client", "Go-http-client", "script"),
    ("okhttp", "OkHttp", "script"),
    ("axios", "axios", "script"),
    ("node-fetch", "node-fetch", "script"),
    ("powershell", "PowerShell", "script"),
    ("java/", "Java", "script"),
    ("libwww-perl", "libwww-perl", "script"),
    ("postman", "Postman", "script"),
    ("insomnia", "Insomnia", "script"),
    ("telegrambot", "TelegramBot", "bot"),
    ("crawler", "Crawler", "bot"),
    ("spider", "Spider", "bot"),
    ("bot", "Bot", "bot"),
    ("edg/", "Edge", "browser"),
    ("opr/", "Opera", "browser"),
    ("yabrowser", "Yandex Browser", "browser"),
    ("firefox", "Firefox", "browser"),
    ("chrome", "Chrome", "browser"),
    ("safari", "Safari", "browser"),
    ("mozilla", "Browser", "browser"),
)
HOSTING_KEYWORDS = (
    "hosting", "host", "datacenter", "data center", "dedicated", "server", "cloud", "vps", "colo", "ovh",
    "hetzner", "digitalocean", "linode", "vultr", "contabo", "scaleway", "leaseweb", "m247", "choopa", "amazon",
    "aws", "google llc", "microsoft", "azure", "oracle", "alibaba", "tencent", "packet", "equinix", "cogent",
    "netcup", "aeza", "vdsina", "timeweb", "selectel", "firstbyte", "ihor", "serverius", "worldstream",
    "clouvider",
)


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _ua_case(column: str, part: int) -> str:
    low = f"lower(trim({column}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)))"
    tests = " ".join(
        f"WHEN contains({low}, '{rule[0]}') THEN '{rule[part]}'" for rule in CLIENT_RULES
    )
    empty, other = ("(empty)", "Other") if part == 1 else ("unknown", "unknown")
    return f"CASE WHEN {low} = '' THEN '{empty}' {tests} ELSE '{other}' END"


def _hosting(column: str) -> str:
    words = " OR ".join(f"contains(lower({column}), '{w}')" for w in HOSTING_KEYWORDS)
    return f"CAST({column} <> '' AND ({words}) AS INTEGER)"


def _even(expression: str, digits: int) -> str:
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"round_even(({expression}) * {scale}, 0) / {scale}"


def _ip(k: str = "k") -> str:
    return f"""CASE (event_id + {k}) % 10 WHEN 0 THEN ''
        WHEN 1 THEN '2a02:6ea0:' || (user_id % 90) || '::' || (1 + event_id % 9)
        WHEN 2 THEN '10.0.' || (user_id % 5) || '.' || (event_id % 25)
        ELSE (20 + event_id % 23) || '.' || (user_id % 200) || '.' || (event_id % 13) || '.' || (event_id % 40) END"""


def _ua(k: str = "k") -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(USER_AGENTS))
    return f"CASE (event_id + {k}) % {len(USER_AGENTS)} {cases} END"


_RESPONSE = (
    "CASE event_type "
    + " ".join(f"WHEN '{kind}' THEN '{response}'" for kind, response in RESPONSES.items())
    + " ELSE '' END"
)
_RULE = "CASE WHEN event_id % 3 = 0 THEN '' ELSE 'rule-' || (event_id % 4) END"
_BYTES = "CASE WHEN event_id % 50 = 0 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) * 104857 * ({k} + 1) END"
_ORG = """CASE {n} % 4 WHEN 0 THEN 'Example Hosting Ltd' WHEN 1 THEN 'Residential Telecom'
    WHEN 2 THEN 'Sample Cloud Inc' ELSE 'Mobile Networks' END"""
_NUMBER = """CASE WHEN ip = '' OR contains(ip, ':') THEN NULL ELSE
    CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
    + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) END"""
_PREFIX = """CASE WHEN ip = '' THEN '' WHEN contains(ip, ':') THEN
        CASE WHEN split_part(ip, ':', 3) = '0' THEN '2a02:6ea0::/48' ELSE '2a02:6ea0:' || split_part(ip, ':', 3) || '::/48' END
    ELSE split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.' || split_part(ip, '.', 3) || '.0/24' END"""
_GEO = """coalesce(g.country, '') AS country, coalesce(g.city, '') AS city, coalesce(g.asn, 0) AS asn,
    coalesce(g.as_org, '') AS as_org, coalesce(g.is_hosting, 0) AS is_hosting"""
_B5 = "time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00')"
_IN5 = f"ts5 BETWEEN TIMESTAMP '{T_FROM}' AND TIMESTAMP '{T_TO}'"
_IN = f"ts BETWEEN TIMESTAMP '{T_FROM}' AND TIMESTAMP '{T_TO}'"
_BLOCKED = f"srr_response_type IN ({_quoted(REFUSALS)})"
_SCRIPTED = "ua_kind IN ('script', 'bot')"

_CTES = {
    "k3": "SELECT e.*, k, date_trunc('millisecond', ts + k * INTERVAL 2 MINUTE) AS tk "
    "FROM events e CROSS JOIN (VALUES (0), (1), (2)) AS r(k)",
    "usage": f"SELECT tk AS ts, 1 + event_id % 7 AS node_id, user_id, {_BYTES.format(k='k')} AS bytes FROM k3",
    "req0": f"""SELECT tk AS ts, user_id, {_ip()} AS ip, {_ua()} AS user_agent,
        {_RESPONSE} AS srr_response_type, {_RULE} AS srr_rule_name FROM k3""",
    "conn0": f"""SELECT tk AS ts, 1 + event_id % 7 AS node_id, user_id, {_ip()} AS ip,
        date_trunc('millisecond', ts) AS last_seen FROM k3""",
    "geo": f"""SELECT CAST(24 + n_nationkey AS BIGINT) * 16777216 AS start_ip,
        CAST(24 + n_nationkey AS BIGINT) * 16777216 + 16777215 AS end_ip, n_name AS country,
        'City_' || n_nationkey AS city, CAST(1000 + n_nationkey AS BIGINT) AS asn,
        {_ORG.format(n='n_nationkey')} AS as_org,
        CAST(n_nationkey % 4 IN (0, 2) AS INTEGER) AS is_hosting FROM nation""",
    "req": f"""SELECT r.ts, r.user_id, r.ip, r.ip_prefix, {_GEO}, r.user_agent,
        {_ua_case('r.user_agent', 1)} AS ua_family, {_ua_case('r.user_agent', 2)} AS ua_kind,
        r.srr_response_type, r.srr_rule_name
        FROM (SELECT *, {_NUMBER} AS n, {_PREFIX} AS ip_prefix FROM req0) r
        LEFT JOIN geo g ON r.n BETWEEN g.start_ip AND g.end_ip""",
    "conn": f"""SELECT r.ts, r.node_id, r.user_id, r.ip, r.ip_prefix, r.last_seen, {_GEO}
        FROM (SELECT *, {_NUMBER} AS n, {_PREFIX} AS ip_prefix FROM conn0) r
        LEFT JOIN geo g ON r.n BETWEEN g.start_ip AND g.end_ip""",
    "users": f"""SELECT c_custkey + {USER_SHIFT} AS user_id, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_name END AS username,
        CASE WHEN c_acctbal < 0 THEN 'DISABLED' ELSE 'ACTIVE' END AS status, c_mktsegment AS tag,
        CAST(0 AS BIGINT) AS traffic_limit_bytes, c_custkey % 4 AS hwid_device_limit,
        TIMESTAMP '2025-01-01 00:00:00' AS expire_at FROM customer""",
    "nodes": """SELECT CAST(CASE WHEN s_suppkey < 7 THEN s_suppkey ELSE s_suppkey + 1 END AS BIGINT) AS node_id,
        CASE WHEN s_suppkey = 3 THEN '' ELSE 'edge-' || s_suppkey END AS node_name FROM supplier""",
    "u5": f"""SELECT {_B5} AS ts5, node_id, user_id, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM usage GROUP BY ALL HAVING sum(bytes) <> 0""",
    "c5": f"""SELECT {_B5} AS ts5, * FROM conn""",
    "s5": f"""SELECT {_B5} AS ts5, * FROM req""",
    "vu": """SELECT u.ts5, u.node_id, coalesce(nullif(n.node_name, ''), 'node-' || u.node_id) AS node_name,
        u.user_id, coalesce(nullif(d.username, ''), 'user-' || u.user_id) AS username,
        coalesce(d.status, '') AS status, coalesce(d.tag, '') AS tag, u.bytes
        FROM u5 u LEFT JOIN nodes n ON n.node_id = u.node_id LEFT JOIN users d ON d.user_id = u.user_id""",
    "vc": """SELECT c.ts, c.node_id, coalesce(nullif(n.node_name, ''), 'node-' || c.node_id) AS node_name,
        c.user_id, coalesce(nullif(d.username, ''), 'user-' || c.user_id) AS username,
        coalesce(d.status, '') AS status, coalesce(d.hwid_device_limit, 0) AS hwid_device_limit, c.ip,
        c.ip_prefix, c.last_seen, c.country, c.city, c.asn, c.as_org, c.is_hosting
        FROM conn c LEFT JOIN nodes n ON n.node_id = c.node_id LEFT JOIN users d ON d.user_id = c.user_id""",
    "vr": f"""SELECT r.ts, r.user_id, coalesce(nullif(d.username, ''), 'user-' || r.user_id) AS username,
        coalesce(d.status, '') AS status, r.ip, r.ip_prefix, r.country, r.city, r.asn, r.as_org, r.is_hosting,
        r.user_agent, r.ua_family, r.ua_kind, r.srr_response_type, r.srr_rule_name,
        CAST({_BLOCKED} AS INTEGER) AS is_blocked
        FROM req r LEFT JOIN users d ON d.user_id = r.user_id""",
    "wu": f"SELECT * FROM vu WHERE {_IN5}",
    "wc": f"SELECT * FROM vc WHERE {_IN}",
    "wr": f"SELECT * FROM vr WHERE {_IN}",
    "everyone": f"""SELECT user_id FROM u5 WHERE {_IN5} UNION SELECT user_id FROM c5 WHERE {_IN5}
        UNION SELECT user_id FROM s5 WHERE {_IN5}""",
    "abuse_t": f"""SELECT user_id, CAST(sum(bytes) AS BIGINT) AS bytes, count(DISTINCT node_id) AS traffic_nodes
        FROM u5 WHERE {_IN5} GROUP BY user_id""",
    "abuse_c": f"""SELECT user_id, count(DISTINCT ip) AS ips, count(DISTINCT ip_prefix) AS prefixes,
        count(DISTINCT asn) AS asns, count(DISTINCT nullif(country, '')) AS countries,
        count(DISTINCT node_id) AS nodes, count(DISTINCT CASE WHEN is_hosting = 1 THEN ip END) AS hosting_ips
        FROM c5 WHERE {_IN5} GROUP BY user_id""",
    "abuse_s": f"""SELECT user_id, count(*) AS sub_requests, count(*) FILTER ({_SCRIPTED}) AS sub_scripted,
        count(*) FILTER ({_BLOCKED}) AS sub_blocked, count(DISTINCT ip) AS sub_ips,
        count(DISTINCT user_agent) AS sub_uas FROM s5 WHERE {_IN5} GROUP BY user_id""",
    "abuse_m": """SELECT e.user_id, coalesce(nullif(d.username, ''), 'user-' || e.user_id) AS username,
        coalesce(d.status, '') AS status, coalesce(d.tag, '') AS tag,
        coalesce(d.hwid_device_limit, 0) AS hwid_device_limit, coalesce(t.bytes, 0) AS bytes,
        coalesce(t.traffic_nodes, 0) AS traffic_nodes, coalesce(c.ips, 0) AS ips,
        coalesce(c.prefixes, 0) AS prefixes, coalesce(c.asns, 0) AS asns,
        coalesce(c.countries, 0) AS countries, coalesce(c.nodes, 0) AS nodes,
        coalesce(c.hosting_ips, 0) AS hosting_ips, coalesce(s.sub_requests, 0) AS sub_requests,
        coalesce(s.sub_scripted, 0) AS sub_scripted, coalesce(s.sub_blocked, 0) AS sub_blocked,
        coalesce(s.sub_ips, 0) AS sub_ips, coalesce(s.sub_uas, 0) AS sub_uas
        FROM everyone e LEFT JOIN abuse_t t USING (user_id) LEFT JOIN abuse_c c USING (user_id)
        LEFT JOIN abuse_s s USING (user_id) LEFT JOIN users d USING (user_id)""",
    "abuse": f"""SELECT user_id, username, status, tag, hwid_device_limit, bytes,
        {_even('bytes / 1073741824.0::DOUBLE', 2)} AS gigabytes, traffic_nodes, ips, prefixes, asns, countries,
        nodes, hosting_ips, sub_requests, sub_scripted, sub_blocked, sub_ips, sub_uas,
        {_even('''bytes / 1073741824.0::DOUBLE
            + greatest(prefixes - 2, 0)::DOUBLE * 2.0::DOUBLE
            + greatest(countries - 1, 0)::DOUBLE * 5.0::DOUBLE
            + greatest(asns - 2, 0)::DOUBLE * 2.0::DOUBLE
            + hosting_ips::DOUBLE * 4.0::DOUBLE
            + greatest(sub_uas - 2, 0)::DOUBLE * 2.0::DOUBLE
            + greatest(sub_requests - 20, 0)::DOUBLE * 0.2::DOUBLE
            + sub_scripted::DOUBLE * 0.5::DOUBLE
            + greatest(sub_blocked - 5, 0)::DOUBLE * 0.5::DOUBLE''', 1)} AS score
        FROM abuse_m""",
}


def _needed(body: str) -> list[str]:
    """Names of the common tables a statement uses, in definition order."""
    import re

    used: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"[a-z_0-9]+", queue.pop()))
        for name in _CTES:
            if name in words and name not in used:
                used.add(name)
                queue.append(_CTES[name])
    return [name for name in _CTES if name in used]


def _sql(body: str) -> str:
    names = _needed(body)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in names) + "\n" + body


def _band(measure: str, steps, base: str) -> str:
    tests = " ".join(f"WHEN {measure} >= {least} THEN '{label}'" for least, label in sorted(steps, reverse=True))
    return f"CASE {tests} ELSE '{base}' END"


def _banded(report_sql: str, report: str) -> str:
    extra = ", ".join(
        f"{_band(m, steps, STAT_BASE if (report, m) in STAT_LIKE else TABLE_BASE)} AS {m}_severity"
        for m, steps in BANDS[report].items()
    )
    return f"SELECT *, {extra} FROM ({report_sql}) AS report"


_STATS = {
    "flagged_accounts": "SELECT count(*) AS flagged FROM abuse WHERE score >= 30",
    "multi_country": "SELECT count(*) AS c FROM abuse WHERE countries > 1",
    "hosting_accounts": "SELECT count(*) AS c FROM abuse WHERE hosting_ips > 0",
    "over_device_limit": "SELECT count(*) AS c FROM abuse WHERE hwid_device_limit > 0 AND prefixes > hwid_device_limit",
    "shared_address_count": f"""SELECT count(*) AS c FROM (SELECT ip FROM conn WHERE {_IN}
        GROUP BY ip HAVING count(DISTINCT user_id) > 1) AS shared""",
    "scripted_fetches": "SELECT CAST(coalesce(sum(sub_scripted), 0) AS BIGINT) AS c FROM abuse",
    "heaviest_share": f"""SELECT {_even('CAST(100 * max(b) AS DOUBLE) / nullif(CAST(sum(b) AS DOUBLE), 0)', 1)} AS pct
        FROM (SELECT user_id, CAST(sum(bytes) AS BIGINT) AS b FROM wu GROUP BY user_id) AS per""",
    "scripted_share": f"""SELECT {_even(f'CAST(100 * count(*) FILTER ({_SCRIPTED}) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0)', 1)} AS pct
        FROM wr""",
    "hosting_requests": "SELECT count(*) AS c FROM wr WHERE is_hosting = 1",
    "busiest_account": """SELECT coalesce(max(c), 0) AS requests FROM
        (SELECT user_id, count(*) AS c FROM wr GROUP BY user_id) AS per""",
}
_STAT_COLUMN = {
    "flagged_accounts": "flagged", "heaviest_share": "pct", "scripted_share": "pct", "busiest_account": "requests",
}

_ABUSE_SCORE = """SELECT username, status, tag, score, gigabytes, prefixes AS networks, countries, asns,
    hosting_ips, nodes, ips, sub_requests, sub_uas, sub_blocked, hwid_device_limit
    FROM abuse WHERE score > 0 ORDER BY score DESC, user_id LIMIT 200"""

_SHARED = """SELECT a.ip, a.accounts, n.usernames, a.country, a.as_org, a.hosting, a.last_seen FROM
    (SELECT ip, count(DISTINCT user_id) AS accounts, max(country) AS country, max(as_org) AS as_org,
        max(is_hosting) AS hosting, max(last_seen) AS last_seen FROM wc GROUP BY ip
        HAVING count(DISTINCT user_id) > 1 ORDER BY accounts DESC, last_seen DESC, ip LIMIT 200) a
    JOIN (SELECT ip, string_agg(username, ', ' ORDER BY username) AS usernames FROM
        (SELECT ip, username, row_number() OVER (PARTITION BY ip ORDER BY username) AS r
            FROM (SELECT DISTINCT ip, username FROM wc) AS pairs) AS ranked
        WHERE r <= 10 GROUP BY ip) n USING (ip)"""

_TALKERS = f"""SELECT username, max(status) AS status, max(tag) AS tag, CAST(sum(bytes) AS BIGINT) AS total_bytes,
    {_even('CAST(max(bytes) * 8 AS DOUBLE) / 300.0::DOUBLE / 1000000.0::DOUBLE', 2)} AS peak_mbps,
    max(nodes) AS nodes,
    {_even('CAST(100 * sum(bytes) AS DOUBLE) / nullif((SELECT CAST(sum(bytes) AS DOUBLE) FROM wu), 0)', 2)} AS pct_of_total
    FROM (SELECT ts5, username, max(status) AS status, max(tag) AS tag, CAST(sum(bytes) AS BIGINT) AS bytes,
        count(DISTINCT node_name) AS nodes FROM wu GROUP BY ts5, username) AS per
    GROUP BY username ORDER BY total_bytes DESC, username LIMIT 100"""


def _top5(source: str) -> str:
    return f"""SELECT node_name, username, bytes,
    {_even('CAST(100 * bytes AS DOUBLE) / nullif(CAST(node_bytes AS DOUBLE), 0)', 1)} AS pct_of_node FROM
    (SELECT *, sum(bytes) OVER (PARTITION BY node_name) AS node_bytes,
        row_number() OVER (PARTITION BY node_name ORDER BY bytes DESC, username) AS r
        FROM (SELECT node_name, username, CAST(sum(bytes) AS BIGINT) AS bytes FROM {source}
            GROUP BY node_name, username) AS per) AS ranked WHERE r <= 5"""


_OFFENDERS = f"""SELECT username, status, count(*) AS requests, count(DISTINCT ip) AS ips,
    count(DISTINCT ip_prefix) AS networks, count(DISTINCT country) AS countries,
    count(DISTINCT user_agent) AS user_agents, count(*) FILTER ({_SCRIPTED}) AS scripted,
    count(*) FILTER (is_hosting = 1) AS from_hosting, count(*) FILTER (is_blocked = 1) AS refused,
    max(ts) AS last_seen FROM wr GROUP BY username, status ORDER BY requests DESC, username, status LIMIT 200"""

_NETWORKS = """SELECT asn, max(as_org) AS as_org, max(is_hosting) AS hosting, count(*) AS requests,
    count(DISTINCT user_id) AS accounts FROM wr WHERE asn <> 0 GROUP BY asn ORDER BY requests DESC, asn LIMIT 50"""

_CONN_COUNTS = """count(DISTINCT ip) AS ips, count(DISTINCT ip_prefix) AS prefixes, count(DISTINCT asn) AS asns,
    count(DISTINCT nullif(country, '')) AS countries, count(DISTINCT node_id) AS nodes,
    count(DISTINCT CASE WHEN is_hosting = 1 THEN ip END) AS hosting_ips"""
_SUB_COUNTS = f"""count(*) AS requests, count(*) FILTER ({_SCRIPTED}) AS scripted,
    count(*) FILTER ({_BLOCKED}) AS blocked, count(DISTINCT ip) AS ips, count(DISTINCT ip_prefix) AS prefixes,
    count(DISTINCT asn) AS asns, count(DISTINCT nullif(country, '')) AS countries, count(DISTINCT user_agent) AS uas"""

# Faults of the broken messages, in the order of their cycle.
_FAULTS = {
    USAGE_STREAM: (
        "unsupported_version", "missing_nodeId", "bad_nodeId", "uint64_out_of_range", "bad_ts",
        "malformed_record", "empty_records", "bad_record",
    ),
    REQUEST_STREAM: ("missing_v", "missing_userId", "bad_userId", "bad_requestAt"),
    CONNECTION_STREAM: ("bad_users", "bad_users", "bad_users", "bad_users", "bad_last_seen", "missing_users"),
}


def _fault_case(stream: str) -> str:
    faults = _FAULTS[stream]
    tests = " ".join(f"WHEN {i} THEN '{reason}'" for i, reason in enumerate(faults))
    return f"CASE event_id % {len(faults)} {tests} END"


_QUARANTINE = "SELECT stream, reason, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT '{s}' AS stream, {_fault_case(s)} AS reason FROM events" for s in _FAULTS
) + ") AS faults GROUP BY stream, reason"

_USAGE_RECORDS = (
    "SELECT date_trunc('millisecond', ts) AS ts, 1 + event_id % 7 AS node_id, user_id, "
    + _BYTES.format(k="k")
    + " AS bytes FROM events CROSS JOIN (VALUES (0), (1), (2)) AS r(k) UNION ALL "
    "SELECT date_trunc('millisecond', ts), 1 + event_id % 7, user_id + 1, CAST(0 AS BIGINT) FROM events"
)
_WIRE_RESPONSE = (
    f"CASE WHEN event_id % 2 = 0 THEN {_RESPONSE} "
    f"ELSE coalesce(nullif({_RESPONSE}, ''), 'IGNORED_IF_FIRST_FILLED') END"
)
_MESSAGE_ROWS = f"""SELECT r.ts, r.user_id, r.ip, r.ip_prefix, {_GEO}, r.user_agent,
    {_ua_case('r.user_agent', 1)} AS ua_family, {_ua_case('r.user_agent', 2)} AS ua_kind,
    r.srr_response_type, r.srr_rule_name FROM
    (SELECT *, {_NUMBER} AS n, {_PREFIX} AS ip_prefix FROM
        (SELECT date_trunc('millisecond', ts) AS ts, user_id, {_ip('0')} AS ip, {_ua('0')} AS user_agent,
            {_WIRE_RESPONSE} AS srr_response_type, {_RULE} AS srr_rule_name FROM events) AS raw) r
    LEFT JOIN geo g ON r.n BETWEEN g.start_ip AND g.end_ip"""
_SNAPSHOT_ROWS = f"""SELECT r.ts, r.node_id, r.user_id, r.ip, r.ip_prefix, r.last_seen, {_GEO} FROM
    (SELECT *, {_NUMBER} AS n, {_PREFIX} AS ip_prefix FROM
        (SELECT date_trunc('millisecond', ts) AS ts, 1 + event_id % 7 AS node_id, user_id, {_ip()} AS ip,
            date_trunc('millisecond', ts) AS last_seen FROM k3) AS raw) r
    LEFT JOIN geo g ON r.n BETWEEN g.start_ip AND g.end_ip"""

_FINE = """SELECT CAST(base + shift AS BIGINT) AS start_ip, CAST(base + shift + size - 1 AS BIGINT) AS end_ip,
    asn, as_org FROM (SELECT (20 + s_suppkey // 200) * 16777216 + s_suppkey % 200 * 65536 AS base,
        CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_suppkey % 5 * 256 + s_suppkey % 16 END AS shift,
        CASE s_suppkey % 4 WHEN 0 THEN 65536 WHEN 1 THEN 40 WHEN 2 THEN 1500 ELSE 5000 END AS size,
        CAST(s_suppkey + 1 AS BIGINT) AS asn, s_name AS as_org FROM supplier) AS s"""
_CIDR = """SELECT (20 + n_nationkey) || '.0.0.0/8' AS network, 8 AS len, n_name AS as_org FROM nation
    UNION ALL SELECT (20 + s_nationkey) || '.' || (s_suppkey % 200) || '.0.0/16', 16, s_name FROM supplier
    UNION ALL SELECT (20 + s_nationkey) || '.' || (s_suppkey % 200) || '.' || (s_suppkey % 13) || '.0/24', 24, s_name FROM supplier
    UNION ALL SELECT '2a02:6ea0:' || s_suppkey || '::/48', 48, s_name FROM supplier
    UNION ALL SELECT '2a02:6ea0::/32', 32, r_name FROM region"""
_PREFIX_JOIN = f"""SELECT d.ip, coalesce(b.hit.asn, 0) AS asn, coalesce(b.hit.as_org, '') AS as_org FROM
    (SELECT DISTINCT ip FROM conn) d LEFT JOIN
    (SELECT t.ip, max({{'len': c.len, 'asn': CAST(length(c.as_org) AS BIGINT), 'as_org': c.as_org}}) AS hit FROM
        (SELECT ip, unnest(CASE WHEN ip = '' THEN [] WHEN contains(ip, ':')
            THEN ['2a02:6ea0::/32', '2a02:6ea0:' || split_part(ip, ':', 3) || '::/48']
            ELSE [split_part(ip, '.', 1) || '.0.0.0/8',
                  split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.0.0/16',
                  split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.' || split_part(ip, '.', 3) || '.0/24'] END) AS network
            FROM (SELECT DISTINCT ip FROM conn) AS ips) t
        JOIN ({_CIDR}) c ON c.network = t.network GROUP BY t.ip) b USING (ip)"""

_NODE_LIST = "('edge-1', 'edge-2', 'node-3', 'node-7')"
_FAMILY = "CASE WHEN ip = '' THEN 0 WHEN contains(ip, ':') THEN 6 ELSE 4 END"
_NAME = "coalesce(nullif({d}.{n}, ''), '{k}-' || {f})"


def _top_series(source: str, time: str, measure: str, order: str, limit: int = 10) -> str:
    return f"""SELECT {time} AS time, username, {measure} FROM {source}
    WHERE user_id IN (SELECT user_id FROM {source} GROUP BY user_id ORDER BY {order} DESC, user_id LIMIT {limit})
    GROUP BY ALL"""


_USAGE_U5 = f"""SELECT {_B5} AS ts5, node_id, user_id, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM ({_USAGE_RECORDS}) AS records GROUP BY ALL"""
_USER_SUMS = f"SELECT user_id, CAST(sum(bytes) AS BIGINT) AS bytes FROM ({_USAGE_RECORDS}) AS records GROUP BY user_id"
_SUM = "CAST(sum({0}) AS BIGINT)"
_UNSIGNED = "CAST(18446744073709551615 AS HUGEINT)"
_LARGE = f"""SELECT date_trunc('millisecond', ts) AS ts, CAST({_UNSIGNED} - event_id % 7 AS VARCHAR) AS node_id,
    CASE k WHEN 2 THEN '9223372036854775808' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE k WHEN 0 THEN {_UNSIGNED} WHEN 1 THEN CAST(9223372036854775807 AS HUGEINT) ELSE CAST(event_id AS HUGEINT) END AS bytes
    FROM events CROSS JOIN (VALUES (0), (1), (2)) AS r(k)"""
_MEASURES = " UNION ALL ".join(
    f"SELECT '{stream}' AS stream, CAST(2 * count(*) AS BIGINT) AS messages, count(*) AS failed, "
    f"CAST({per} * count(*) AS BIGINT) AS \"rows\" FROM events"
    for stream, per in ((USAGE_STREAM, 4), (REQUEST_STREAM, 1), (CONNECTION_STREAM, 3))
)
# The smallest range that holds the address, of equal ones the last.
_OVERLAP = f"""SELECT c.ip, coalesce(b.hit.asn, 0) AS asn, coalesce(b.hit.as_org, '') AS as_org FROM conn c LEFT JOIN
    (SELECT d.ip, max({{'size': r.start_ip - r.end_ip, 'start': r.start_ip, 'asn': r.asn, 'as_org': r.as_org}}) AS hit FROM
        (SELECT ip, {_NUMBER} AS n FROM (SELECT DISTINCT ip FROM conn WHERE ip NOT LIKE '10.%') AS ips) d JOIN
        (SELECT start_ip, end_ip, asn, as_org FROM geo UNION ALL
         SELECT CAST((s_suppkey % 25 + 20) * 16777216 + s_suppkey % 190 * 65536 AS BIGINT),
             CAST((s_suppkey % 25 + 20) * 16777216 + (s_suppkey % 190 + 1 + s_suppkey % 3) * 65536 - 1 AS BIGINT),
             CAST(s_suppkey + 5000 AS BIGINT), 'narrow-' || s_suppkey FROM supplier) r
        ON d.n BETWEEN r.start_ip AND r.end_ip GROUP BY d.ip) b ON b.ip = c.ip"""
_CODE = "CASE WHEN {0} % 5 = 0 THEN NULL ELSE n_name END"
_PUBLISHED = f"""SELECT c.ip, coalesce(nullif(p.country, ''), p.registered, '') AS country, coalesce(p.city, '') AS city,
    coalesce(a.asn, 0) AS asn, coalesce(a.as_org, '') AS as_org FROM
    (SELECT ip, {_NUMBER} AS n, CASE WHEN contains(ip, ':') THEN CAST(split_part(ip, ':', 3) AS INTEGER) END AS site FROM conn) c
    LEFT JOIN (SELECT n.n_nationkey AS id, {_CODE.format('n.n_nationkey').replace('n_name', 'n.n_name')} AS country,
        {_CODE.format('r.n_nationkey').replace('n_name', 'r.n_name')} AS registered, 'City_' || n.n_nationkey AS city
        FROM nation n JOIN nation r ON r.n_nationkey = (n.n_nationkey + 1) % 25) p
        ON p.id = coalesce(c.n // 16777216 - 24, c.site)
    LEFT JOIN (SELECT n_nationkey + 22 AS first, CAST(n_nationkey + 300 AS BIGINT) AS asn, 'AS of ' || n_name AS as_org FROM nation) a
        ON a.first = c.n // 16777216"""
_BLOCKS = f"""SELECT b.network, {_CODE.format('n.n_nationkey').replace('n_name', 'n.n_name')} AS country,
    {_CODE.format('r.n_nationkey').replace('n_name', 'r.n_name')} AS registered_country, 'City_' || n.n_nationkey AS city FROM
    (SELECT n_nationkey AS id, (n_nationkey + 24) || '.0.0.0/8' AS network FROM nation UNION ALL
     SELECT n_nationkey, '2a02:6ea0:' || n_nationkey || '::/48' FROM nation) b
    JOIN nation n ON n.n_nationkey = b.id JOIN nation r ON r.n_nationkey = (b.id + 1) % 25"""
_WEIGHTED = f"""SELECT user_id, {_even('''bytes / 1073741824.0::DOUBLE
    + greatest(prefixes - 0, 0)::DOUBLE * 2.0::DOUBLE + greatest(countries - 1, 0)::DOUBLE * 7.0::DOUBLE
    + greatest(asns - 2, 0)::DOUBLE * 2.0::DOUBLE + hosting_ips::DOUBLE * 4.0::DOUBLE
    + greatest(sub_uas - 2, 0)::DOUBLE * 2.0::DOUBLE + greatest(sub_requests - 3, 0)::DOUBLE * 0.25::DOUBLE
    + sub_scripted::DOUBLE * 0.5::DOUBLE + greatest(sub_blocked - 5, 0)::DOUBLE * 0.5::DOUBLE''', 1)} AS score FROM abuse_m"""
_STREAMED = f"""SELECT 'user_usage' AS "table", count(*) AS "rows", {_SUM.format('bytes + user_id + node_id')} AS amount FROM ({_USAGE_RECORDS}) AS a
    UNION ALL SELECT 'sub_requests', count(*), {_SUM.format('asn + is_hosting + length(ip) + length(user_agent) + length(srr_response_type)')}
        FROM ({_MESSAGE_ROWS}) AS b
    UNION ALL SELECT 'node_connections', count(*), {_SUM.format('asn + is_hosting + length(ip) + node_id')} FROM ({_SNAPSHOT_ROWS}) AS c
    UNION ALL SELECT 'quarantine', count(*), {_SUM.format('length(reason)')} FROM
        ({' UNION ALL '.join(f"SELECT {_fault_case(s)} AS reason FROM events" for s in _FAULTS)}) AS d
    UNION ALL SELECT 'usage_5m', count(*), {_SUM.format('bytes + user_id + node_id')} FROM ({_USAGE_U5}) AS e
    UNION ALL SELECT 'user_conn_5m', count(*), {_SUM.format('ips + prefixes + asns + countries + nodes + hosting_ips')} FROM
        (SELECT {_B5} AS ts5, user_id, {_CONN_COUNTS} FROM ({_SNAPSHOT_ROWS}) AS f GROUP BY ALL) AS g
    UNION ALL SELECT 'sub_req_5m', count(*), {_SUM.format('requests + scripted + blocked + ips + prefixes + asns + countries + uas')} FROM
        (SELECT {_B5} AS ts5, user_id, {_SUB_COUNTS} FROM ({_MESSAGE_ROWS}) AS h GROUP BY ALL) AS i"""


def _statements() -> dict[str, str]:
    stats = " UNION ALL ".join(
        f"SELECT '{r}' AS report, CAST({_STAT_COLUMN.get(r, 'c')} AS DOUBLE) AS value, "
        f"{_band(_STAT_COLUMN.get(r, 'c'), STAT_BANDS[r], STAT_BASE)} AS severity FROM ({sql}) AS s"
        for r, sql in _STATS.items()
    )
    return {
        # sources and sinks
        "fact_roundtrip": "SELECT *, CAST(strftime(ts, '%Y%m') AS INTEGER) AS month FROM usage",
        "load_dim_users": """SELECT c_custkey AS user_id, c_name AS username, 'ACTIVE' AS status,
            CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_mktsegment END AS tag,
            CAST(trunc(greatest(c_acctbal, 0)) AS BIGINT) AS traffic_limit_bytes, c_custkey % 4 AS hwid_device_limit,
            CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE TIMESTAMP '2025-01-01 00:00:00.5' END AS expire_at,
            TIMESTAMP '2024-02-01 00:00:00' AS updated_at FROM customer""",
        "load_dim_nodes": """SELECT CAST(s_suppkey + 1 AS BIGINT) AS node_id, 'uuid-' || s_suppkey AS uuid, s_name AS name,
            CASE WHEN s_nationkey = 1 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS country_code,
            TIMESTAMP '2024-02-01 00:00:00' AS updated_at FROM supplier WHERE s_nationkey <> 0""",
        "retention_filter": "SELECT * FROM conn WHERE ts >= TIMESTAMP '2024-02-05 12:00:00' - INTERVAL 30 DAY",
        "schema_evolution_union": """SELECT * FROM req UNION ALL
            SELECT * REPLACE ('' AS srr_response_type, '' AS srr_rule_name) FROM req""",
        "backfill_rollup": f"SELECT ts5, user_id, {_SUB_COUNTS} FROM s5 GROUP BY ts5, user_id",
        "backfill_live": f"SELECT ts5, user_id, {_SUB_COUNTS} FROM s5 GROUP BY ts5, user_id",
        "dim_refresh_changes": """SELECT user_id, CASE WHEN user_id % 10 = 0 THEN 'renamed-' || user_id ELSE username END AS username,
            status, tag, traffic_limit_bytes, hwid_device_limit, expire_at, (SELECT count(*) || ' 0 ' ||
            count(*) FILTER (user_id % 10 = 0) || ' 0' FROM users) AS written FROM users""",
        "backfill_changed": f"""SELECT {_B5} AS ts5, node_id, user_id, CAST(sum(bytes) AS BIGINT) AS bytes, '202401' AS rebuilt FROM
            (SELECT ts + INTERVAL 31 DAY * (user_id % 3) AS ts, node_id, user_id, bytes FROM usage
             UNION ALL SELECT ts, node_id, user_id, bytes FROM usage WHERE user_id % 3 = 0) GROUP BY ALL""",
        "compact_live": "SELECT * FROM u5",
        "clustered_account": "SELECT ts, node_id, user_id, CAST(bytes AS BIGINT) AS bytes FROM usage WHERE user_id IN (1, 5, 77)",
        "retention_drop": "SELECT * FROM conn WHERE ts >= TIMESTAMP '2024-02-05 12:00:00' - INTERVAL 30 DAY",
        "pruned_range": """SELECT * FROM conn
            WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'""",
        # decoding
        "decode_user_usage": _USAGE_RECORDS,
        "decode_sub_requests": _MESSAGE_ROWS,
        "decode_node_connections": _SNAPSHOT_ROWS,
        "response_type_coalesce": f"SELECT 'r-' || event_id AS entry_id, {_WIRE_RESPONSE} AS srr_response_type FROM events",
        "split_packed_records": "SELECT 'u-' || event_id AS entry_id, CAST(user_id AS VARCHAR) AS user, CAST("
        + _BYTES.format(k="k")
        + """ AS VARCHAR) AS bytes FROM k3 UNION ALL
            SELECT 'u-' || event_id, CAST(user_id + 1 AS VARCHAR), '0' FROM events""",
        "quarantine_counts": _QUARANTINE,
        "uint64_values": f"SELECT ts, node_id, user_id, CAST(bytes AS VARCHAR) AS bytes FROM ({_LARGE}) AS l",
        "poison_message": f"SELECT node_id, CAST(sum(bytes) AS VARCHAR) AS bytes FROM ({_LARGE}) AS l GROUP BY node_id",
        # enrichment
        "ip_family": f"SELECT ip, CAST({_FAMILY} AS INTEGER) AS family FROM conn",
        "ip_prefix": "SELECT ip, ip_prefix FROM conn",
        "ip_is_routable": "SELECT ip, ip <> '' AND NOT starts_with(ip, '10.') AS routable FROM conn",
        "geo_enrich": "SELECT ip, ip_prefix, country, city, asn, as_org, is_hosting FROM conn",
        "geo_enrich_shuffled": "SELECT ip, ip_prefix, country, city, asn, as_org, is_hosting FROM conn",
        "geo_range_join": f"""SELECT d.ip, coalesce(f.asn, 0) AS asn, coalesce(f.as_org, '') AS as_org FROM
            (SELECT ip, {_NUMBER} AS n FROM (SELECT DISTINCT ip FROM conn) AS ips) d
            LEFT JOIN ({_FINE}) f ON d.n BETWEEN f.start_ip AND f.end_ip""",
        "geo_prefix_join": _PREFIX_JOIN,
        "geo_v6": f"SELECT c.ip, p.asn, p.as_org FROM conn c JOIN ({_PREFIX_JOIN}) p ON p.ip = c.ip",
        "geo_overlap": _OVERLAP,
        "read_networks_csv": _BLOCKS,
        "geo_two_tables": _PUBLISHED,
        "custom_hosting": """SELECT ip, as_org,
            CAST(contains(lower(as_org), 'telecom') OR contains(lower(as_org), 'sample') AS INTEGER) AS is_hosting FROM req""",
        "hosting_flag": f"""SELECT doc_id, {_hosting('text')} AS is_hosting FROM documents UNION ALL
            SELECT s_suppkey, {_hosting('s_name')} FROM supplier""",
        "ua_classify": f"""SELECT user_agent, {_ua_case('user_agent', 1)} AS ua_family, {_ua_case('user_agent', 2)} AS ua_kind
            FROM (SELECT user_agent FROM req0 UNION ALL SELECT text FROM documents) AS agents""",
        "name_fallback": """SELECT DISTINCT node_id, node_name, user_id, username FROM vu""",
        # views and rollups
        "usage_5m": f"""SELECT {_B5} AS ts5, node_id, user_id, CAST(sum(bytes) AS BIGINT) AS bytes FROM usage GROUP BY ALL""",
        "user_conn_5m": f"SELECT ts5, user_id, {_CONN_COUNTS} FROM c5 GROUP BY ts5, user_id",
        "sub_req_5m": f"SELECT ts5, user_id, {_SUB_COUNTS} FROM s5 GROUP BY ts5, user_id",
        "distinct_state_merge": f"SELECT user_id, {_CONN_COUNTS} FROM c5 GROUP BY user_id",
        "rollup_partial_merge": f"SELECT ts5, user_id, {_SUB_COUNTS} FROM s5 GROUP BY ts5, user_id",
        "dim_latest": "SELECT * FROM users",
        "v_usage": "SELECT * FROM vu",
        "v_connections": "SELECT * FROM vc",
        "v_sub_requests": "SELECT * FROM vr",
        "active_universe": "SELECT user_id FROM everyone",
        "user_abuse": "SELECT * FROM abuse",
        "exact_abuse": "SELECT * FROM abuse",
        "exact_rolled_abuse": "SELECT * FROM abuse",
        "distinct_beyond_sketch": """SELECT CAST(CASE WHEN l_linenumber <= 5 THEN 1 ELSE l_linenumber END AS BIGINT) AS user_id,
            count(DISTINCT l_orderkey || '-' || l_linenumber || '-' || s) AS ips
            FROM lineitem, (SELECT unnest([0, 1, 2, 3]) AS s) GROUP BY ALL""",
        "weighted_abuse": _WEIGHTED,
        "sql_user_abuse": "SELECT * FROM abuse",
        "v_nodes": """SELECT CAST(CASE WHEN s_suppkey < 7 THEN s_suppkey ELSE s_suppkey + 1 END AS BIGINT) AS node_id,
            CASE WHEN s_suppkey = 3 THEN '' ELSE 'edge-' || s_suppkey END AS node_name,
            CAST(s_nationkey AS VARCHAR) AS country_code FROM supplier""",
        "time_range_edges": f"SELECT * FROM u5 WHERE ts5 BETWEEN TIMESTAMP '{EDGE_FROM}' AND TIMESTAMP '{EDGE_TO}'",
        "node_filter": _top5(f"(SELECT * FROM wu WHERE node_name IN {_NODE_LIST}) AS chosen"),
        # severity
        "score_bands": _banded(_ABUSE_SCORE, "abuse_score"),
        "talker_bands": _banded(_TALKERS, "top_talkers"),
        "node_share_bands": _banded(_top5("wu"), "top5_per_node"),
        "offender_bands": _banded(_OFFENDERS, "fetch_offenders"),
        "shared_address_bands": _banded(_SHARED, "shared_addresses"),
        "network_bands": _banded(_NETWORKS, "top_networks"),
        "stat_bands": stats,
        # abuse reports
        **{f"r_{name}": sql for name, sql in _STATS.items()},
        "r_abuse_score": _ABUSE_SCORE,
        "r_networks_worst10": f"""SELECT time, username, count(DISTINCT ip_prefix) AS networks FROM
            (SELECT c.ts5 AS time, c.user_id, c.ip_prefix, {_NAME.format(d='d', n='username', k='user', f='c.user_id')} AS username
                FROM c5 c LEFT JOIN users d ON d.user_id = c.user_id WHERE {_IN5.replace('ts5', 'c.ts5')}) AS named
            WHERE user_id IN (SELECT user_id FROM c5 WHERE {_IN5} GROUP BY user_id
                ORDER BY count(DISTINCT ip_prefix) DESC, user_id LIMIT 10) GROUP BY ALL""",
        "r_shared_addresses": _SHARED,
        "r_hosting_connections": """SELECT username, node_name, ip, country, city, asn, as_org, max(last_seen) AS last_seen,
            count(*) AS snapshots FROM wc WHERE is_hosting = 1 GROUP BY username, node_name, ip, country, city, asn, as_org
            ORDER BY last_seen DESC, username, node_name, ip, country, city, asn, as_org LIMIT 200""",
        "r_country_addresses": """SELECT country, count(DISTINCT ip) AS addresses FROM wc WHERE country <> ''
            GROUP BY country ORDER BY addresses DESC, country LIMIT 15""",
        "r_account_geography": """SELECT username, country, as_org, count(DISTINCT ip) AS addresses,
            count(DISTINCT node_name) AS nodes, max(last_seen) AS last_seen FROM wc GROUP BY username, country, as_org
            ORDER BY username, addresses DESC, country, as_org LIMIT 500""",
        # node reports
        "r_node_names": "SELECT DISTINCT node_name FROM wu",
        "r_traffic_total": "SELECT CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM wu",
        "r_active_users": "SELECT count(DISTINCT user_id) AS users FROM wu",
        "r_peak_node_bps": """SELECT coalesce(max(bps), 0.0::DOUBLE) AS peak_bps FROM
            (SELECT ts5, node_name, CAST(sum(bytes) * 8 AS DOUBLE) / 300.0::DOUBLE AS bps FROM wu GROUP BY ts5, node_name) AS per""",
        "r_nodes_reporting": "SELECT count(DISTINCT node_id) AS nodes FROM wu",
        "r_p95_user_traffic": """SELECT coalesce(list_sort(list(b))[CAST(floor(0.95::DOUBLE * count(*)) AS BIGINT) + 1], 0) AS p95
            FROM (SELECT user_id, CAST(sum(bytes) AS BIGINT) AS b FROM wu GROUP BY user_id) AS per""",
        "r_throughput_by_node": """SELECT ts5 AS time, node_name, CAST(sum(bytes) * 8 AS DOUBLE) / 300.0::DOUBLE AS bps
            FROM wu GROUP BY ts5, node_name""",
        "r_top10_throughput": _top_series(
            "wu", "ts5", "CAST(sum(bytes) * 8 AS DOUBLE) / 300.0::DOUBLE AS bps", "sum(bytes)"
        ),
        "r_top_talkers": _TALKERS,
        "r_traffic_by_node": "SELECT node_name, CAST(sum(bytes) AS BIGINT) AS bytes FROM wu GROUP BY node_name",
        "r_top5_per_node": _top5("wu"),
        # request reports
        "r_requests": "SELECT count(*) AS requests FROM wr",
        "r_request_accounts": "SELECT count(DISTINCT user_id) AS users FROM wr",
        "r_request_ips": "SELECT count(DISTINCT ip) AS ips FROM wr",
        "r_requests_by_kind": f"SELECT {_B5} AS time, ua_kind, count(*) AS requests FROM wr GROUP BY ALL",
        "r_busiest10": _top_series("wr", _B5, "count(*) AS requests", "count(*)"),
        "r_response_types": """SELECT srr_response_type, count(*) AS requests FROM wr
            WHERE srr_response_type <> '' GROUP BY srr_response_type""",
        "r_refused_by_rule": """SELECT CASE WHEN srr_rule_name = '' THEN '(unnamed)' ELSE srr_rule_name END AS rule,
            srr_response_type, count(*) AS requests, count(DISTINCT user_id) AS accounts,
            count(DISTINCT ua_family) AS clients, max(ts) AS last_seen FROM wr WHERE is_blocked = 1 GROUP BY ALL
            ORDER BY requests DESC, rule, srr_response_type LIMIT 100""",
        "r_fetch_offenders": _OFFENDERS,
        "r_client_families": """SELECT ua_family, count(*) AS requests FROM wr GROUP BY ua_family
            ORDER BY requests DESC, ua_family LIMIT 15""",
        "r_top_countries": """SELECT country, count(*) AS requests FROM wr WHERE country <> '' GROUP BY country
            ORDER BY requests DESC, country LIMIT 15""",
        "r_top_networks": _NETWORKS,
        "r_recent_requests": """SELECT ts, username, ip, country, city, as_org, ua_family, ua_kind, srr_response_type,
            srr_rule_name, user_agent FROM wr ORDER BY ts DESC, user_id, ip, country, city, as_org, ua_family, ua_kind,
            srr_response_type, srr_rule_name, user_agent LIMIT 500""",
        # streaming
        "stream_usage_5m": "SELECT * FROM u5",
        "restart_new_checkpoint": "SELECT ts5, node_id, user_id, CAST(2 * bytes AS BIGINT) AS bytes FROM u5",
        "resume_from_now": _USER_SUMS,
        "stream_small_batches": f"""SELECT '{USAGE_STREAM}' AS stream, CAST(4 AS BIGINT) AS batches, count(*) AS messages,
            CAST(0 AS BIGINT) AS failed, CAST(4 * count(*) AS BIGINT) AS "rows" FROM events""",
        "stream_byte_batches": f"""SELECT '{USAGE_STREAM}' AS stream, count(*) AS messages, CAST(0 AS BIGINT) AS failed,
            CAST(4 * count(*) AS BIGINT) AS "rows", true AS cut FROM events""",
        "stream_pending": """SELECT TIMESTAMP '2024-01-01 00:00:00' AS at, count(*) AS entries, true AS waiting FROM events WHERE event_id % 2 = 0
            UNION ALL SELECT TIMESTAMP '2024-01-01 00:01:00', CAST(0 AS BIGINT), false
            UNION ALL SELECT TIMESTAMP '2024-01-01 00:02:00', count(*), true FROM events WHERE event_id % 2 = 1""",
        "read_networks_accounts": f"""SELECT CASE WHEN c_custkey % 3 = 0
            THEN '2a02:' || lower(to_hex(c_custkey % 65536)) || ':' || lower(to_hex(c_custkey // 65536)) || '::/48'
            ELSE (30 + c_custkey // 62500 % 60) || '.' || (c_custkey // 250 % 250) || '.' || (c_custkey % 250) || '.0/24' END AS network,
            {_CODE.format('n.n_nationkey').replace('n_name', 'n.n_name')} AS country,
            {_CODE.format('r.n_nationkey').replace('n_name', 'r.n_name')} AS registered_country, 'City_' || n.n_nationkey AS city
            FROM customer JOIN nation n ON n.n_nationkey = c_nationkey JOIN nation r ON r.n_nationkey = (c_nationkey + 7) % 25""",
        "table_sizes": f"""SELECT 'user_usage' AS "table", count(*) AS "rows" FROM usage
            UNION ALL SELECT 'usage_5m', count(*) FROM (SELECT DISTINCT {_B5}, node_id, user_id FROM usage)
            UNION ALL SELECT 'dim_nodes', count(*) FROM supplier""",
        "refreshed_networks": f"""SELECT country, count(*) AS requests FROM
            (SELECT country FROM ({_MESSAGE_ROWS}) AS a UNION ALL
             SELECT CASE WHEN country = '' THEN '' ELSE country || ' 2' END FROM ({_MESSAGE_ROWS}) AS b) AS both_ GROUP BY country""",
        "stream_dedup_two_batches": _USER_SUMS,
        "replay_after_compact": f"""SELECT user_id, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS facts
            FROM ({_USAGE_RECORDS}) AS records GROUP BY user_id""",
        "dedup_many_days": "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS entries, count(*) AS ids FROM events GROUP BY 1",
        "unreadable_entries": f"""SELECT stream, reason, n, n AS with_payload FROM ({_QUARANTINE}) AS q
            UNION ALL SELECT '', 'unreadable_entry', CAST(2 * count(*) AS BIGINT), CAST(2 * count(*) AS BIGINT) FROM events
            UNION ALL SELECT 'other', 'unknown_stream', count(*), count(*) FROM events""",
        "stream_quality": _MEASURES,
        "stream_watermark_rollup": f"""SELECT {_B5} AS ts5, node_id, user_id, CAST(sum(bytes) AS BIGINT) AS bytes
            FROM usage GROUP BY ALL""",
        "stream_late_corrections": "SELECT *, ts5 < TIMESTAMP '2024-01-10 00:00:00' AS corrected FROM u5",
        "stream_ingest": _STREAMED,
        "dedup_entries": " UNION ALL ".join(
            f"SELECT '{prefix}-' || event_id AS entry_id, '{stream}' AS stream FROM events"
            for prefix, stream in (
                ("u", USAGE_STREAM), ("r", REQUEST_STREAM), ("c", CONNECTION_STREAM),
                ("bu", USAGE_STREAM), ("br", REQUEST_STREAM), ("bc", CONNECTION_STREAM),
            )
        ),
        "ingest_quality": _MEASURES,
    }


# Reports over a window with both edges inside the data, and with limits that cut.
_EDGED = {
    "edge_abuse_score": "r_abuse_score",
    "edge_top_talkers": "r_top_talkers",
    "edge_fetch_offenders": "r_fetch_offenders",
    "edge_account_geography": "r_account_geography",
}
_CUT = {
    "cut_abuse_score": ("r_abuse_score", 200, 20),
    "cut_top_talkers": ("r_top_talkers", 100, 9),
    "cut_fetch_offenders": ("r_fetch_offenders", 200, 20),
    "cut_refused_by_rule": ("r_refused_by_rule", 100, 4),
    "cut_top_networks": ("r_top_networks", 50, 7),
    "cut_client_families": ("r_client_families", 15, 3),
}


def oracle_sql() -> dict[str, str]:
    found = {name: _sql(body) for name, body in _statements().items()}
    for name, whole in _EDGED.items():
        found[name] = found[whole].replace(f"'{T_FROM}'", f"'{EDGE_FROM}'").replace(f"'{T_TO}'", f"'{EDGE_TO}'")
    for name, (whole, limit, less) in _CUT.items():
        found[name] = found[whole].replace(f"LIMIT {limit}", f"LIMIT {less}")
    return found
