"""A small hand-computed scenario through decoding, rollups, score and reports."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from accesslens import schemas
from accesslens.catalogue import REPORTS
from accesslens.operators import decode as d
from accesslens.operators import rollups
from accesslens.plans.abuse import account_measures, exact_abuse, user_abuse
from accesslens.plans.severity import report_bands
from accesslens.plans.views import Tables

NOW = dt.datetime(2025, 3, 2, 8, 1)
WINDOW = ("2025-03-01 08:00:00", "2025-03-02 08:30:00")
ROUNDS = 4  # ten minutes apart, so each has a bucket of its own
LENT, QUIET = 19_000_000_000, 1_000_000_000


def stamp(minutes):
    return (NOW + dt.timedelta(minutes=minutes)).isoformat() + "Z"


def seed_messages():
    """Account 71 lends its access, account 72 does not."""

    def seen(at, *ips):
        return [{"ip": ip, "lastSeen": stamp(at)} for ip in ips]

    out = []
    for i in range(ROUNDS):
        at = -10 * i
        head = {"v": "1", "ts": stamp(at)}
        out.append((d.USAGE_STREAM, {**head, "nodeId": "11", "records": "71:4000000000;72:250000000"}))
        if i < 2:
            out.append((d.USAGE_STREAM, {**head, "nodeId": "12", "records": "71:1500000000"}))
        out += [
            (d.CONNECTION_STREAM, {**head, "nodeId": "11", "users": json.dumps([
                {"userId": "71", "ips": seen(at, "31.13.1.5", "31.13.1.6", "52.0.7.9", "2a10:1::5")},
                {"userId": "72", "ips": seen(at, "84.1.1.1")},
            ])}),
            (d.CONNECTION_STREAM, {**head, "nodeId": "12", "users": json.dumps(
                [{"userId": "71", "ips": seen(at, "52.0.7.9")}])}),
        ]
        for user, ip, agent, response, delay in [
            ("71", "31.13.1.5", "Wget/1.20.3", "BLOCK", 0),
            ("71", "52.0.7.9", "Python/3.11 aiohttp/3.9.1", "STATUS_CODE_451", 2),
            ("72", "84.1.1.1", "HiddifyNext/1.4 (android)", "SINGBOX", 0),
        ]:
            rule = {"srrRuleName": "no-robots"} if user == "71" else {}
            out.append((d.REQUEST_STREAM, {
                "v": "1", "userId": user, "requestAt": stamp(at + delay), "requestIp": ip, "userAgent": agent,
                "srrResponseType": response, **rule,
            }))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    data = [(str(i), stream, fields) for i, (stream, fields) in enumerate(seed_messages())]
    entries = spark.createDataFrame(data, schemas.ENTRY)
    facts = {spec.table: spec.rows(entries)[0].cache() for spec in d.STREAMS.values()}
    users = [
        (71, "lender", "ACTIVE", "BETA", Decimal(0), 1, NOW, NOW), (72, "quiet", "ACTIVE", "", Decimal(0), 5, NOW, NOW),
    ]
    nodes = [(11, "u1", "alpha", "SE", NOW), (12, "u2", "beta", "PT", NOW)]
    return Tables(
        usage_5m=rollups.usage_5m(facts["user_usage"]).cache(),
        user_conn_5m=rollups.user_conn_5m(facts["node_connections"]).cache(),
        sub_req_5m=rollups.sub_req_5m(facts["sub_requests"]).cache(),
        sub_requests=facts["sub_requests"],
        node_connections=facts["node_connections"],
        dim_users=spark.createDataFrame(users, schemas.DIM_USERS),
        dim_nodes=spark.createDataFrame(nodes, schemas.DIM_NODES),
    )


def abuse(t, **options):
    return user_abuse(t.usage_5m, t.user_conn_5m, t.sub_req_5m, t.dim_users, *WINDOW, **options)


# 25.2: 17.695 gigabytes, one network over two for 2, eight scripted for 4, three blocked over five for 1.5.
def test_scores(tables):
    got = {r.user_id: tuple(r)[1:] for r in abuse(tables).collect()}
    assert got == {
        71: ("lender", "ACTIVE", "BETA", 1, LENT, 17.7, 2, 4, 3, 1, 0, 2, 0, 8, 8, 8, 2, 2, 25.2),
        72: ("quiet", "ACTIVE", "", 5, QUIET, 0.93, 1, 1, 1, 1, 0, 1, 0, 4, 0, 0, 1, 1, 0.9),
    }


def test_weights_and_allowances_are_tunable(tables):
    got = {r.user_id: r.score for r in abuse(tables, weights={"gigabyte": 0, "scripted": 10}).collect()}
    assert got == {71: 83.5, 72: 0.0}
    got = {r.user_id: r.score for r in abuse(tables, weights={"gigabyte": 0}, free={"network": 0, "blocked": 8}).collect()}
    assert got == {71: 10.0, 72: 2.0}


def test_exact_variant_agrees(spark, tables):
    data = [(str(i), stream, fields) for i, (stream, fields) in enumerate(seed_messages())]
    usage = d.STREAMS[d.USAGE_STREAM].rows(spark.createDataFrame(data, schemas.ENTRY))[0]
    got = exact_abuse(usage, tables.node_connections, tables.sub_requests, tables.dim_users, *WINDOW)
    want = abuse(tables)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_repeating_a_batch_keeps_distinct_counts(tables):
    twice = [df.unionByName(df) for df in (tables.usage_5m, tables.user_conn_5m, tables.sub_req_5m)]
    row = account_measures(*twice, *WINDOW).filter("user_id = 71").first()
    assert (row.ips, row.prefixes, row.sub_ips, row.bytes) == (4, 3, 2, 2 * LENT)


def report(tables, name, **options):
    return [r.asDict() for r in REPORTS[name](tables, *WINDOW, **options).collect()]


def one(tables, name, **options):
    (row,) = report(tables, name, **options)
    (value,) = row.values()
    return value


def test_every_report_runs(tables):
    for name in REPORTS:
        assert report(tables, name) is not None


def test_single_values(tables):
    assert one(tables, "r_flagged_accounts") == 0
    assert one(tables, "r_over_device_limit") == 1
    assert one(tables, "r_shared_address_count") == 0
    assert one(tables, "r_scripted_fetches") == 8
    assert one(tables, "r_traffic_total") == LENT + QUIET
    assert one(tables, "r_traffic_total", nodes=["beta"]) == 3_000_000_000
    assert one(tables, "r_active_users", nodes=["beta"]) == 1
    assert one(tables, "r_nodes_reporting") == 2
    assert one(tables, "r_peak_node_bps") == 4_250_000_000 * 8 / 300
    assert one(tables, "r_heaviest_share") == 95.0
    assert one(tables, "r_p95_user_traffic") == LENT
    assert one(tables, "r_requests") == 12
    assert one(tables, "r_scripted_share") == 66.7
    assert one(tables, "r_busiest_account") == 8
    assert one(tables, "r_request_ips") == 3


def test_tables(tables):
    assert [r["username"] for r in report(tables, "r_abuse_score")] == ["lender", "quiet"]
    assert report(tables, "r_refused_by_rule")[0] == {
        "rule": "no-robots", "srr_response_type": "BLOCK", "requests": 4, "accounts": 1, "clients": 1,
        "last_seen": NOW,
    }
    offender = report(tables, "r_fetch_offenders")[0]
    # The unknown country counts as one here, unlike in the score.
    assert (offender["username"], offender["countries"], offender["refused"]) == ("lender", 1, 8)
    assert (offender["ips"], offender["networks"], offender["user_agents"]) == (2, 2, 2)
    shares = {(r["node_name"], r["username"]): r["pct_of_node"] for r in report(tables, "r_top5_per_node")}
    assert shares == {("alpha", "lender"): 94.1, ("alpha", "quiet"): 5.9, ("beta", "lender"): 100.0}
    assert report(tables, "r_node_names") == [{"node_name": "alpha"}, {"node_name": "beta"}]


def test_cut_by_name_where_sums_tie(spark, tables):
    """The limit keeps the smaller name, not the smaller id."""
    usage = spark.createDataFrame(
        [(NOW, 11, i, Decimal(5)) for i in (1, 2, 3, 4)], schemas.USAGE_5M
    )
    users = spark.createDataFrame(
        [(i, name, "A", "", Decimal(0), 0, NOW, NOW) for i, name in ((1, "d"), (2, "c"), (3, "b"), (4, "a"))], schemas.DIM_USERS
    )
    tied = Tables(**{**tables.__dict__, "usage_5m": usage, "dim_users": users})
    assert [r["username"] for r in report(tied, "r_top_talkers", limit=2)] == ["a", "b"]


def test_borrowed_display_names_merge(spark, tables):
    """An account may be called like the fallback name of another."""
    users = spark.createDataFrame([(71, "user-72", "ACTIVE", "", Decimal(0), 0, NOW, NOW)], schemas.DIM_USERS)
    borrowed = Tables(**{**tables.__dict__, "dim_users": users})
    (row,) = report(borrowed, "r_top_talkers")
    assert (row["username"], row["total_bytes"]) == ("user-72", LENT + QUIET)
    assert {r["username"] for r in report(borrowed, "r_fetch_offenders")} == {"user-72"}


def test_node_filter_by_shown_name(spark, tables):
    nodes = spark.createDataFrame([(11, "u", "node-12", "", NOW), (13, "u", "", "", NOW)], schemas.DIM_NODES)
    odd = Tables(**{**tables.__dict__, "dim_nodes": nodes})
    assert one(odd, "r_traffic_total", nodes=["node-12"]) == LENT + QUIET
    assert one(odd, "r_traffic_total", nodes=["node-11"]) == 0
    assert one(tables, "r_traffic_total", nodes=["node-12"]) == 0


def test_empty_window(tables):
    later = ("2030-01-01 00:00:00", "2030-01-02 00:00:00")

    def value(name):
        return tuple(REPORTS[name](tables, *later).first())[0]

    for name in ("r_traffic_total", "r_active_users", "r_peak_node_bps", "r_p95_user_traffic", "r_busiest_account",
                 "r_scripted_fetches", "r_flagged_accounts"):
        assert value(name) == 0, name
    assert value("r_heaviest_share") is None and value("r_scripted_share") is None


def test_bands(tables):
    rows = report_bands(REPORTS["r_abuse_score"](tables, *WINDOW), "abuse_score").collect()
    assert [(r.score_severity, r.networks_severity, r.countries_severity) for r in rows] == [
        ("yellow", "text", "text"), ("green", "text", "text"),
    ]


def test_names_fall_back_and_merge(spark, tables):
    users = spark.createDataFrame(
        [(71, "same", "A", "", Decimal(0), 0, NOW, NOW), (72, "same", "B", "", Decimal(0), 0, NOW, NOW)], schemas.DIM_USERS
    )
    merged = Tables(**{**tables.__dict__, "dim_users": users})
    assert [r["total_bytes"] for r in report(merged, "r_top_talkers")] == [LENT + QUIET]
    nobody = Tables(**{**tables.__dict__, "dim_users": users.limit(0), "dim_nodes": tables.dim_nodes.limit(0)})
    assert {r["username"] for r in report(nobody, "r_top_talkers")} == {"user-71", "user-72"}
    assert report(nobody, "r_node_names") == [{"node_name": "node-11"}, {"node_name": "node-12"}]
    assert {r["status"] for r in report(nobody, "r_abuse_score")} == {""}


def test_shared_addresses_list_at_most_ten_names(spark, tables):
    crowd = tables.node_connections.limit(1).drop("user_id").withColumn(
        "user_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(24).cast("bigint")))
    )
    (row,) = report(Tables(**{**tables.__dict__, "node_connections": crowd}), "r_shared_addresses")
    assert row["accounts"] == 25 and len(row["usernames"].split(", ")) == 10
    assert row["usernames"].split(", ") == sorted(f"user-{i}" for i in range(25))[:10]


def test_sql_views_and_function(spark, tables):
    from accesslens.plans.sql import register

    register(spark, tables)
    call = "v_user_abuse(TIMESTAMP_NTZ '2025-03-01 08:00:00', TIMESTAMP_NTZ '2025-03-02 08:30:00')"
    got = spark.sql(f"SELECT * FROM {call} ORDER BY score DESC")
    want = abuse(tables).orderBy(F.desc("score"))
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    top = spark.sql("SELECT username, sum(bytes) AS b FROM v_usage GROUP BY username ORDER BY b DESC LIMIT 1").first()
    assert top.username == "lender"
    assert spark.sql("SELECT count(*) FROM v_sub_requests WHERE is_blocked = 1").first()[0] == 8
    assert spark.sql("SELECT count(DISTINCT node_name) FROM v_connections").first()[0] == 2
