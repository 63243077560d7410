"""Message contract: what decodes, what is rejected and why."""

import datetime as dt

import pytest

from accesslens import schemas
from accesslens.functions.values import unsigned_text
from accesslens.operators import decode as d
from accesslens.sources.dimensions import NODES_PAGE, USERS_PAGE, load_dim_nodes, load_dim_users

TS = "2026-07-16T10:20:30.123456789Z"
AT = dt.datetime(2026, 7, 16, 10, 20, 30, 123000)


def entries(spark, stream, *messages):
    rows = [(f"{i}-0", stream, m) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, schemas.ENTRY)


def usage(**changes):
    fields = {"v": "1", "nodeId": "7", "ts": TS, "records": "9:700;10:31;11:0", **changes}
    return {k: v for k, v in fields.items() if v is not None}


def reasons(rejects):
    return [r.reason for r in sorted(rejects.collect(), key=lambda r: int(r.entry_id[:-2]))]


def test_usage(spark):
    rows, rejects = d.decode_user_usage(entries(spark, d.USAGE_STREAM, usage()))
    assert [tuple(r) for r in rows.collect()] == [(AT, 7, 9, 700), (AT, 7, 10, 31), (AT, 7, 11, 0)]
    assert rejects.count() == 0
    assert rows.schema.simpleString() == schemas.USER_USAGE.simpleString()


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"v": "1.0"}, "unsupported_version"),
        ({"v": None}, "missing_v"),
        ({"v": ""}, "missing_v"),
        ({"nodeId": None}, "missing_nodeId"),
        ({"nodeId": "+5"}, "bad_nodeId"),
        ({"nodeId": " 5 "}, "bad_nodeId"),
        ({"nodeId": "1.0"}, "bad_nodeId"),
        ({"nodeId": "18446744073709551616"}, "uint64_out_of_range"),
        ({"nodeId": "9" * 60}, "uint64_out_of_range"),
        ({"ts": "3 pm"}, "bad_ts"),
        ({"ts": "2026-07-16"}, "bad_ts"),
        ({"ts": "2026-13-16T10:20:30Z"}, "bad_ts"),
        ({"ts": "2026-07-16T10:20:30"}, "bad_ts"),
        ({"records": "8;9:1"}, "malformed_record"),
        ({"records": ""}, "missing_records"),
        ({"records": ";;"}, "empty_records"),
        ({"records": "1:2:3"}, "bad_record"),
        ({"records": "1:"}, "bad_record"),
        ({"records": ":1"}, "bad_record"),
        ({"records": "1:2;x:3"}, "bad_record"),
        ({"records": "1:18446744073709551616"}, "uint64_out_of_range"),
    ],
)
def test_usage_rejects(spark, change, reason):
    rows, rejects = d.decode_user_usage(entries(spark, d.USAGE_STREAM, usage(**change)))
    assert rows.count() == 0 and reasons(rejects) == [reason]


def test_usage_accepts(spark):
    messages = [usage(records="1:2;;"), usage(records="1:18446744073709551615"), usage(ts="2026-07-16T13:20:30+03:00")]
    rows, rejects = d.decode_user_usage(entries(spark, d.USAGE_STREAM, *messages))
    got = [tuple(r)[2:] for r in rows.collect()]
    assert got[:2] == [(1, 2), (1, 2**64 - 1)] and len(got) == 5
    assert rejects.count() == 0
    assert rows.filter("node_id = 7").agg({"ts": "min"}).first()[0] == dt.datetime(2026, 7, 16, 10, 20, 30)


def test_ids_keep_all_64_bits(spark):
    records = ";".join(f"{n}:{n}" for n in (0, 2**63 - 1, 2**63, 2**64 - 1)) + ";" + "0" * 30 + "5:6"
    rows, rejects = d.decode_user_usage(entries(spark, d.USAGE_STREAM, usage(nodeId=str(2**64 - 2), records=records)))
    shown = rows.selectExpr(f"{unsigned_text('node_id')} AS n", f"{unsigned_text('user_id')} AS u", "CAST(bytes AS STRING) AS b")
    assert rejects.count() == 0 and [tuple(r) for r in shown.collect()] == [
        (str(2**64 - 2), str(u), str(b))
        for u, b in [(0, 0), (2**63 - 1,) * 2, (2**63,) * 2, (2**64 - 1,) * 2, (5, 6)]
    ]


def test_a_snapshot_is_parsed_once(spark):
    marked = d.judged(entries(spark, d.CONNECTION_STREAM, snapshot("[]")))
    for df in (d.STREAMS[d.CONNECTION_STREAM].stored_rows(marked), d.rejects(marked)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_entries_of_no_stream_are_rejects(spark):
    rows = [("1", "other", {"v": "1"}, None), ("2", "", None, "{half"), ("3", d.USAGE_STREAM, None, "5")]
    df = spark.createDataFrame(rows, "entry_id string, stream string, fields map<string,string>, raw string")
    got = {r.entry_id: (r.reason, r.raw) for r in d.rejects(d.judged(df)).collect()}
    assert got == {"1": ("unknown_stream", None), "2": ("unreadable_entry", "{half"), "3": ("unreadable_entry", "5")}


def test_requests(spark):
    least = {"v": "1", "userId": "42", "requestAt": TS}
    messages = [
        least,
        {**least, "ssrResponseType": "BLOCK"},
        {**least, "srrResponseType": "BLOCK"},
        {**least, "ssrResponseType": "", "srrResponseType": "BLOCK"},
        {**least, "ssrResponseType": "A", "srrResponseType": "B", "srrRuleName": "r", "requestIp": " x", "userAgent": "u"},
        {**least, "userId": "x"},
        {**least, "requestAt": "now"},
    ]
    rows, rejects = d.decode_sub_requests(entries(spark, d.REQUEST_STREAM, *messages))
    assert [tuple(r)[2:] for r in rows.collect()] == [
        ("", "", "", ""), ("", "", "BLOCK", ""), ("", "", "BLOCK", ""), ("", "", "BLOCK", ""), (" x", "u", "A", "r"),
    ]
    assert reasons(rejects) == ["bad_userId", "bad_requestAt"]


IP = '{"ip":"45.6.7.8","lastSeen":"2026-07-16T10:20:30Z"}'


def snapshot(users):
    return {"v": "1", "nodeId": "7", "ts": TS, "users": users}


def test_connections(spark):
    users = (
        '[{"userId":"12","ips":[' + IP + ',{"ip":"2a0b:41::9","lastSeen":"2026-07-16T10:20:30.5+03:00"}]},'
        '{"userId":"13","ips":[]}]'
    )
    rows, rejects = d.decode_node_connections(entries(spark, d.CONNECTION_STREAM, snapshot(users)))
    assert [tuple(r) for r in rows.collect()] == [
        (AT, 7, 12, "45.6.7.8", dt.datetime(2026, 7, 16, 10, 20, 30)),
        (AT, 7, 12, "2a0b:41::9", dt.datetime(2026, 7, 16, 7, 20, 30, 500000)),
    ]
    assert rejects.count() == 0


@pytest.mark.parametrize(
    "users, rows",
    [
        ("[]", 0),
        ("null", 0),
        (" [ ] ", 0),
        ('[{"userId":"1"}]', 0),
        ('[{"userId":"1","ips":null}]', 0),
        (f'[{{"userId":"1","ips":[{IP}],"extra":{{"a":[1]}}}}]', 1),
        # Only a nested key, not the account's own: allowed.
        (f'[{{"userId":"1","ips":[{IP}],"extra":{{"userId":5}}}}]', 1),
        ('[{"userId":"1","ips":[{"ip":null,"lastSeen":"2026-07-16T10:20:30Z"}]}]', 1),
        ('[{"userId":"1","ips":[{"lastSeen":"2026-07-16T10:20:30Z"}]}]', 1),
    ],
)
def test_connections_accepts(spark, users, rows):
    good, rejects = d.decode_node_connections(entries(spark, d.CONNECTION_STREAM, snapshot(users)))
    assert (good.count(), reasons(rejects)) == (rows, [])


@pytest.mark.parametrize(
    "users",
    [
        "[{]", "{}", "[] x", "[] []", "[]} {", "5", '"x"', "[5]", "[null]", "[[]]",
        f'[{{"userId":42,"ips":[{IP}]}}]',
        f'[{{"userId":"","ips":[{IP}]}}]',
        f'[{{"userId":"-1","ips":[{IP}]}}]',
        f'[{{"ips":[{IP}]}}]',
        '[{"userId":"1","ips":{}}]',
        '[{"userId":"1","ips":"x"}]',
        '[{"userId":"1","ips":[5]}]',
        f'[{{"userId":"1","ips":[{IP},"x"]}}]',
        '[{"userId":"1","ips":[null]}]',
        '[{"userId":"1","ips":[{"ip":5,"lastSeen":"2026-07-16T10:20:30Z"}]}]',
        '[{"userId":"1","ips":[{"ip":"1.2.3.4","lastSeen":5}]}]',
        '[{"userId":"1","ips":[{"ip":"1.2.3.4"}]}]',
        '[{"userId":"1","ips":[{"ip":"1.2.3.4","lastSeen":"now"}]}]',
        f'[{{"userId":"1","ips":[{IP}]}},{{"userId":"x","ips":[]}}]',
    ],
)
def test_connections_rejects_whole_message(spark, users):
    good, rejects = d.decode_node_connections(entries(spark, d.CONNECTION_STREAM, snapshot(users)))
    assert good.count() == 0 and rejects.count() == 1


def test_row_shape_is_checked(spark):
    for spec in d.STREAMS.values():
        rows, _ = spec.rows(entries(spark, spec.stream))
        assert rows.schema.simpleString() == spec.schema.simpleString()
    wrong = d.StreamSpec(
        d.USAGE_STREAM, "user_usage", schemas.USER_USAGE, d.usage_rows,
        lambda rows, city_nets, asn_nets: rows.withColumn("bytes", rows.bytes.cast("string")),
    )
    with pytest.raises(TypeError):
        wrong.rows(entries(spark, d.USAGE_STREAM, usage()))


def pages(spark, text, schema):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "t string")
    return df.select(F.from_json("t", schema).alias("p")).select("p.*")


def test_dimension_pages(spark):
    text = (
        '{"response":{"users":[{"id":1,"username":"a","status":"ACTIVE","tag":null,"trafficLimitBytes":-5,'
        '"expireAt":"bad"},{"id":2,"username":"b","status":"X","tag":"VIP","trafficLimitBytes":12.9,'
        '"hwidDeviceLimit":3,"expireAt":"2026-07-16T10:20:30Z"}]}}'
    )
    rows = load_dim_users(pages(spark, text, USERS_PAGE), "2026-01-01 00:00:00").collect()
    assert tuple(rows[0])[:7] == (1, "a", "ACTIVE", "", 0, 0, dt.datetime(1970, 1, 1))
    assert tuple(rows[1])[:7] == (2, "b", "X", "VIP", 12, 3, dt.datetime(2026, 7, 16, 10, 20, 30))
    nodes = '{"response":[{"id":0,"uuid":"u0","name":"n0"},{"id":3,"uuid":"u3","name":"n3","countryCode":"DE"}]}'
    rows = load_dim_nodes(pages(spark, nodes, NODES_PAGE), "2026-01-01 00:00:00").collect()
    assert [tuple(r)[:4] for r in rows] == [(3, "u3", "n3", "DE")]
    useless = load_dim_nodes(pages(spark, '{"response":[{"id":0},{"uuid":"x"}]}', NODES_PAGE), "2026-01-01 00:00:00")
    with pytest.raises(Exception, match="none of the 2 nodes has a numeric id"):
        useless.collect()
    large = '{"response":{"users":[{"id":5,"trafficLimitBytes":1e19},{"id":6,"trafficLimitBytes":1e300}]}}'
    limits = [r.traffic_limit_bytes for r in load_dim_users(pages(spark, large, USERS_PAGE), "2026-01-01 00:00:00").collect()]
    assert limits == [10**19, 18446744073709552000]
    empty = load_dim_nodes(pages(spark, '{"response":[]}', NODES_PAGE), "2026-01-01 00:00:00")
    assert empty.count() == 0
