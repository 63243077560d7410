"""The views and the score function for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

from accesslens.functions.values import unsigned_text
from accesslens.plans import views
from accesslens.plans.abuse import GIGABYTES_SQL, score_sql
from accesslens.plans.views import Tables

_STATE = "theta_sketch_estimate(theta_union_agg({state}, 16))"


def register(spark: SparkSession, t: Tables) -> None:
    """Create the temporary views and ``v_user_abuse(from, to)``.

    The views keep the partition column (``month`` or ``day``) of stored
    tables: a filter on it next to the one on the time reads only these
    partitions. The function takes the range as parameters, because a filter
    on a plain view could not move below its aggregate, and derives the
    partition test from them.
    """
    for name in ("usage_5m", "user_conn_5m", "sub_req_5m", "sub_requests", "node_connections", "dim_users", "dim_nodes"):
        getattr(t, name).createOrReplaceTempView(name)
    views.v_users(t.dim_users).createOrReplaceTempView("v_users")
    views.v_nodes(t.dim_nodes).createOrReplaceTempView("v_nodes")
    views.v_usage(t.usage_5m, t.dim_users, t.dim_nodes).createOrReplaceTempView("v_usage")
    views.v_connections(t.node_connections, t.dim_users, t.dim_nodes).createOrReplaceTempView("v_connections")
    views.v_sub_requests(t.sub_requests, t.dim_users).createOrReplaceTempView("v_sub_requests")
    spark.sql(_function(t))


def _inside(columns: list[str]) -> str:
    """The range, and the months it touches where the table is stored by month."""
    lo, hi = "v_user_abuse.`from`", "v_user_abuse.`to`"
    month = "year({0}) * 100 + month({0})"
    tests = [f"ts5 BETWEEN {lo} AND {hi}"]
    if "month" in columns:
        tests.append(f"month BETWEEN {month.format(lo)} AND {month.format(hi)}")
    return " AND ".join(tests)


def _function(t: Tables) -> str:
    conn = ("ips", "prefixes", "asns", "countries", "nodes", "hosting_ips")
    states = [f"{c} AS c_{c}" for c in conn]
    unused = [f"CAST(NULL AS BINARY) AS c_{c}" for c in conn]
    counted = ", ".join(f"{_STATE.format(state=f'c_{c}')} AS {c}" for c in conn)
    return f"""
    CREATE OR REPLACE TEMPORARY FUNCTION v_user_abuse(`from` TIMESTAMP_NTZ, `to` TIMESTAMP_NTZ)
    RETURNS TABLE
    RETURN
    WITH stacked AS (
        SELECT user_id, sum(bytes) AS bytes, node_id, {', '.join(unused)}, CAST(NULL AS BIGINT) AS requests,
            CAST(NULL AS BIGINT) AS scripted, CAST(NULL AS BIGINT) AS blocked,
            CAST(NULL AS BINARY) AS s_ips, CAST(NULL AS BINARY) AS s_uas
        FROM usage_5m WHERE {_inside(t.usage_5m.columns)} AND bytes > 0 GROUP BY user_id, node_id
        UNION ALL
        SELECT user_id, NULL, NULL, {', '.join(states)}, NULL, NULL, NULL, NULL, NULL
        FROM user_conn_5m WHERE {_inside(t.user_conn_5m.columns)}
        UNION ALL
        SELECT user_id, NULL, NULL, {', '.join(['NULL'] * len(conn))}, requests, scripted, blocked, ips, uas
        FROM sub_req_5m WHERE {_inside(t.sub_req_5m.columns)}
    ), measures AS (
        SELECT user_id,
            CASE WHEN sum(bytes) > 9223372036854775807 THEN 9223372036854775807
                ELSE CAST(coalesce(sum(bytes), 0) AS BIGINT) END AS bytes,
            theta_sketch_estimate(theta_sketch_agg(node_id, 16)) AS traffic_nodes, {counted},
            coalesce(sum(requests), 0) AS sub_requests, coalesce(sum(scripted), 0) AS sub_scripted,
            coalesce(sum(blocked), 0) AS sub_blocked, {_STATE.format(state='s_ips')} AS sub_ips,
            {_STATE.format(state='s_uas')} AS sub_uas
        FROM stacked GROUP BY user_id
    ), scored AS (SELECT *, {GIGABYTES_SQL} AS gigabytes, {score_sql()} AS score FROM measures)
    SELECT m.user_id, coalesce(nullif(u.username, ''), concat('user-', {unsigned_text('m.user_id')})) AS username,
        coalesce(u.status, '') AS status, coalesce(u.tag, '') AS tag,
        coalesce(u.hwid_device_limit, 0) AS hwid_device_limit, bytes, gigabytes, traffic_nodes, {', '.join(conn)},
        sub_requests, sub_scripted, sub_blocked, sub_ips, sub_uas, score
    FROM scored m LEFT JOIN v_users u ON u.user_id = m.user_id
    """
