"""Schemas of the stored tables and of the stream entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "DECIMAL(20,0)": T.DecimalType(20, 0),
    "DECIMAL(38,0)": T.DecimalType(38, 0),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def _schema(text: str) -> T.StructType:
    """StructType of ``name TYPE, …``; needs no running session."""
    columns = [column.split() for column in text.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


ENTRY = _schema("entry_id STRING, stream STRING, fields MAP<STRING,STRING>")

# Ids are unsigned 64-bit numbers, held in the same 64 bits as BIGINT; byte counts are exact decimals.
USER_USAGE = _schema("ts TIMESTAMP_NTZ, node_id BIGINT, user_id BIGINT, bytes DECIMAL(20,0)")

SUB_REQUESTS = _schema(
    "ts TIMESTAMP_NTZ, user_id BIGINT, ip STRING, ip_prefix STRING, country STRING, city STRING, "
    "asn BIGINT, as_org STRING, is_hosting INT, user_agent STRING, ua_family STRING, "
    "ua_kind STRING, srr_response_type STRING, srr_rule_name STRING"
)

NODE_CONNECTIONS = _schema(
    "ts TIMESTAMP_NTZ, node_id BIGINT, user_id BIGINT, ip STRING, ip_prefix STRING, "
    "last_seen TIMESTAMP_NTZ, country STRING, city STRING, asn BIGINT, as_org STRING, "
    "is_hosting INT"
)

DIM_USERS = _schema(
    "user_id BIGINT, username STRING, status STRING, tag STRING, traffic_limit_bytes DECIMAL(20,0), "
    "hwid_device_limit BIGINT, expire_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

DIM_NODES = _schema(
    "node_id BIGINT, uuid STRING, name STRING, country_code STRING, updated_at TIMESTAMP_NTZ"
)

QUARANTINE = _schema(
    "entry_id STRING, stream STRING, reason STRING, fields MAP<STRING,STRING>, raw STRING"
)

USAGE_5M = _schema("ts5 TIMESTAMP_NTZ, node_id BIGINT, user_id BIGINT, bytes DECIMAL(38,0)")

USER_CONN_5M = _schema(
    "ts5 TIMESTAMP_NTZ, user_id BIGINT, ips BINARY, prefixes BINARY, asns BINARY, "
    "countries BINARY, nodes BINARY, hosting_ips BINARY"
)

SUB_REQ_5M = _schema(
    "ts5 TIMESTAMP_NTZ, user_id BIGINT, requests BIGINT, ips BINARY, prefixes BINARY, "
    "asns BINARY, countries BINARY, uas BINARY, scripted BIGINT, blocked BIGINT"
)

# Numbers of the values of large accounts, and which of them a bucket has seen, as bits.
VALUE_NUMBERS = _schema("user_id BIGINT, kind STRING, h1 BIGINT, h2 BIGINT, number BIGINT")
VALUES_5M = _schema("ts5 TIMESTAMP_NTZ, user_id BIGINT, kind STRING, slot BIGINT, bits BIGINT")

_EMPTY_VALUES = {
    T.StringType: "",
    T.LongType: 0,
    T.DecimalType: 0,
    T.IntegerType: 0,
}


def conform(
    df: DataFrame, schema: T.StructType, *, late: tuple[str, ...] = (), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Project ``df`` onto ``schema``; absent columns read as empty values.

    Columns named in ``late`` joined the schema after some rows were written;
    where they are NULL they read as ``''`` or ``0``. All others pass through
    untouched, so filters on them still reach the scan.
    """
    have = set(df.columns)
    columns = []
    for field in schema:
        empty = F.lit(_EMPTY_VALUES.get(type(field.dataType))).cast(field.dataType)
        if field.name not in have:
            column = empty
        elif field.name in late:
            column = F.coalesce(F.col(field.name), empty)
        else:
            column = F.col(field.name)
        columns.append(column.alias(field.name))
    return df.select(*columns, *[c for c in keep if c in have])


def union_versions(schema: T.StructType, *versions: DataFrame) -> DataFrame:
    """Union tables written under older and newer versions of ``schema``."""
    merged = versions[0]
    for part in versions[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    late = tuple(c for c in schema.names if any(c not in v.columns for v in versions))
    return conform(merged, schema, late=late)
