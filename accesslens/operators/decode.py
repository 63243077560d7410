"""Decoders from stream entries to fact rows.

A message is valid as a whole or not at all. ``judged`` parses each message
once and adds ``reason`` (NULL for a valid message) and the number of rows it
yields; the decoders then turn valid messages into rows. Nothing here shuffles,
and the same plan runs in batch and in streaming.

Ids are unsigned 64-bit numbers held in the 64 bits of a BIGINT, byte counts are
decimals, so no legal value is refused and no sum overflows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslens import schemas
from accesslens.functions.values import first_filled

# Stream names, contract version and field names on the wire.
USAGE_STREAM = "ioraw:export:user_usage"
REQUEST_STREAM = "ioraw:export:subscription_requests"
CONNECTION_STREAM = "ioraw:export:node_connections"
VERSION = "1"

_RFC3339 = (
    "r'^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$'"
)


# All helpers below take and return SQL text; lambdas bind what is used twice,
# because Spark evaluates a filter's repeated subexpressions again each time.


def _bind(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _instant(text: str) -> str:
    return f"CASE WHEN {text} RLIKE {_RFC3339} THEN try_cast({text} AS TIMESTAMP) END"


def _moment(text: str) -> str:
    millis = f"unix_millis({_instant(text)})"
    return f"timestampadd(MILLISECOND, {millis}, TIMESTAMP_NTZ '1970-01-01 00:00:00')"


def _field(name: str) -> str:
    return f"coalesce(fields['{name}'], '')"


_MOST = "18446744073709551615"


def _unsigned(text: str) -> str:
    """The 64 bits of a number made of digits only; from 2^63 on the BIGINT is negative."""
    wide = f"try_cast({text} AS DECIMAL(38,0))"
    return (
        f"CASE WHEN {text} RLIKE '^[0-9]{{1,18}}$' THEN CAST({text} AS BIGINT) "
        f"WHEN {text} RLIKE '^[0-9]+$' AND {wide} <= {_MOST} "
        f"THEN CAST(IF({wide} > 9223372036854775807, {wide} - {_MOST} - 1, {wide}) AS BIGINT) END"
    )


def _unsigned_problem(text: str, what: str) -> str:
    return (
        f"CASE WHEN {text} RLIKE '^[0-9]{{1,18}}$' THEN NULL WHEN NOT {text} RLIKE '^[0-9]+$' THEN 'bad_{what}' "
        f"WHEN coalesce(try_cast({text} AS DECIMAL(38,0)) > {_MOST}, TRUE) THEN 'uint64_out_of_range' END"
    )


def _missing(name: str) -> str:
    return f"IF({_field(name)} = '', 'missing_{name}', NULL)"


def _reason(id_field: str, ts_field: str, *more: str) -> str:
    """First problem of a message: version, id and time, then ``more``."""
    problems = [
        _missing("v"),
        f"IF({_field('v')} <> '{VERSION}', 'unsupported_version', NULL)",
        _missing(id_field),
        _unsigned_problem(_field(id_field), id_field),
        _missing(ts_field),
        f"IF(({_instant(_field(ts_field))}) IS NULL, 'bad_{ts_field}', NULL)",
        *more,
    ]
    return f"coalesce({', '.join(problems)})"


def rfc3339(text: str) -> Column:
    """UTC TIMESTAMP_NTZ, cut to milliseconds, of a full RFC 3339 text, else NULL."""
    return F.expr(_moment(text))


def unsigned(text: str) -> Column:
    """The 64 bits of a text made of digits only, NULL otherwise or above 2^64-1."""
    return F.expr(_unsigned(text))


def _pairs(text: str) -> str:
    return f"filter(split({text}, ';'), p -> p <> '')"


def split_packed(text: str) -> Column:
    """Split ``user:bytes;user:bytes`` into ``array<struct<user, bytes>>``.

    Empty pairs are skipped and each pair is cut at its first colon; a pair
    without a colon has NULL ``bytes``.
    """
    return F.expr(
        f"""transform({_pairs(text)}, p -> named_struct('user', substring_index(p, ':', 1),
        'bytes', IF(contains(p, ':'), substring(p, instr(p, ':') + 1), NULL)))"""
    )


def _records_problem(text: str) -> str:
    user, amount = "substring_index(p, ':', 1)", "substring(p, instr(p, ':') + 1)"
    problem = f"""CASE WHEN p RLIKE '^[0-9]{{1,18}}:[0-9]{{1,18}}$' THEN NULL
        WHEN NOT contains(p, ':') THEN 'malformed_record'
        ELSE coalesce({_unsigned_problem(user, 'record')}, {_unsigned_problem(amount, 'record')}) END"""
    return _bind(
        _pairs(text),
        "pairs",
        f"""CASE WHEN size(pairs) = 0 THEN 'empty_records'
        ELSE get(filter(transform(pairs, p -> {problem}), x -> x IS NOT NULL), 0) END""",
    )


def usage_rows(good: DataFrame) -> DataFrame:
    """Traffic batches: one row per packed ``user:bytes`` record."""
    user, amount = "substring_index(p, ':', 1)", "substring(p, instr(p, ':') + 1)"
    return (
        good.selectExpr(
            f"{_moment(_field('ts'))} AS ts",
            f"{_unsigned(_field('nodeId'))} AS node_id",
            f"{_field('records')} AS records",
        )
        .selectExpr("ts", "node_id", f"explode({_pairs('records')}) AS p")
        .selectExpr("ts", "node_id", f"{_unsigned(user)} AS user_id", f"CAST({amount} AS DECIMAL(20,0)) AS bytes")
    )


def response_type(panel_spelling: str, contract_spelling: str) -> Column:
    """The response type travels under two spellings; the panel's wins if filled."""
    return first_filled(F.expr(panel_spelling), F.expr(contract_spelling))


def request_rows(good: DataFrame) -> DataFrame:
    """Subscription fetches, not yet enriched: one row per message."""
    return good.select(
        rfc3339(_field("requestAt")).alias("ts"),
        unsigned(_field("userId")).alias("user_id"),
        F.expr(_field("requestIp")).alias("ip"),
        F.expr(_field("userAgent")).alias("user_agent"),
        response_type("fields['ssrResponseType']", "fields['srrResponseType']").alias("srr_response_type"),
        F.expr(_field("srrRuleName")).alias("srr_rule_name"),
    )


_USERS = "ARRAY<STRUCT<userId: STRING, ips: ARRAY<STRUCT<ip: STRING, lastSeen: STRING>>>>"


def _snapshot(text: str) -> str:
    """Users of a snapshot, parsed once.

    Parsing the text inside an outer object makes trailing garbage malformed.
    Wrong types end up in ``corrupt``, except that text fields also take other
    scalars, which ``_odd`` finds.
    """
    return (
        f"from_json(concat('{{\"u\":', {text}, '}}'), 'u {_USERS}, corrupt STRING', "
        "map('columnNameOfCorruptRecord', 'corrupt'))"
    )


def _odd(text: str) -> str:
    """True when a text field holds something that is neither text nor null.

    Inside a JSON string the quotes around these names would be escaped, so
    only real keys match.
    """
    return f"""{text} RLIKE r'"(userId|ip|lastSeen)"[ \t\r\n]*:[ \t\r\n]*[^" \t\r\nn]'"""


def _exact_users(text: str) -> str:
    """Strict but slower reading, for snapshots the quick one cannot vouch for.

    A user or address that breaks the contract comes out as NULL.
    """

    def kind(value: str, path: str) -> str:
        return f"coalesce(schema_of_variant(try_variant_get({value}, '{path}', 'variant')), 'VOID')"

    def string(value: str, path: str) -> str:
        return f"IF({kind(value, path)} = 'STRING', try_variant_get({value}, '{path}', 'string'), NULL)"

    sighting = f"""IF({kind('i', '$')} LIKE 'OBJECT%' AND {kind('i', '$.ip')} IN ('STRING', 'VOID'),
        named_struct('ip', {string('i', '$.ip')}, 'lastSeen', {string('i', '$.lastSeen')}), NULL)"""
    sightings = f"""CASE WHEN {kind('u', '$.ips')} = 'VOID' THEN CAST(array() AS ARRAY<VARIANT>)
        ELSE coalesce(try_variant_get(u, '$.ips', 'array<variant>'), array(CAST(NULL AS VARIANT))) END"""
    user = f"""named_struct('userId', {string('u', '$.userId')}, 'ips', transform({sightings}, i -> {sighting}))"""
    document = f"try_parse_json(concat('{{\"u\":', {text}, '}}'))"
    return f"""CASE WHEN trim({text}) = 'null' THEN CAST(array() AS {_USERS})
        WHEN rtrim({text}) LIKE '%]' THEN transform(try_variant_get({document}, '$.u', 'array<variant>'), u -> {user})
        END"""


def _users(text: str) -> str:
    """Users of a snapshot as ``array<struct<userId, ips>>``, NULL if unreadable."""
    return _bind(
        _snapshot(text),
        "d",
        f"""CASE WHEN d.corrupt IS NULL AND d.u IS NOT NULL AND rtrim({text}) LIKE '%]' AND NOT {_odd(text)}
        THEN d.u ELSE {_exact_users(text)} END""",
    )


def _users_problem(users: str) -> str:
    seen = "coalesce(i.lastSeen, '')"
    sighting = f"""CASE WHEN i IS NULL THEN 'bad_users'
        WHEN ({_instant(seen)}) IS NULL THEN 'bad_last_seen' END"""
    user = f"""coalesce({_unsigned_problem("coalesce(u.userId, '')", 'users')},
        get(filter(transform(u.ips, i -> {sighting}), x -> x IS NOT NULL), 0))"""
    return f"""CASE WHEN {users} IS NULL THEN 'bad_users'
        ELSE get(filter(transform({users}, u -> {user}), x -> x IS NOT NULL), 0) END"""


def connection_rows(good: DataFrame) -> DataFrame:
    """Node snapshots, not yet enriched: one row per (user, address) pair."""
    return (
        good.selectExpr(
            f"{_moment(_field('ts'))} AS ts",
            f"{_unsigned(_field('nodeId'))} AS node_id",
            "explode(parsed.users) AS u",
        )
        .selectExpr("ts", "node_id", f"{_unsigned('u.userId')} AS user_id", "explode(u.ips) AS i")
        .selectExpr(
            "ts", "node_id", "user_id", "coalesce(i.ip, '') AS ip", f"{_moment('i.lastSeen')} AS last_seen"
        )
    )


# SQL per stream over ``fields`` and what was parsed of them: why a message is
# rejected (NULL when valid), and how many fact rows a valid message yields.
REASONS = {
    USAGE_STREAM: _reason("nodeId", "ts", _missing("records"), _records_problem(_field("records"))),
    REQUEST_STREAM: _reason("userId", "requestAt"),
    CONNECTION_STREAM: _reason("nodeId", "ts", _missing("users"), _users_problem("parsed.users")),
}
ROWS_PER_MESSAGE = {
    USAGE_STREAM: f"size({_pairs(_field('records'))})",
    REQUEST_STREAM: "1",
    CONNECTION_STREAM: "aggregate(parsed.users, 0, (n, u) -> n + size(u.ips))",
}


def judged(entries: DataFrame) -> DataFrame:
    """Entries with ``parsed``, ``reason`` and ``rows`` (what a valid message yields).

    The generator keeps parsing apart: what filters or reads the parsed column
    does not parse again. Entries of no known stream and unreadable ones are
    rejects too.
    """

    def per_stream(sql: dict[str, str], other: str) -> str:
        return "CASE stream " + " ".join(f"WHEN '{s}' THEN {x}" for s, x in sql.items()) + f" ELSE {other} END"

    raw = "raw" if "raw" in entries.columns else "CAST(NULL AS STRING) AS raw"
    users = f"CASE WHEN stream = '{CONNECTION_STREAM}' AND {_field('users')} <> '' THEN {_users(_field('users'))} END"
    known = "IF(raw IS NULL, 'unknown_stream', 'unreadable_entry')"
    reason = f"IF(raw IS NOT NULL, 'unreadable_entry', {per_stream(REASONS, known)})"
    parsed = entries.selectExpr("entry_id", "stream", "fields", raw).selectExpr(
        "*", f"explode(array(named_struct('users', {users}))) AS parsed"
    )
    return parsed.selectExpr("*", f"{reason} AS reason").selectExpr(
        "*", f"IF(reason IS NULL, {per_stream(ROWS_PER_MESSAGE, '0')}, 0) AS rows"
    )


def rejects(marked: DataFrame) -> DataFrame:
    return marked.filter("reason IS NOT NULL").select(*schemas.QUARANTINE.names)


@dataclass(frozen=True)
class StreamSpec:
    """One export stream: where its rows go and how a message becomes rows.

    ``messages`` turns valid judged entries into rows; ``enrich`` gets these
    plus the network tables and returns rows in ``schema``.
    """

    stream: str
    table: str
    schema: T.StructType
    messages: Callable[[DataFrame], DataFrame]
    enrich: Callable[..., DataFrame]

    def stored_rows(self, marked: DataFrame, city_nets=None, asn_nets=None) -> DataFrame:
        """Fact rows of the stream's valid messages among judged entries."""
        good = marked.filter((F.col("stream") == self.stream) & F.col("reason").isNull())
        out = self.enrich(self.messages(good), city_nets, asn_nets).select(*self.schema.names)
        if out.schema.simpleString() != self.schema.simpleString():
            raise TypeError(
                f"{self.table}: rows are {out.schema.simpleString()}, "
                f"declared {self.schema.simpleString()}"
            )
        return out

    def decode(self, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Decoded rows, not enriched, and rejects of the stream's entries."""
        marked = judged(entries.filter(F.col("stream") == self.stream))
        return self.messages(marked.filter("reason IS NULL")), rejects(marked)

    def rows(self, entries: DataFrame, city_nets=None, asn_nets=None) -> tuple[DataFrame, DataFrame]:
        marked = judged(entries.filter(F.col("stream") == self.stream))
        return self.stored_rows(marked, city_nets, asn_nets), rejects(marked)


def _registry() -> dict[str, StreamSpec]:
    from accesslens.operators.enrich import enrich_connections, enrich_requests

    return {
        USAGE_STREAM: StreamSpec(
            USAGE_STREAM, "user_usage", schemas.USER_USAGE, usage_rows,
            lambda rows, city_nets, asn_nets: rows,
        ),
        REQUEST_STREAM: StreamSpec(
            REQUEST_STREAM, "sub_requests", schemas.SUB_REQUESTS, request_rows, enrich_requests,
        ),
        CONNECTION_STREAM: StreamSpec(
            CONNECTION_STREAM, "node_connections", schemas.NODE_CONNECTIONS, connection_rows, enrich_connections,
        ),
    }


STREAMS: dict[str, StreamSpec] = _registry()


def decode_user_usage(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    return STREAMS[USAGE_STREAM].decode(entries)


def decode_sub_requests(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    return STREAMS[REQUEST_STREAM].decode(entries)


def decode_node_connections(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    return STREAMS[CONNECTION_STREAM].decode(entries)
