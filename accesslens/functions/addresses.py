"""IP address expressions built only from Spark SQL functions.

Every function takes SQL text naming the value (a column name will do) and
returns a Column. ``address`` parses IPv4, IPv6 and IPv4-mapped text once into
a small struct of numbers; everything else (prefix, routability, masks) is
arithmetic on it. The IPv6 branch uses lambdas but sits behind a ``CASE``, so
rows holding IPv4 never evaluate it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the Unicode standard calls white space, as SQL escapes.
WHITESPACE = (
    r" \t\n\u000b\u000c\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    r"\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"r'^{_OCTET}(?:\.{_OCTET}){{3}}$'"
_GROUPS = "[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*"
_V6 = f"r'^(?:{_GROUPS})?(?:::(?:{_GROUPS})?)?$'"
_ZONED = "r'^[^%]+%(?s:.+)$'"

_INVALID = "named_struct('family', 0, 'hi', 0L, 'lo', 0L)"


def trimmed(text: str) -> str:
    """SQL for ``text`` without leading and trailing Unicode white space."""
    return f"btrim({text}, '{WHITESPACE}')"


def _bind(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _v4_number(text: str) -> str:
    octets = [f"CAST(split({text}, r'\\.', 4)[{i}] AS BIGINT)" for i in range(4)]
    return f"({octets[0]} * 16777216 + {octets[1]} * 65536 + {octets[2]} * 256 + {octets[3]})"


def _v6(text: str) -> str:
    # A dotted tail (::ffff:1.2.3.4) becomes two hexadecimal groups; a tail
    # that is not an IPv4 address makes the text invalid.
    tail = "substring_index(body, ':', -1)"
    head = f"substring(body, 1, length(body) - length({tail}))"
    number = f"CASE WHEN {tail} RLIKE {_V4} THEN {_v4_number(tail)} END"
    plain = f"""CASE WHEN NOT contains(body, '.') THEN body ELSE {_bind(number, 'n', f'''
        coalesce(concat({head}, hex(shiftright(n, 16)), ':', hex(n & 65535)), '!')''')} END"""

    def half(i: int) -> str:
        part = f"split_part(g, '::', {i})"
        return f"CASE WHEN {part} = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split({part}, ':') END"

    halves = f"""named_struct('ok', g RLIKE {_V6}, 'short', contains(g, '::'),
        'head', {half(1)}, 'rest', {half(2)})"""
    count = "(size(h.head) + size(h.rest))"
    digits = f"""CASE WHEN h.ok AND CASE WHEN h.short THEN {count} <= 7 ELSE {count} = 8 END THEN
        array_join(transform(
            concat(h.head, array_repeat('0', 8 - {count}), h.rest), x -> lpad(x, 4, '0')), '') END"""
    hi = "CAST(conv(substring(d, 1, 16), 16, -10) AS BIGINT)"
    lo = "CAST(conv(substring(d, 17, 16), 16, -10) AS BIGINT)"
    result = f"""CASE WHEN d IS NULL THEN {_INVALID}
        WHEN {hi} = 0 AND shiftrightunsigned({lo}, 32) = 65535
            THEN named_struct('family', 4, 'hi', {lo} & 4294967295L, 'lo', 0L)
        ELSE named_struct('family', 6, 'hi', {hi}, 'lo', {lo}) END"""
    body = f"CASE WHEN {text} RLIKE {_ZONED} THEN substring_index({text}, '%', 1) ELSE {text} END"
    return _bind(body, "body", _bind(plain, "g", _bind(halves, "h", _bind(digits, "d", result))))


def _address_sql(value: str) -> str:
    text = trimmed(value)
    return f"""CASE WHEN {text} RLIKE {_V4}
            THEN named_struct('family', 4, 'hi', {_v4_number(text)}, 'lo', 0L)
        WHEN contains({text}, ':') THEN {_v6(text)}
        ELSE {_INVALID} END"""


def address(value: str) -> Column:
    """Parse address text into ``struct<family INT, hi BIGINT, lo BIGINT>``.

    ``family`` is 4, 6 or 0 (not an address). IPv4 keeps its 32-bit value in
    ``hi``; IPv6 keeps the upper and lower 64 bits. IPv4-mapped IPv6 becomes
    IPv4.
    """
    return F.expr(_address_sql(value))


def ip_family(value: str) -> Column:
    """4, 6, or 0 when the text is not an address."""
    return address(value)["family"]


def _prefix_sql(addr: str) -> str:
    # After masking, the zero tail of an IPv6 prefix is always its longest zero
    # run, so dropping trailing zero groups gives the canonical form.
    hi = f"{addr}.hi"
    g = [f"lower(hex(shiftrightunsigned({hi}, {shift}) & 65535L))" for shift in (48, 32, 16)]
    return f"""CASE {addr}.family
        WHEN 4 THEN concat(shiftright({hi}, 24), '.', shiftright({hi}, 16) & 255L, '.', shiftright({hi}, 8) & 255L, '.0/24')
        WHEN 6 THEN concat(CASE
            WHEN shiftrightunsigned({hi}, 16) & 65535L <> 0 THEN concat({g[0]}, ':', {g[1]}, ':', {g[2]})
            WHEN shiftrightunsigned({hi}, 32) & 65535L <> 0 THEN concat({g[0]}, ':', {g[1]})
            WHEN shiftrightunsigned({hi}, 48) <> 0 THEN {g[0]}
            ELSE '' END, '::/48')
        ELSE '' END"""


def prefix_of(addr: str) -> Column:
    """Canonical /24 (IPv4) or /48 (IPv6) text of a parsed address, else ``''``."""
    return F.expr(_prefix_sql(addr))


def ip_prefix(value: str) -> Column:
    """The block one subscriber occupies: /24 for IPv4, /48 for IPv6."""
    return F.expr(_bind(_address_sql(value), "a", _prefix_sql("a")))


def _routable_sql(addr: str) -> str:
    hi, lo = f"{addr}.hi", f"{addr}.lo"
    # 10/8, 127/8, 172.16/12, 192.168/16, 169.254/16; ::1, fc00::/7, fe80::/10.
    return f"""CASE {addr}.family
        WHEN 4 THEN NOT (shiftright({hi}, 24) IN (10, 127) OR shiftright({hi}, 20) = {172 * 16 + 1}
            OR shiftright({hi}, 16) IN ({192 * 256 + 168}, {169 * 256 + 254}))
        WHEN 6 THEN NOT (({hi} = 0 AND {lo} = 1) OR shiftrightunsigned({hi}, 57) = {0xFC00 >> 9}
            OR shiftrightunsigned({hi}, 54) = {0xFE80 >> 6})
        ELSE false END"""


def routable(addr: str) -> Column:
    """True for a parsed address that is not loopback, private or link-local."""
    return F.expr(_routable_sql(addr))


def ip_is_routable(value: str) -> Column:
    """True for text holding a routable address."""
    return F.expr(_bind(_address_sql(value), "a", _routable_sql("a")))


def masked(addr: str, length: str) -> Column:
    """``addr`` with all but its first ``length`` bits cleared (hi/lo struct)."""

    def high_bits(n: str) -> str:
        return f"CASE WHEN {n} <= 0 THEN 0L WHEN {n} >= 64 THEN -1L ELSE shiftleft(-1L, 64 - ({n})) END"

    # An IPv4 value fills the low 32 bits of ``hi``.
    return F.expr(
        f"""named_struct(
        'hi', {addr}.hi & CASE WHEN {addr}.family = 4 THEN {high_bits(f'({length} + 32)')} ELSE {high_bits(length)} END,
        'lo', {addr}.lo & CASE WHEN {addr}.family = 4 THEN 0L ELSE {high_bits(f'({length} - 64)')} END)"""
    )
