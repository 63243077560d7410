"""Small value rules shared by views and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Response types that refuse to serve the client.
REFUSALS = ("BLOCK", "STATUS_CODE_404", "STATUS_CODE_451", "SOCKET_DROP")


def round_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled double."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields NULL instead of failing on a zero divisor."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that is neither NULL nor empty, else ``''``."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def unsigned_text(key: str) -> str:
    """SQL text of a 64-bit id. Ids are unsigned; from 2^63 on their BIGINT is negative."""
    return f"IF({key} < 0, CAST(CAST({key} AS DECIMAL(20,0)) + 18446744073709551616 AS STRING), CAST({key} AS STRING))"


def display_name(name: str, kind: str, key: str) -> Column:
    """Column ``name``, or ``<kind>-<key>`` when it is missing or empty."""
    return F.expr(f"coalesce(nullif({name}, ''), concat('{kind}-', {unsigned_text(key)}))")


def total(column: str) -> Column:
    """Aggregate: exact sum of byte counts; no sum of 64-bit values overflows it."""
    return F.sum(F.col(column).cast("decimal(38,0)"))


def as_bigint(value: Column) -> Column:
    """A sum as reports show it: BIGINT, larger values as the largest BIGINT."""
    most = F.lit(2**63 - 1)
    return F.when(value > most, most).otherwise(value.cast("bigint"))


def total_bigint(column: str) -> Column:
    return as_bigint(total(column))


def is_blocked(response_type: Column) -> Column:
    """1 when the response type is a refusal, else 0."""
    return response_type.isin(*REFUSALS).cast("int")


def bucket(ts: Column, seconds: int = 300) -> Column:
    """Start of the tumbling interval that holds ``ts``."""
    return F.window(ts, f"{int(seconds)} seconds")["start"]


def in_range(df: DataFrame, column: str, t_from, t_to) -> DataFrame:
    """Closed time-range filter, with the matching partition predicate beside it.

    Tables carry a ``month`` (yyyyMM) or ``day`` partition column; naming it in
    the filter is what prunes directories, the timestamp bounds do the rest.
    """
    lo, hi = _moment(t_from), _moment(t_to)
    tests = [f"{column} BETWEEN TIMESTAMP_NTZ '{lo}' AND TIMESTAMP_NTZ '{hi}'"]
    if "month" in df.columns:
        tests.append(f"month BETWEEN {lo:%Y%m} AND {hi:%Y%m}")
    if "day" in df.columns:
        tests.append(f"day BETWEEN DATE '{lo:%Y-%m-%d}' AND DATE '{hi:%Y-%m-%d}'")
    return df.filter(" AND ".join(tests))


def moment(value) -> Column:
    """A constant TIMESTAMP_NTZ, independent of any time zone setting."""
    return F.expr(f"TIMESTAMP_NTZ '{_moment(value)}'")


def _moment(value) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
