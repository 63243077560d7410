"""Top-k selections and the exact quantile, without single-task sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGIT_BITS = 21
_LEVELS = 3


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order; every task keeps at most ``n``."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Spark cuts every group to ``n`` rows per task before the shuffle, so a
    group holding most of the rows never reaches one task as a whole.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def quantile_exact(df: DataFrame, column: str, level: float, name: str) -> DataFrame:
    """One row with element ``floor(level * n)`` (0-based) of the sorted values.

    ``column`` holds non-negative BIGINTs. The value is found digit by digit:
    each level counts the rows per 21-bit digit among those that match the
    digits found so far, and a running sum over at most 2^21 counters picks
    the next digit. No task ever sorts the values. Empty input gives 0.
    """
    values = df.select(F.col(column).cast("bigint").alias("_v"))
    state = None
    for depth in range(_LEVELS):
        shift = _DIGIT_BITS * (_LEVELS - 1 - depth)
        digit = F.expr(f"shiftrightunsigned(_v, {shift}) & {(1 << _DIGIT_BITS) - 1}L").alias("_digit")
        if state is None:
            counters = values.groupBy(F.lit(0).cast("bigint").alias("_prefix"), digit).agg(
                F.count(F.lit(1)).alias("_n")
            )
            rank = F.floor(F.lit(float(level)) * F.sum("_n").over(Window.partitionBy("_prefix"))).cast("bigint")
        else:
            # One row on the broadcast side; the equality keeps it an ordinary join.
            same = F.expr(f"shiftrightunsigned(_v, {shift + _DIGIT_BITS}) = _prefix")
            counters = (
                values.join(F.broadcast(state), same)
                .groupBy("_prefix", digit)
                .agg(F.count(F.lit(1)).alias("_n"), F.max("_rank").alias("_rank"))
            )
            rank = F.col("_rank")
        running = F.sum("_n").over(
            Window.partitionBy("_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
        )
        hit = F.expr("min(CASE WHEN _through > _rank THEN struct(_digit, _through - _n AS _before, _prefix, _rank) END)")
        state = (
            counters.select("_prefix", "_digit", "_n", rank.alias("_rank"), running.alias("_through"))
            .agg(hit.alias("_hit"))
            .selectExpr(
                "_hit._rank - _hit._before AS _rank",
                f"shiftleft(_hit._prefix, {_DIGIT_BITS}) + _hit._digit AS _prefix",
            )
        )
    return state.select(F.coalesce("_prefix", F.lit(0).cast("bigint")).alias(name))
