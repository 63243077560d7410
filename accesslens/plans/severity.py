"""Severity bands of report measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Steps = Sequence[tuple[float, str]]

# Per report and measure, the lowest value of each band. Values
# below the first step fall into the base band.
TABLE_BASE, STAT_BASE = "text", "green"
BANDS: dict[str, dict[str, Steps]] = {
    "abuse_score": {
        "score": [(15, "yellow"), (30, "orange"), (60, "red")],
        "countries": [(2, "yellow"), (3, "red")],
        "networks": [(4, "yellow"), (8, "orange"), (15, "red")],
        "hosting_ips": [(1, "orange"), (3, "red")],
    },
    "shared_addresses": {"accounts": [(2, "yellow"), (3, "orange"), (5, "red")]},
    "top_talkers": {
        "peak_mbps": [(50, "yellow"), (100, "orange"), (200, "red")],
        "pct_of_total": [(5, "yellow"), (15, "red")],
    },
    "top5_per_node": {"pct_of_node": [(20, "yellow"), (40, "orange"), (60, "red")]},
    "fetch_offenders": {
        "requests": [(200, "yellow"), (500, "orange"), (1000, "red")],
        "networks": [(4, "yellow"), (10, "red")],
        "scripted": [(1, "orange"), (50, "red")],
        "countries": [(2, "yellow"), (3, "red")],
    },
    "top_networks": {"hosting": [(1, "red")]},
}
# The score column starts at green, as the single-value panels do.
STAT_LIKE = {("abuse_score", "score")}
STAT_BANDS: dict[str, Steps] = {
    "flagged_accounts": [(1, "yellow"), (10, "red")],
    "multi_country": [(1, "yellow"), (20, "red")],
    "hosting_accounts": [(1, "yellow"), (10, "red")],
    "over_device_limit": [(1, "yellow"), (10, "red")],
    "shared_address_count": [(1, "yellow"), (25, "red")],
    "scripted_fetches": [(1, "yellow"), (100, "red")],
    "heaviest_share": [(15, "yellow"), (30, "red")],
    "scripted_share": [(5, "yellow"), (20, "red")],
    "hosting_requests": [(1, "yellow"), (100, "red")],
    "busiest_account": [(200, "yellow"), (1000, "red")],
}


def band(value: Column, steps: Steps, base: str) -> Column:
    """Label of the highest step that ``value`` reaches."""
    label = None
    for least, name in sorted(steps, reverse=True):
        hit = value >= F.lit(least)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(base)


def score_bands(df: DataFrame, thresholds: Mapping[str, Steps], base: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``<measure>_severity`` for every measure in ``thresholds``."""
    base = base or {}
    return df.withColumns(
        {
            f"{m}_severity": band(F.col(m), steps, base.get(m, TABLE_BASE))
            for m, steps in thresholds.items()
        }
    )


def report_bands(df: DataFrame, report: str) -> DataFrame:
    """Severity columns of one of the table reports."""
    base = {m: STAT_BASE for r, m in STAT_LIKE if r == report}
    return score_bands(df, BANDS[report], base)


def stat_band(df: DataFrame, report: str, measure: str) -> DataFrame:
    """A single-value report as (report, value, severity)."""
    value = F.col(measure).cast("double")
    return df.select(
        F.lit(report).alias("report"),
        value.alias("value"),
        band(value, STAT_BANDS[report], STAT_BASE).alias("severity"),
    )
