"""Catalogue queries against their SQL oracles on the smallest data.

A cross-section runs here; ``check_oracle.py`` runs all of them.
"""

import duckdb
import pytest

import __spark_entry__ as entry
from accesslens import catalogue, oracle
from check_oracle import TABLES, compare

CHECKED = (
    "decode_node_connections", "quarantine_counts", "geo_prefix_join", "ua_classify", "dim_latest", "v_usage",
    "user_abuse", "node_filter", "talker_bands", "r_p95_user_traffic", "r_fetch_offenders", "stream_usage_5m",
    "backfill_live", "compact_live", "restart_new_checkpoint", "retention_drop", "uint64_values", "poison_message",
    "unreadable_entries", "resume_from_now", "stream_dedup_two_batches", "stream_ingest", "stream_quality",
    "geo_v6", "geo_overlap", "geo_two_tables", "sql_user_abuse", "exact_abuse", "edge_top_talkers", "cut_fetch_offenders",
    "read_networks_accounts", "stream_late_corrections", "dim_refresh_changes", "stream_byte_batches", "stream_pending", "replay_after_compact", "dedup_many_days", "backfill_changed", "clustered_account",
)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf).toPandas()
    assert compare(got, duck.execute(entry.oracle_sql()[name]).df()) == ""


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    assert "score" in entry.entry(spark).columns
