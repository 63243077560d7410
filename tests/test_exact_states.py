"""Bit states: numbers that never change, any size exact, batches in any order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from accesslens import schemas
from accesslens.operators import exact_states as exact
from accesslens.operators import rollups
from accesslens.plans.abuse import account_measures, exact_rolled_abuse
from accesslens.sources.exact import read_numbers, read_states, store_exact_batch

AT = dt.datetime(2024, 1, 1, 10, 3)


def connections(spark, first, last, user=1):
    """Each address in two buckets."""
    rows = spark.range(first, last).select(
        F.explode(F.array(*[F.lit(AT + dt.timedelta(minutes=m)).cast("timestamp_ntz") for m in (0, 7)])).alias("ts"),
        F.lit(user).cast("long").alias("user_id"), F.concat(F.lit("a"), "id").alias("ip"),
        F.concat(F.lit("p"), F.expr("id div 4")).alias("ip_prefix"),
        (F.col("id") % 3).alias("node_id"), (F.col("id") % 2).cast("int").alias("is_hosting"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), F.col("id") % 5)).otherwise("").alias("country"),
        (F.col("id") % 7).alias("asn"),
    )
    return schemas.conform(rows, schemas.NODE_CONNECTIONS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], schemas.SUB_REQUESTS)


def accounts(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id long")


def test_200000_values_are_exact(spark, none, tmp_path):
    facts, root = connections(spark, 0, 200_000), str(tmp_path)
    conn, sub = rollups.user_conn_5m(facts), rollups.sub_req_5m(none)
    large = exact.large_accounts(conn, sub)
    assert [r.user_id for r in large.collect()] == [1]
    # Overlapping batches: 120,000 addresses, then 150,000 of which 70,000 are known.
    store_exact_batch(spark, root, 0, connections(spark, 0, 120_000), none, large)
    before = {tuple(r[:4]): r.number for r in read_numbers(spark, root).filter("kind = 'prefixes'").collect()}
    store_exact_batch(spark, root, 1, connections(spark, 50_000, 200_000), none, large)
    after = {tuple(r[:4]): r.number for r in read_numbers(spark, root).filter("kind = 'prefixes'").collect()}
    assert before.items() <= after.items()
    assert sorted(after.values()) == list(range(1, 50_001))
    usage = rollups.usage_5m(spark.createDataFrame([], schemas.USER_USAGE))
    users = spark.createDataFrame([], schemas.DIM_USERS)
    row = exact_rolled_abuse(usage, conn, sub, read_states(spark, root), users, AT - dt.timedelta(days=1), AT).first()
    assert (row.ips, row.prefixes, row.asns, row.countries, row.nodes, row.hosting_ips) == (200_000, 50_000, 7, 4, 3, 100_000)
    # What the sketches alone say is an estimate here.
    assert account_measures(usage, conn, sub, AT - dt.timedelta(days=1), AT).first().ips != 200_000


def test_a_batch_written_twice_changes_nothing(spark, none, tmp_path):
    root, large = str(tmp_path), accounts(spark, 1)
    for first in (0, 500):
        store_exact_batch(spark, root, first, connections(spark, first, first + 1000), none, large)

    def stored():
        return sorted(map(tuple, read_numbers(spark, root).collect())), sorted(map(tuple, read_states(spark, root).collect()))

    before = stored()
    for first in (500, 0):
        store_exact_batch(spark, root, first, connections(spark, first, first + 1000), none, large)
    assert stored() == before
    counts = exact.bit_counts(read_states(spark, root)).first()
    assert (counts.user_id, counts.ips, counts.hosting_ips, counts.sub_ips) == (1, 1500, 750, 0)


def test_numbers_left_by_a_broken_write_are_not_given_again(spark, none, tmp_path):
    root, large, facts = str(tmp_path), accounts(spark, 1), connections(spark, 0, 300)
    numbers = exact.new_numbers(exact.connection_values(facts), read_numbers(spark, root))
    numbers.filter("number % 3 = 0").write.parquet(f"{root}/value_numbers/batch_id=0")
    store_exact_batch(spark, root, 0, facts, none, large)
    ips = read_numbers(spark, root).filter("kind = 'ips'")
    assert ips.count() == ips.select("number").distinct().count() == ips.select("h1", "h2").distinct().count() == 300
    assert exact.bit_counts(read_states(spark, root)).first().ips == 300


def test_only_large_accounts_and_the_range_count(spark, none, tmp_path):
    root, facts = str(tmp_path), connections(spark, 0, 40).unionByName(connections(spark, 0, 9, user=2))
    later = facts.withColumn("ts", F.expr("ts + INTERVAL 40 DAYS")).withColumn("ip", F.concat("ip", F.lit("x")))
    conn, sub = rollups.user_conn_5m(facts.unionByName(later)), rollups.sub_req_5m(none)
    large = exact.large_accounts(conn, sub, limit=30)
    store_exact_batch(spark, root, "history", facts.unionByName(later), none, large)
    states = read_states(spark, root)
    assert [r.user_id for r in states.select("user_id").distinct().collect()] == [1]
    assert sorted(r.month for r in states.select("month").distinct().collect()) == [202401, 202402]
    usage = rollups.usage_5m(spark.createDataFrame([], schemas.USER_USAGE))
    users = spark.createDataFrame([], schemas.DIM_USERS)
    got = exact_rolled_abuse(usage, conn, sub, states, users, AT - dt.timedelta(days=1), AT + dt.timedelta(days=1))
    assert {r.user_id: r.ips for r in got.collect()} == {1: 40, 2: 9}


def test_empty_batches_and_null_values(spark, none, tmp_path):
    root = str(tmp_path)
    store_exact_batch(spark, root, 0, spark.createDataFrame([], schemas.NODE_CONNECTIONS), none, accounts(spark, 1))
    assert read_states(spark, root).count() == read_numbers(spark, root).count() == 0
    nulls = connections(spark, 0, 5).withColumn("ip", F.lit(None).cast("string"))
    store_exact_batch(spark, root, 1, nulls, none, accounts(spark, 1))
    counts = exact.bit_counts(read_states(spark, root)).first()
    assert (counts.ips, counts.hosting_ips, counts.prefixes) == (0, 0, 2)
