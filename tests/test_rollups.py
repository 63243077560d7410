"""Rollups: merge invariance, empty values, zero sums, exact quantile, latest rows."""

import datetime as dt
import math
import random
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens import fixtures as fx
from accesslens import schemas, session
from accesslens.functions.values import bucket, first_filled, in_range, round_even
from accesslens.operators import rollups
from accesslens.operators.latest import latest
from accesslens.operators.select import quantile_exact, top_per_group
from accesslens.catalogue import REPORTS
from accesslens.plans.sql import register
from accesslens.plans.views import Tables
from accesslens.sources import tables as store
from accesslens.sources.dimensions import (
    append_snapshot, compact_dimension, compact_snapshots, read_dimension, refresh_dimension,
)

AT = dt.datetime(2024, 1, 1, 10, 3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_any_split_merges_to_the_same(spark, sf):
    t, batches = fx.DerivedTables(spark, sf), 3
    part = F.pmod(F.hash("ts", "user_id"), F.lit(batches))

    def merged(facts, rollup, merge, states):
        partials = [rollup(facts.filter(part == i)) for i in range(batches)]
        return rows(rollups.counts(merge(reduce(DataFrame.unionByName, partials)), states))

    usage = fx.usage_facts(fx.events(spark, sf))
    assert merged(usage, rollups.usage_5m, rollups.merge_usage, ()) == rows(
        rollups.merge_usage(rollups.usage_5m(usage))
    )
    conn, sub = t.node_connections.cache(), t.sub_requests.cache()
    assert merged(conn, rollups.user_conn_5m, rollups.merge_conn, rollups.CONN_STATES) == rows(
        rollups.counts(rollups.user_conn_5m(conn), rollups.CONN_STATES)
    )
    whole = rollups.counts(rollups.merge_sub(rollups.sub_req_5m(sub)), rollups.SUB_STATES)
    assert merged(sub, rollups.sub_req_5m, rollups.merge_sub, rollups.SUB_STATES) == rows(whole)


def test_unknown_counts_as_one_value_but_not_as_a_country(spark):
    data = [
        (AT, 1, 5, ip, prefix, AT, country, "", asn, "", hosting)
        for ip, prefix, country, asn, hosting in [("", "", "", 0, 0), ("a", "p", "", 0, 1), ("b", "p", "DE", 7, 0)]
    ]
    facts = spark.createDataFrame(data, schemas.NODE_CONNECTIONS)
    row = rollups.counts(rollups.user_conn_5m(facts), rollups.CONN_STATES).first()
    assert (row.ips, row.prefixes, row.asns, row.countries, row.nodes, row.hosting_ips) == (3, 2, 2, 1, 1, 1)


def test_states_are_exact_to_fifty_thousand(spark):
    df = spark.range(50000).select(rollups.identity(F.concat(F.lit("x"), "id")).alias("h"), (F.col("id") % 3).alias("g"))
    parts = df.groupBy("g").agg(rollups.distinct_state(F.col("h")).alias("s"))
    assert parts.agg(rollups.merged_count(F.col("s"))).first()[0] == 50000


def test_zero_sums_vanish_only_when_all_partials_are_zero(spark):
    partials = spark.createDataFrame(
        [(AT, 1, 1, Decimal(0)), (AT, 1, 1, Decimal(0)), (AT, 1, 2, Decimal(0)), (AT, 1, 2, Decimal(5))], schemas.USAGE_5M
    )
    assert [tuple(r)[2:] for r in rollups.merge_usage(partials).collect()] == [(2, 5)]
    assert rows(rollups.merge_usage(partials, keep_zero=True).select("user_id", "bytes")) == [(1, 0), (2, 5)]


def test_buckets_and_closed_range(spark):
    times = ["10:00:00", "10:04:59.999", "10:05:00", "10:09:59"]
    df = spark.createDataFrame([(f"2024-01-01 {t}",) for t in times], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("ts")
    )
    got = [r[0].minute for r in df.select(bucket(F.col("ts"))).collect()]
    assert got == [0, 0, 5, 5]
    assert in_range(df, "ts", "2024-01-01 10:00:00", "2024-01-01 10:05:00").count() == 3


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = [0.25, 0.35, 2.5, 0.125, 1.005, -0.25, 187.45]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_even(F.col("v"), 1)).collect()]
    assert got == [round(v * 10) / 10 for v in values]


def test_first_filled(spark):
    df = spark.createDataFrame([("", "b"), (None, ""), ("a", "b"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(first_filled(F.col("a"), F.col("b"))).collect()] == ["b", "", "a", ""]


@pytest.mark.parametrize("level, n", [(0.0, 20), (0.5, 1), (0.95, 333), (0.99, 50)])
def test_quantile_is_an_element(spark, level, n):
    rng = random.Random(3)
    values = [rng.choice([0, 5, 2**20, 2**21, 2**42 + rng.getrandbits(40), rng.getrandbits(62)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "b bigint")
    got = quantile_exact(df, "b", level, "q").first().q
    assert got == sorted(values)[math.floor(level * n)]


def test_quantile_of_nothing_and_of_twenty(spark):
    assert quantile_exact(spark.createDataFrame([], "b bigint"), "b", 0.95, "q").first().q == 0
    assert quantile_exact(spark.range(20).toDF("b"), "b", 0.95, "q").first().q == 19


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS g", "id AS v")
    out = top_per_group(df, "g", [F.desc("v")], 3)
    assert rows(out) == rows(spark.createDataFrame([(0, 998), (0, 996), (0, 994), (1, 999), (1, 997), (1, 995)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 3, Partial" in plan and "row_number(), 3, Final" in plan


def test_latest_keeps_the_newest(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    data = [(1, "u", "old", "a", old), (1, "u", "new", "b", new), (2, "v", "only", "c", old), (1, "u", "tie", "b", new)]
    got = rows(latest(spark.createDataFrame(data, schemas.DIM_NODES), "node_id").select("node_id", "name"))
    assert got == [(1, "tie"), (2, "only")]


def test_table_round_trip_retention_and_compaction(spark, sf, tmp_path):
    root = str(tmp_path)
    facts = fx.usage_facts(fx.events(spark, sf))
    odd = F.col("user_id") % 2 == 1
    store.write_batch(facts.filter(odd), root, "user_usage", 0)
    store.write_batch(facts.filter(~odd), root, "user_usage", 1)
    store.write_batch(facts.filter(~odd), root, "user_usage", 1)
    stored = store.read_table(spark, root, "user_usage")
    assert rows(stored.drop("month")) == rows(facts)
    january = in_range(stored, "ts", "2023-12-01 00:00:00", "2023-12-31 00:00:00")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and january.count() == 0
    for i in range(2):
        store.write_batch(rollups.usage_5m(facts.filter(odd if i else ~odd)), root, "usage_5m", i)
    assert store.compact(spark, root, "usage_5m") == ["202401"]
    assert store.compact(spark, root, "usage_5m") == []
    compacted = store.read_table(spark, root, "usage_5m").drop("month")
    assert rows(compacted) == rows(rollups.merge_usage(rollups.usage_5m(facts)))
    assert store.compact(spark, root, "user_usage") == ["202401"]
    assert rows(store.read_table(spark, root, "user_usage").drop("month")) == rows(facts)
    for _ in range(2):
        store.apply_retention(spark, root, "user_usage", "2024-04-10 00:00:00")
    kept = store.read_table(spark, root, "user_usage").drop("month")
    assert rows(kept) == rows(facts.filter("ts >= TIMESTAMP_NTZ '2024-01-11 00:00:00'"))
    store.apply_retention(spark, root, "user_usage", "2024-08-01 00:00:00")
    assert store.batches(spark, root, "user_usage") == [] and store.read_table(spark, root, "user_usage").count() == 0


def test_backfill_keeps_what_raw_facts_no_longer_cover(spark, sf, tmp_path):
    root = str(tmp_path)
    facts = fx.usage_facts(fx.events(spark, sf))
    store.write_batch(rollups.usage_5m(facts), root, "usage_5m", 0)
    late = facts.filter("ts >= TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    store.write_batch(late, root, "user_usage", 0)
    for _ in range(2):
        store.backfill(spark, root, "user_usage")
        assert rows(store.read_table(spark, root, "usage_5m").drop("month")) == rows(rollups.usage_5m(facts))
    store.backfill(spark, root, "node_connections")  # no facts: nothing to do
    assert store.read_table(spark, root, "user_conn_5m").count() == 0


def test_a_swallowed_batch_that_is_written_again_changes_nothing(spark, sf, tmp_path):
    root, query = str(tmp_path), "0123456789abcdef" * 2
    facts = fx.usage_facts(fx.events(spark, sf))
    odd = F.col("user_id") % 2 == 1
    for ids in (("a", "b"), (f"{query}-6", f"{query}-7")):
        for batch, part in zip(ids, (facts.filter(odd), facts.filter(~odd))):
            store.write_batch(part, root, "user_usage", batch)
            store.write_batch(rollups.usage_5m(part), root, "usage_5m", batch)
    for table in ("user_usage", "usage_5m"):
        store.compact(spark, root, table)
    want = [store.read_table(spark, root, t).groupBy().agg(F.sum("bytes")).first()[0] for t in ("user_usage", "usage_5m")]
    for batch in ("b", f"{query}-5", f"{query}-7"):
        store.write_batch(facts.filter(~odd), root, "user_usage", batch)
        store.write_batch(rollups.usage_5m(facts.filter(~odd)), root, "usage_5m", batch)
    assert want == [store.read_table(spark, root, t).groupBy().agg(F.sum("bytes")).first()[0] for t in ("user_usage", "usage_5m")]
    later = facts.withColumn("ts", F.expr("ts + INTERVAL '40' DAY"))
    for batch in ("c", f"{query}-8", f"{query}-7"):  # new batches, and an old one's rows in a month that was not merged
        store.write_batch(facts.unionByName(later) if batch.endswith("7") else facts, root, "user_usage", batch)
    assert store.read_table(spark, root, "user_usage").count() == 5 * facts.count()
    assert set(store.read_ledger(spark, root, "user_usage").held) == {"202401"}


def test_only_months_whose_facts_changed_are_rebuilt(spark, sf, tmp_path):
    root = str(tmp_path)
    facts = fx.usage_facts(fx.events(spark, sf)).filter("ts < TIMESTAMP_NTZ '2024-01-28 00:00:00'")
    months = [facts.withColumn("ts", F.expr(f"ts + INTERVAL '{31 * i}' DAY")) for i in range(3)]
    for i, part in enumerate(months):
        store.write_batch(part, root, "user_usage", i)
        store.write_batch(part, root, "user_usage", f"more-{i}")
    every = ["202401", "202402", "202403"]
    assert store.backfill(spark, root, "user_usage") == every
    assert store.backfill(spark, root, "user_usage") == []
    before = store.batches(spark, root, "usage_5m")
    assert store.compact(spark, root, "user_usage", ["202401"]) == ["202401"]
    assert store.backfill(spark, root, "user_usage") == []  # the same rows in other files
    store.write_batch(months[1].limit(10), root, "user_usage", "more-1")
    assert store.built_from(spark, root, "user_usage") == ["202401", "202403"]
    assert store.backfill(spark, root, "user_usage") == ["202402"]
    after = store.batches(spark, root, "usage_5m")
    assert [b for b in after if b[0] != "202402"] == [b for b in before if b[0] != "202402"] and after != before
    stored = rollups.merge_usage(store.read_table(spark, root, "usage_5m").drop("month"), keep_zero=True)
    assert rows(stored) == rows(rollups.usage_5m(store.read_table(spark, root, "user_usage").drop("month")))
    assert store.backfill(spark, root, "user_usage", ["202403", "209901"]) == ["202403"]


def test_compaction_lets_the_scan_skip_other_accounts(spark, tmp_path):
    root = str(tmp_path)
    ids = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id % 40000)) AS ts,"
        " 1 + id % 2000 % 3 AS node_id, id % 2000 * 17 AS user_id, id AS bytes FROM range(60000)"
    )
    part = F.pmod(F.xxhash64("bytes"), F.lit(2))
    for i in range(2):
        store.write_batch(ids.filter(part == i), root, "user_usage", i)

    def read(user):
        found = store.read_table(spark, root, "user_usage").filter(F.col("user_id") == user)
        plan = found._jdf.queryExecution().executedPlan()
        found._jdf.queryExecution().toRdd().count()
        scan = plan.collectLeaves().head()
        return scan.metrics().apply("numOutputRows").value()

    assert read(17) == 60_000
    with session.setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        store.compact(spark, root, "user_usage")
    assert store.read_table(spark, root, "user_usage").filter("user_id = 17").count() == 30
    assert 0 < read(17) <= 20_000 and read(18) == 0  # 18 lies between the accounts, so bounds do not tell


def test_broken_off_replacements_are_undone_or_finished(spark, sf, tmp_path):
    root = str(tmp_path)
    usage = rollups.usage_5m(fx.usage_facts(fx.events(spark, sf)))
    store.write_batch(usage, root, "usage_5m", "a")
    want = rows(usage)

    def seen():
        return rows(store.read_table(spark, root, "usage_5m").drop("month"))

    def fail(old):
        store.write_batch(old, root, "usage_5m", next(iter(store._entries(spark, root, "usage_5m"))))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.replace(spark, root, "usage_5m", store.batches(spark, root, "usage_5m"), fail)
    assert seen() == want  # the half-written batch is there, but not seen
    store.recover(spark, root, "usage_5m")
    assert seen() == want and store.batches(spark, root, "usage_5m") == [("202401", "a")]
    new = store.replace(spark, root, "usage_5m", [("202401", "a")], lambda old: old, clean=False)
    assert seen() == want  # the old files are there, but not seen
    store.recover(spark, root, "usage_5m")
    assert seen() == want and store.batches(spark, root, "usage_5m") == [("202401", new)]


def test_filters_reach_the_scan(spark, sf, tmp_path):
    root = str(tmp_path)
    store.write_batch(fx.usage_facts(fx.events(spark, sf)), root, "user_usage", 0)
    store.backfill(spark, root, "user_usage")
    usage = store.read_table(spark, root, "usage_5m")
    plan = in_range(rollups.nonzero(usage), "ts5", fx.EDGE_FROM, fx.EDGE_TO).agg(F.sum("bytes"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(bytes,0)" in text and "GreaterThanOrEqual(ts5" in text
    assert "ReadSchema: struct<ts5:timestamp_ntz,bytes:decimal(38,0)>" in text


def test_type_filters_reach_the_scan_of_late_columns(spark, sf, tmp_path):
    root = str(tmp_path)
    requests = fx.sub_requests(spark, sf)
    store.write_batch(requests, root, "sub_requests", "new")
    old = requests.drop("srr_response_type", "srr_rule_name", "month")
    old.withColumn("month", F.lit(202401)).withColumn("batch_id", F.lit("old")).write.mode("append").partitionBy(
        "month", "batch_id"
    ).parquet(f"{root}/sub_requests")
    stored = store.read_table(spark, root, "sub_requests")
    assert stored.filter("srr_response_type IS NULL").count() == 0 and stored.count() == 2 * requests.count()
    t = Tables(sub_requests=stored)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for name in ("r_response_types", "r_refused_by_rule"):
        text = REPORTS[name](t, fx.T_FROM, fx.T_TO)._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in text.splitlines() if "PushedFilters" in line]
        assert any("srr_response_type" in line.split("PushedFilters")[1].split("ReadSchema")[0] for line in pushed), name
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_sql_views_and_function_are_pruned(spark, sf, tmp_path):
    root, t = str(tmp_path), fx.DerivedTables(spark, sf)
    names = ("usage_5m", "user_conn_5m", "sub_req_5m", "sub_requests", "node_connections")
    for name in names:
        store.write_batch(getattr(t, name), root, name, 0)
    stored = Tables(**{n: store.read_table(spark, root, n) for n in names}, dim_users=t.dim_users, dim_nodes=t.dim_nodes)
    register(spark, stored)
    from_, to = "TIMESTAMP_NTZ '2024-01-05 00:00:00'", "TIMESTAMP_NTZ '2024-01-05 23:00:00'"
    queries = [
        f"SELECT * FROM v_user_abuse({from_}, {to})",
        f"SELECT * FROM v_usage WHERE ts5 BETWEEN {from_} AND {to} AND month = 202401",
        f"SELECT * FROM v_connections WHERE ts BETWEEN {from_} AND {to} AND day = DATE '2024-01-05'",
        f"SELECT * FROM v_sub_requests WHERE ts BETWEEN {from_} AND {to} AND month = 202401",
    ]
    for query in queries:
        plan = spark.sql(query)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "FileScan" in x and str(tmp_path) in x]
        assert scans and all("PartitionFilters: []" not in x for x in scans), query


def test_dimension_snapshots_compact_to_the_newest_rows(spark, tmp_path):
    path = str(tmp_path / "dim")
    for day, name in ((1, "old"), (2, "new")):
        rows_ = [(i, f"u{i}", f"{name}{i}", "", dt.datetime(2024, 1, day)) for i in range(5)]
        append_snapshot(spark.createDataFrame(rows_, schemas.DIM_NODES), path)
    target = compact_snapshots(spark, path, "node_id", schemas.DIM_NODES)
    assert {r.name for r in spark.read.parquet(target).collect()} == {f"new{i}" for i in range(5)}
    assert spark.read.parquet(target).count() == 5


def test_a_refresh_stores_only_what_changed(spark, tmp_path):
    root = str(tmp_path)

    def nodes(day, **names):
        given = [(i, f"u{i}", names.get(f"n{i}", f"node{i}"), "", dt.datetime(2024, 1, day)) for i in range(5)]
        return spark.createDataFrame(given, schemas.DIM_NODES)

    def shown():
        return sorted((r.node_id, r.name, r.updated_at.day) for r in latest(read_dimension(spark, root, "dim_nodes"), "node_id").collect())

    def folders():
        return sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "dim_nodes").glob("*/refresh=*"))

    assert read_dimension(spark, root, "dim_nodes").count() == 0
    assert refresh_dimension(nodes(1), root, "dim_nodes") == 5
    before = folders()
    assert refresh_dimension(nodes(2), root, "dim_nodes") == 0 and folders() == before
    assert refresh_dimension(nodes(3, n1="other"), root, "dim_nodes") == 1
    assert refresh_dimension(nodes(4), root, "dim_nodes") == 1  # back to the first name
    assert refresh_dimension(nodes(5).filter("node_id = 2").unionByName(nodes(6).filter("node_id = 2")), root, "dim_nodes") == 0
    want = [(i, f"node{i}", 4 if i == 1 else 1) for i in range(5)]
    assert shown() == want and read_dimension(spark, root, "dim_nodes").count() == 7
    held = read_dimension(spark, root, "dim_nodes")
    compact_dimension(spark, root, "dim_nodes")
    assert shown() == want and read_dimension(spark, root, "dim_nodes").count() == 5
    assert held.count() == 7  # a reader of the generation before
    compact_dimension(spark, root, "dim_nodes")
    assert shown() == want and len({f.split("/")[1] for f in folders()}) == 2


def test_rows_from_an_older_schema_read_as_empty(spark, sf):
    new = fx.sub_requests(spark, sf)
    old = new.drop("srr_response_type", "srr_rule_name")
    both = schemas.union_versions(schemas.SUB_REQUESTS, old, new)
    assert both.filter("srr_response_type IS NULL OR srr_rule_name IS NULL").count() == 0
    assert both.schema.simpleString() == schemas.SUB_REQUESTS.simpleString()
    assert both.filter("srr_response_type = ''").count() >= new.count()
