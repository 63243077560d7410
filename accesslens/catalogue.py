"""Every operator and report as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens import fixtures as fx
from accesslens import schemas, session
from accesslens.functions.addresses import ip_family, ip_is_routable, ip_prefix
from accesslens.functions.clients import ua_classify
from accesslens.functions.hosting import hosting_flag
from accesslens.functions.values import as_bigint, in_range, total, total_bigint, unsigned_text
from accesslens.operators import rollups
from accesslens.operators.decode import (
    REQUEST_STREAM, STREAMS, USAGE_STREAM, CONNECTION_STREAM, response_type, split_packed,
)
from accesslens.operators.enrich import (
    ASN_COLUMNS, CITY_COLUMNS, enrich_requests, geo_enrich, index_networks, lookup, parsed_addresses,
)
from accesslens.operators.exact_states import bit_counts, large_accounts
from accesslens.plans import abuse_reports, node_reports, request_reports
from accesslens.plans.abuse import active_universe, exact_abuse, exact_rolled_abuse, user_abuse
from accesslens.plans.severity import report_bands, stat_band
from accesslens.plans.sql import register
from accesslens.plans.views import (
    Tables, v_connections, v_nodes, v_sub_requests, v_usage, v_users, with_node_name, with_user,
)
from accesslens.sources import files
from accesslens.sources import tables as store
from accesslens.sources.dimensions import (
    compact_dimension, load_dim_nodes, load_dim_users, read_dimension, refresh_dimension,
)
from accesslens.sources.entries import dedup_entries, first_deliveries, read_entry_files
from accesslens.sources.exact import read_states, store_exact_batch
from accesslens.sources.networks import ASN_CIDR, CITY_BLOCKS, LOCATIONS, city_networks, read_networks
from accesslens.streaming.ingest import (
    read_quarantine, read_watermark_rollup, start_corrected_rollup, start_ingest, start_usage_rollup,
    start_watermark_rollup,
)
from accesslens.streaming.quality import (
    files_read, ingest_quality, landed, read_measures, read_pending, store_pending, table_sizes,
)

Query = Callable[[SparkSession, str], DataFrame]

NODE_LIST = ("edge-1", "edge-2", "node-3", "node-7")
_NOW = {"availableNow": True}
# Entries of a landing file, and compressed bytes of files that a batch takes: they bound what a batch shuffles and stages.
_FILE_ENTRIES = 250_000
_BATCH_BYTES = 512 << 20


def shown(df: DataFrame) -> DataFrame:
    """Exact byte counts as BIGINT, as reports show them."""
    return df.withColumn("bytes", as_bigint(F.col("bytes")))


# --- sources and sinks --------------------------------------------------------


def fact_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = session.scratch(spark, "facts")
    store.write_batch(fx.usage_facts(fx.events(spark, sf)), root, "user_usage", 0)
    return shown(store.read_table(spark, root, "user_usage"))


def retention_filter(spark: SparkSession, sf: str) -> DataFrame:
    return store.retain(fx.node_connections(spark, sf), "ts", 30, "2024-02-05 12:00:00")


def dim_refresh_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Four refreshes of the accounts: new, equal, with some renamed, and equal again after compaction. ``written``
    has the versions each of them stored."""
    root = session.scratch(spark, "dimension")
    users = fx.dim_users(spark, sf).withColumn("traffic_limit_bytes", F.col("traffic_limit_bytes").cast("decimal(20,0)"))
    later = users.withColumn("updated_at", F.expr("updated_at + INTERVAL '5' MINUTE"))
    renamed = later.withColumn("username", F.expr("IF(user_id % 10 = 0, concat('renamed-', user_id), username)"))
    written = [refresh_dimension(rows, root, "dim_users") for rows in (users, later, renamed)]
    compact_dimension(spark, root, "dim_users")
    written.append(refresh_dimension(renamed, root, "dim_users"))
    stored = v_users(read_dimension(spark, root, "dim_users"))
    return stored.withColumn("traffic_limit_bytes", as_bigint(F.col("traffic_limit_bytes"))).withColumn(
        "written", F.lit(" ".join(map(str, written)))
    )


def schema_evolution_union(spark: SparkSession, sf: str) -> DataFrame:
    new = fx.sub_requests(spark, sf)
    old = new.drop("srr_response_type", "srr_rule_name")
    return schemas.union_versions(schemas.SUB_REQUESTS, old, new)


def _thirds(facts: DataFrame, *columns: str) -> list[DataFrame]:
    part = F.pmod(F.xxhash64(*columns), F.lit(3))
    return [facts.filter(part == i) for i in range(3)]


def backfill_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup built from stored raw facts where there is none yet."""
    root = session.scratch(spark, "backfill")
    store.write_batch(fx.sub_requests(spark, sf), root, "sub_requests", 0)
    store.backfill(spark, root, "sub_requests")
    rollup = store.read_table(spark, root, "sub_req_5m").drop("month")
    return rollups.counts(rollup, rollups.SUB_STATES)


def backfill_live(spark: SparkSession, sf: str) -> DataFrame:
    """Facts and partials ingested in three batches, the rollup rebuilt twice in the same folder."""
    root = session.scratch(spark, "backfill-live")
    for i, part in enumerate(_thirds(fx.sub_requests(spark, sf), "ts", "user_id", "ip")):
        store.write_batch(part, root, "sub_requests", i)
        store.write_batch(rollups.sub_req_5m(part), root, "sub_req_5m", i)
    for _ in range(2):
        store.backfill(spark, root, "sub_requests")
    rollup = store.read_table(spark, root, "sub_req_5m").drop("month")
    return rollups.counts(rollup, rollups.SUB_STATES)


def compact_live(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of partials, merged twice in the same folder: one row per key is left."""
    root = session.scratch(spark, "compact-live")
    for i, part in enumerate(_thirds(fx.usage_facts(fx.events(spark, sf)), "ts", "user_id", "bytes")):
        store.write_batch(rollups.usage_5m(part), root, "usage_5m", i)
    for _ in range(2):
        store.compact(spark, root, "usage_5m")
    return shown(store.read_table(spark, root, "usage_5m").drop("month"))


def backfill_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of several months, the rollup built; then January gets a batch more: only January is rebuilt."""
    root = session.scratch(spark, "backfill-changed")
    facts = fx.usage_facts(fx.events(spark, sf))
    spread = facts.withColumn("ts", F.expr("ts + make_dt_interval(31 * int(user_id % 3))"))
    for i, part in enumerate(_thirds(spread, "ts", "user_id", "bytes")):
        store.write_batch(part, root, "user_usage", i)
    store.backfill(spark, root, "user_usage")
    store.write_batch(facts.filter("user_id % 3 = 0"), root, "user_usage", "more")
    rebuilt = store.backfill(spark, root, "user_usage") + store.backfill(spark, root, "user_usage")
    rollup = shown(store.read_table(spark, root, "usage_5m").drop("month"))
    return rollup.withColumn("rebuilt", F.lit(",".join(rebuilt)))


def clustered_account(spark: SparkSession, sf: str) -> DataFrame:
    """Three accounts' rows of a fact table that compaction has clustered."""
    root = session.scratch(spark, "clustered")
    for i, part in enumerate(_thirds(fx.usage_facts(fx.events(spark, sf)), "ts", "user_id", "bytes")):
        store.write_batch(part, root, "user_usage", i)
    store.compact(spark, root, "user_usage")
    return shown(store.read_table(spark, root, "user_usage").drop("month").filter(F.col("user_id").isin(1, 5, 77)))


def retention_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Expired days dropped, the edge day cut, in the same folder, twice."""
    root = session.scratch(spark, "retention")
    store.write_batch(fx.node_connections(spark, sf), root, "node_connections", 0)
    for _ in range(2):
        store.apply_retention(spark, root, "node_connections", "2024-02-05 12:00:00")
    return store.read_table(spark, root, "node_connections").drop("day")


def pruned_range(spark: SparkSession, sf: str) -> DataFrame:
    """Three days of a stored table; the range names the day partitions."""
    root = session.scratch(spark, "pruned")
    store.write_batch(fx.node_connections(spark, sf), root, "node_connections", 0)
    stored = store.read_table(spark, root, "node_connections")
    return in_range(stored, "ts", "2024-01-10 06:00:00", "2024-01-12 18:00:00").drop("day")


# --- decoding -----------------------------------------------------------------


def _decode(stream: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        nets = fx.geo_networks(spark, sf)
        rows, _ = STREAMS[stream].rows(fx.messages(fx.events(spark, sf)), nets, nets)
        return shown(rows) if "bytes" in rows.columns else rows

    return run


def response_type_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    return fx.request_messages(fx.events(spark, sf)).select(
        "entry_id",
        response_type("fields['ssrResponseType']", "fields['srrResponseType']").alias("srr_response_type"),
    )


def split_packed_records(spark: SparkSession, sf: str) -> DataFrame:
    return (
        fx.usage_messages(fx.events(spark, sf))
        .select("entry_id", F.explode(split_packed("fields['records']")).alias("r"))
        .select("entry_id", "r.user", "r.bytes")
    )


def quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    entries = fx.messages(fx.events(spark, sf))
    rejects = [spec.decode(entries)[1] for spec in STREAMS.values()]
    return reduce(DataFrame.unionByName, rejects).groupBy("stream", "reason").agg(
        F.count(F.lit(1)).alias("n")
    )


def uint64_values(spark: SparkSession, sf: str) -> DataFrame:
    """Ids and byte counts at the upper end of what is legal."""
    rows, _ = STREAMS[USAGE_STREAM].decode(fx.large_messages(fx.events(spark, sf)))
    return rows.selectExpr(
        "ts", f"{unsigned_text('node_id')} AS node_id", f"{unsigned_text('user_id')} AS user_id", "CAST(bytes AS STRING) AS bytes"
    )


def poison_message(spark: SparkSession, sf: str) -> DataFrame:
    """Byte counts whose sums leave 64 bits, through facts and rollup."""
    root = session.scratch(spark, "poison")
    rows, _ = STREAMS[USAGE_STREAM].decode(fx.large_messages(fx.events(spark, sf)))
    store.write_batch(rows, root, "user_usage", 0)
    store.backfill(spark, root, "user_usage")
    sums = store.read_table(spark, root, "usage_5m").groupBy("node_id").agg(total("bytes").alias("bytes"))
    return sums.selectExpr(f"{unsigned_text('node_id')} AS node_id", "CAST(bytes AS STRING) AS bytes")


# --- enrichment ---------------------------------------------------------------


def _address_query(name: str, function) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = fx.connection_rows(fx.events(spark, sf))
        return rows.select("ip", function("ip").alias(name))

    return run


_GEO_COLUMNS = ("ip", "ip_prefix", "country", "city", "asn", "as_org", "is_hosting")


def _geo_query(**options) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        nets = fx.geo_networks(spark, sf)
        rows = fx.connection_rows(fx.events(spark, sf))
        return geo_enrich(rows, "ip", nets, nets, **options).select(*_GEO_COLUMNS)

    return run


def _addresses(spark: SparkSession, sf: str) -> DataFrame:
    ips = fx.connection_rows(fx.events(spark, sf)).select("ip").distinct()
    return parsed_addresses(ips, "ip")


def _network_result(joined: DataFrame, found: dict) -> DataFrame:
    return joined.select(
        "ip", F.coalesce(found["asn"], F.lit(0).cast("bigint")).alias("asn"),
        F.coalesce(found["as_org"], F.lit("")).alias("as_org"),
    )


def geo_range_join(spark: SparkSession, sf: str) -> DataFrame:
    index = index_networks(fx.fine_networks(spark, sf), ("asn", "as_org"))
    return _network_result(*lookup(_addresses(spark, sf), index, small=False))


def geo_prefix_join(spark: SparkSession, sf: str) -> DataFrame:
    index = index_networks(fx.cidr_networks(spark, sf), ("asn", "as_org"))
    return _network_result(*lookup(_addresses(spark, sf), index, small=False))


def geo_v6(spark: SparkSession, sf: str) -> DataFrame:
    """Nested networks of both families, looked up on the facts."""
    nets = fx.cidr_networks(spark, sf)
    rows = fx.connection_rows(fx.events(spark, sf))
    return geo_enrich(rows, "ip", None, nets).select("ip", "asn", "as_org")


def geo_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated and overlapping ranges: the smallest counts and no fact row multiplies."""
    nets = fx.overlapping_networks(spark, sf)
    rows = fx.connection_rows(fx.events(spark, sf))
    return geo_enrich(rows, "ip", None, nets).select("ip", "asn", "as_org")


def custom_hosting(spark: SparkSession, sf: str) -> DataFrame:
    """Hosting by own words instead of the list."""
    nets = fx.geo_networks(spark, sf)
    rows = enrich_requests(fx.request_rows(fx.events(spark, sf)), nets, nets, keywords=["TELECOM", "sample"])
    return rows.select("ip", "as_org", "is_hosting")


def _published(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """City and ASN networks through CSV files in the published layout."""
    root = session.scratch(spark, "networks-csv")
    blocks, locations, asns = fx.published_networks(spark, sf)
    for name, df in (("blocks", blocks), ("locations", locations), ("asns", asns)):
        df.write.option("header", True).csv(f"{root}/{name}")
    found = [read_networks(spark, f"{root}/{name}", schema) for name, schema in (
        ("blocks", CITY_BLOCKS), ("locations", LOCATIONS), ("asns", ASN_CIDR),
    )]
    return city_networks(found[0], found[1]), found[2]


def read_networks_csv(spark: SparkSession, sf: str) -> DataFrame:
    return _published(spark, sf)[0]


def read_networks_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """City blocks of both families and their locations from CSV, one block per customer."""
    folder = session.scratch(spark, "networks-csv")
    network = "concat(30 + c_custkey div 62500 % 60, '.', c_custkey div 250 % 250, '.', c_custkey % 250, '.0/24')"
    blocks = fx.table(spark, sf, "customer").selectExpr(
        f"IF(c_custkey % 3 = 0, concat('2a02:', lower(hex(c_custkey % 65536)), ':', lower(hex(c_custkey div 65536)), '::/48'), {network}) AS network",
        "c_nationkey AS geoname_id", "(c_nationkey + 7) % 25 AS registered_country_geoname_id",
    )
    places = fx.table(spark, sf, "nation").selectExpr(
        "n_nationkey AS geoname_id", "IF(n_nationkey % 5 = 0, NULL, n_name) AS country_iso_code", "concat('City_', n_nationkey) AS city_name"
    )
    for name, rows in (("blocks", blocks), ("places", places)):
        rows.write.option("header", True).csv(f"{folder}/{name}")
    nets = city_networks(read_networks(spark, f"{folder}/blocks", CITY_BLOCKS), read_networks(spark, f"{folder}/places", LOCATIONS))
    return nets.select("network", "country", "registered_country", "city")


def geo_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """City and ASN tables apart, the country falling back to the registered one."""
    city, asn = _published(spark, sf)
    rows = fx.connection_rows(fx.events(spark, sf))
    return geo_enrich(rows, "ip", city, asn).select("ip", "country", "city", "asn", "as_org")


def hosting_flag_query(spark: SparkSession, sf: str) -> DataFrame:
    texts = fx.table(spark, sf, "documents").select("doc_id", "text")
    names = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("doc_id"), F.col("s_name").alias("text")
    )
    return texts.unionByName(names).select("doc_id", hosting_flag("text").alias("is_hosting"))


def ua_classify_query(spark: SparkSession, sf: str) -> DataFrame:
    agents = fx.request_rows(fx.events(spark, sf)).select("user_agent")
    texts = fx.table(spark, sf, "documents").select(F.col("text").alias("user_agent"))
    return (
        agents.unionByName(texts)
        .withColumn("client", ua_classify("user_agent"))
        .select("user_agent", F.col("client.family").alias("ua_family"), F.col("client.kind").alias("ua_kind"))
    )


def name_fallback(spark: SparkSession, sf: str) -> DataFrame:
    pairs = rollups.merge_usage(_tables(spark, sf).usage_5m).select("node_id", "user_id").distinct()
    named = with_user(pairs, fx.dim_users(spark, sf))
    return with_node_name(named, fx.dim_nodes(spark, sf)).select("node_id", "node_name", "user_id", "username")


# --- rollups and views --------------------------------------------------------


def _tables(spark: SparkSession, sf: str) -> fx.DerivedTables:
    return fx.DerivedTables(spark, sf)


def user_conn_5m(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.counts(_tables(spark, sf).user_conn_5m, rollups.CONN_STATES)


def sub_req_5m(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.counts(_tables(spark, sf).sub_req_5m, rollups.SUB_STATES)


def distinct_state_merge(spark: SparkSession, sf: str) -> DataFrame:
    merged = rollups.merge_conn(_tables(spark, sf).user_conn_5m, ["user_id"])
    return rollups.counts(merged, rollups.CONN_STATES)


def _partitions(spark: SparkSession, sf: str, per: int = 100_000) -> str:
    """Shuffle partitions for ``per`` events each, the session's number at least."""
    return str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), fx.events(spark, sf).count() // per))


def rollup_partial_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches rolled up apart, then merged, in shuffle partitions by the number of events."""
    facts = fx.sub_requests(spark, sf)
    batch = F.pmod(F.xxhash64("ts", "user_id", "ip"), F.lit(3))
    partials = [rollups.sub_req_5m(facts.filter(batch == i)) for i in range(3)]
    merged, root = rollups.merge_sub(reduce(DataFrame.unionByName, partials)), session.scratch(spark, "merged")
    with session.setting(spark, "spark.sql.shuffle.partitions", _partitions(spark, sf)):
        merged.write.parquet(root)
    return rollups.counts(spark.read.parquet(root), rollups.SUB_STATES)


def _abuse(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return user_abuse(t.usage_5m, t.user_conn_5m, t.sub_req_5m, t.dim_users, fx.T_FROM, fx.T_TO)


def _universe(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return active_universe(t.usage_5m, t.user_conn_5m, t.sub_req_5m, fx.T_FROM, fx.T_TO)


def time_range_edges(spark: SparkSession, sf: str) -> DataFrame:
    usage = rollups.merge_usage(_tables(spark, sf).usage_5m)
    return shown(in_range(usage, "ts5", fx.EDGE_FROM, fx.EDGE_TO))


# --- reports ------------------------------------------------------------------


def _exact_abuse(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    usage = fx.usage_facts(fx.events(spark, sf))
    return exact_abuse(usage, t.node_connections, t.sub_requests, t.dim_users, fx.T_FROM, fx.T_TO)


def _stored(spark: SparkSession, root: str, table: str, rollup: DataFrame) -> DataFrame:
    """A rollup that several steps read, made once."""
    store.write_batch(rollup, root, table, 0)
    return store.read_table(spark, root, table)


def exact_rolled(spark: SparkSession, sf: str) -> DataFrame:
    """The score from rollups and bit states, which three batches brought; the last one came twice. The limit is low
    so that most accounts of the test tables count as large."""
    t, root = _tables(spark, sf), session.scratch(spark, "exact")
    store.write_batch(t.node_connections, root, "node_connections", 0)
    store.write_batch(t.sub_requests, root, "sub_requests", 0)
    connections, requests = (store.read_table(spark, root, f) for f in ("node_connections", "sub_requests"))
    conn = _stored(spark, root, "user_conn_5m", rollups.user_conn_5m(connections))
    sub = _stored(spark, root, "sub_req_5m", rollups.sub_req_5m(requests))
    large_accounts(conn, sub, limit=2).write.parquet(f"{root}/large")
    large = spark.read.parquet(f"{root}/large")
    for batch in (0, 1, 2, 2):
        part = F.pmod(F.xxhash64("ts", "user_id"), F.lit(3)) == batch
        store_exact_batch(spark, root, batch, connections.filter(part), requests.filter(part), large)
    return exact_rolled_abuse(t.usage_5m, conn, sub, read_states(spark, root), t.dim_users, fx.T_FROM, fx.T_TO)


def distinct_beyond_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses per account, one of which has most lines of all orders, each with four: 200,000 at sf0.01."""
    lines = fx.table(spark, sf, "lineitem").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(3))))
    rows = lines.select(
        F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_dt_interval(0, l_orderkey % 24, s * 5)").alias("ts"),
        F.expr("CAST(IF(l_linenumber <= 5, 1, l_linenumber) AS BIGINT)").alias("user_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "s").alias("ip"),
    )
    facts = schemas.conform(rows, schemas.NODE_CONNECTIONS)
    root = session.scratch(spark, "beyond")
    requests = spark.createDataFrame([], schemas.SUB_REQUESTS)
    conn = _stored(spark, root, "user_conn_5m", rollups.user_conn_5m(facts))
    large_accounts(conn, rollups.sub_req_5m(requests)).write.parquet(f"{root}/large")
    large = spark.read.parquet(f"{root}/large")
    # Lines come with one half of their addresses, then with all of them.
    for batch, some in enumerate((facts.filter("minute(ts) < 10"), facts)):
        store_exact_batch(spark, root, batch, some, requests, large)
    small = rollups.merge_conn(conn, ["user_id"]).join(large, "user_id", "left_anti")
    few = rollups.counts(small, rollups.CONN_STATES).select("user_id", "ips")
    return few.unionByName(bit_counts(read_states(spark, root)).select("user_id", "ips"))


def weighted_abuse(spark: SparkSession, sf: str) -> DataFrame:
    """Own weights and allowances."""
    t = _tables(spark, sf)
    weights, free = {"country": 7, "request": 0.25}, {"network": 0, "request": 3}
    scored = user_abuse(t.usage_5m, t.user_conn_5m, t.sub_req_5m, t.dim_users, fx.T_FROM, fx.T_TO, weights, free)
    return scored.select("user_id", "score")


def sql_user_abuse(spark: SparkSession, sf: str) -> DataFrame:
    """The table function, over stored rollups."""
    root = session.scratch(spark, "sql")
    t = _tables(spark, sf)
    for name in ("usage_5m", "user_conn_5m", "sub_req_5m"):
        store.write_batch(getattr(t, name), root, name, 0)
    stored = {name: store.read_table(spark, root, name) for name in ("usage_5m", "user_conn_5m", "sub_req_5m")}
    register(spark, Tables(
        **stored, sub_requests=t.sub_requests, node_connections=t.node_connections,
        dim_users=t.dim_users, dim_nodes=t.dim_nodes,
    ))
    return spark.sql(f"SELECT * FROM v_user_abuse(TIMESTAMP_NTZ '{fx.T_FROM}', TIMESTAMP_NTZ '{fx.T_TO}')")


def report(function, *, window: tuple[str, str] = (fx.T_FROM, fx.T_TO), **options) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return function(_tables(spark, sf), *window, **options)

    return run


EDGES = (fx.EDGE_FROM, fx.EDGE_TO)


REPORTS = {
    name: getattr(module, name)
    for module in (abuse_reports, node_reports, request_reports)
    for name in vars(module)
    if name.startswith("r_")
}
_STAT_COLUMN = {
    "flagged_accounts": "flagged", "heaviest_share": "pct", "scripted_share": "pct",
    "busiest_account": "requests",
}


def _banded(function, name: str) -> Query:
    return lambda spark, sf: report_bands(report(function)(spark, sf), name)


def _stored_tables(spark: SparkSession, sf: str) -> Tables:
    """What several reports read, stored once, the rollups built from the stored facts."""
    t, root = _tables(spark, sf), session.scratch(spark, "reports")
    for name in ("sub_requests", "node_connections"):
        store.write_batch(getattr(t, name), root, name, 0)
    facts = {name: store.read_table(spark, root, name) for name in ("sub_requests", "node_connections")}
    usage = _stored(spark, root, "usage_5m", t.usage_5m)
    conn = _stored(spark, root, "user_conn_5m", rollups.user_conn_5m(facts["node_connections"]))
    sub = _stored(spark, root, "sub_req_5m", rollups.sub_req_5m(facts["sub_requests"]))
    return Tables(usage, conn, sub, facts["sub_requests"], facts["node_connections"], t.dim_users, t.dim_nodes)


def stat_bands(spark: SparkSession, sf: str) -> DataFrame:
    from accesslens.plans.severity import STAT_BANDS

    t = _stored_tables(spark, sf)
    parts = [
        stat_band(REPORTS[f"r_{name}"](t, fx.T_FROM, fx.T_TO), name, _STAT_COLUMN.get(name, "c"))
        for name in STAT_BANDS
    ]
    return reduce(DataFrame.unionByName, parts)


# --- streaming ----------------------------------------------------------------


def _streamed(query: Query) -> Query:
    """A stream's state gets a partition per core: that number is fixed when a stream first starts."""

    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        cores = str(spark.sparkContext.defaultParallelism)
        with session.setting(spark, "spark.sql.shuffle.partitions", cores):
            return query(spark, sf)

    return run


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream; a stream reads folders, so a table that is one file is picked from its folder."""
    reader = spark.readStream.schema(fx.events(spark, sf).schema)
    if files.is_folder(spark, f"{sf}/events.parquet"):
        return reader.parquet(f"{sf}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf)


def stream_usage_5m(spark: SparkSession, sf: str) -> DataFrame:
    root = session.scratch(spark, "stream-usage")
    facts = fx.usage_facts(_event_stream(spark, sf))
    start_usage_rollup(facts, f"{root}/out", f"{root}/checkpoint", _NOW).awaitTermination()
    partials = store.read_table(spark, f"{root}/out", "usage_5m").drop("month")
    return shown(rollups.merge_usage(partials))


def restart_new_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Two queries of their own checkpoints into one folder: both are stored."""
    root = session.scratch(spark, "stream-twice")
    facts = fx.usage_facts(_event_stream(spark, sf))
    for i in range(2):
        for _ in range(2):  # the second start of each finds nothing new
            start_usage_rollup(facts, f"{root}/out", f"{root}/checkpoint-{i}", _NOW).awaitTermination()
    partials = store.read_table(spark, f"{root}/out", "usage_5m").drop("month")
    return shown(rollups.merge_usage(partials))


def stream_watermark_rollup(spark: SparkSession, sf: str) -> DataFrame:
    root = session.scratch(spark, "stream-watermark")
    facts = fx.usage_facts(_event_stream(spark, sf))
    out, checkpoint = f"{root}/out", f"{root}/checkpoint"
    start_watermark_rollup(facts, "10 minutes", out, checkpoint, _NOW).awaitTermination()
    return shown(read_watermark_rollup(spark, out))


def stream_late_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """A file of later days, then one of earlier days: sums of open buckets and corrections of closed ones."""
    root = session.scratch(spark, "corrections")
    facts = fx.usage_facts(fx.events(spark, sf))
    later = F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    out, checkpoint = f"{root}/out", f"{root}/checkpoint"
    for name, rows in (("a", facts.filter(later)), ("b", facts.filter(~later))):
        rows.write.parquet(f"{root}/facts/{name}")
        stream = spark.readStream.schema(facts.schema).parquet(f"{root}/facts/*")
        start_corrected_rollup(stream, "1 hour", out, checkpoint, _NOW).awaitTermination()
    parts = [
        rollups.merge_usage(store.read_table(spark, where, "usage_5m").drop("month")).withColumn("corrected", F.lit(late))
        for where, late in ((out, False), (f"{out}/late", True))
    ]
    return shown(parts[0].unionByName(parts[1]))


def _land(rows: DataFrame, kind: str, path: str) -> None:
    """Landing files as exporters leave them: compressed, each with so few entries that batches are cut between files."""
    writer = rows.write.format(kind).option("compression", "gzip").option("maxRecordsPerFile", _FILE_ENTRIES)
    with session.setting(rows.sparkSession, session.CLEANUP, "true"):
        writer.save(path)


def _ingested(spark: SparkSession, sf: str, name: str, stream: str | None = None) -> str:
    """The folder into which all messages were ingested, in batches of bounded size."""
    root = session.scratch(spark, name)
    _land(fx.messages(fx.events(spark, sf)), "json", f"{root}/landing")
    nets = index_networks(fx.geo_networks(spark, sf), CITY_COLUMNS + ASN_COLUMNS)
    source = read_entry_files(spark, f"{root}/landing", streaming=True, max_bytes_per_trigger=_BATCH_BYTES)
    start_ingest(
        spark, source, stream, f"{root}/out", f"{root}/checkpoint", _NOW, lambda: (nets, nets)
    ).awaitTermination()
    return f"{root}/out"


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and a sum over the values of every stored table after ingest, partials of several batches merged."""
    out = _ingested(spark, sf, "stream-ingest")
    t = {name: store.read_table(spark, out, name) for name in store.LAYOUT}
    t["usage_5m"] = rollups.merge_usage(t["usage_5m"], keep_zero=True)
    t["user_conn_5m"] = rollups.counts(rollups.merge_conn(t["user_conn_5m"]), rollups.CONN_STATES)
    t["sub_req_5m"] = rollups.counts(rollups.merge_sub(t["sub_req_5m"]), rollups.SUB_STATES)
    t["quarantine"] = read_quarantine(spark, out)
    values = {
        "user_usage": "bytes + user_id + node_id",
        "sub_requests": "asn + is_hosting + length(ip) + length(user_agent) + length(srr_response_type)",
        "node_connections": "asn + is_hosting + length(ip) + node_id",
        "usage_5m": "bytes + user_id + node_id",
        "user_conn_5m": "ips + prefixes + asns + countries + nodes + hosting_ips",
        "sub_req_5m": "requests + scripted + blocked + ips + prefixes + asns + countries + uas",
        "quarantine": "length(reason)",
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(values[name])).cast("bigint").alias("amount")).select(
            F.lit(name).alias("table"), "rows", "amount"
        )
        for name, df in t.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def stream_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The measures that ingest stored, added up per stream."""
    measures = read_measures(spark, _ingested(spark, sf, "stream-quality"))
    sums = [F.sum(c).alias(c) for c in ("messages", "failed", "rows")]
    return measures.groupBy("stream").agg(*sums)


def unreadable_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are no entries, and entries of unknown streams, among good and faulty messages."""
    root = session.scratch(spark, "unreadable")
    ev = fx.events(spark, sf)
    good = fx.messages(ev).select(F.to_json(F.struct("entry_id", "stream", "fields")).alias("value"))
    bad = ev.selectExpr(
        "explode(array(concat('{not json ', event_id), concat('[', event_id, ']'), "
        """concat('{"entry_id":"x-', event_id, '","stream":"other","fields":{}}'))) AS value"""
    )
    _land(good.unionByName(bad), "text", f"{root}/landing")
    source = read_entry_files(spark, f"{root}/landing", streaming=True, max_bytes_per_trigger=_BATCH_BYTES)
    start_ingest(spark, source, None, f"{root}/out", f"{root}/checkpoint", _NOW).awaitTermination()
    kept = F.count_if(F.col("raw").isNotNull() | F.col("fields").isNotNull())
    return read_quarantine(spark, f"{root}/out").groupBy("stream", "reason").agg(
        F.count(F.lit(1)).alias("n"), kept.alias("with_payload")
    )


def _usage_per_user(spark: SparkSession, out: str) -> DataFrame:
    stored = rollups.merge_usage(store.read_table(spark, out, "usage_5m").drop("month"), keep_zero=True)
    return stored.groupBy("user_id").agg(total_bigint("bytes").alias("bytes"))


def resume_from_now(spark: SparkSession, sf: str) -> DataFrame:
    """Started for new files only; what lands while the query is stopped is read at the restart."""
    root = session.scratch(spark, "resume")
    messages = fx.usage_messages(fx.events(spark, sf))
    messages.write.json(f"{root}/landing/before")

    def run() -> None:
        source = read_entry_files(
            spark, f"{root}/landing/*", streaming=True, from_beginning=False, checkpoint=f"{root}/checkpoint"
        )
        start_ingest(spark, source, USAGE_STREAM, f"{root}/out", f"{root}/checkpoint", _NOW).awaitTermination()

    run()
    messages.withColumn("entry_id", F.concat(F.lit("later-"), "entry_id")).write.json(f"{root}/landing/after")
    run()
    return _usage_per_user(spark, f"{root}/out")


def stream_small_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Four files, one per batch."""
    root = session.scratch(spark, "small-batches")
    fx.usage_messages(fx.events(spark, sf)).repartition(4, "entry_id").write.json(f"{root}/landing")
    source = read_entry_files(spark, f"{root}/landing", streaming=True, max_files_per_trigger=1)
    start_ingest(spark, source, None, f"{root}/out", f"{root}/checkpoint", _NOW).awaitTermination()
    sums = [F.sum(c).alias(c) for c in ("messages", "failed", "rows")]
    return read_measures(spark, f"{root}/out").groupBy("stream").agg(F.count(F.lit(1)).alias("batches"), *sums)


def stream_byte_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Six files, cut into batches of at most two and a half times the largest file's bytes."""
    root = session.scratch(spark, "byte-batches")
    landing, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    fx.usage_messages(fx.events(spark, sf)).repartition(6, "entry_id").write.json(landing)
    limit = landed(spark, landing).agg(F.max("bytes")).first()[0] * 5 // 2
    source = read_entry_files(spark, landing, streaming=True, max_bytes_per_trigger=limit)
    start_ingest(spark, source, None, f"{root}/out", checkpoint, _NOW).awaitTermination()
    sums = [F.sum(c).alias(c) for c in ("messages", "failed", "rows")]
    measures = read_measures(spark, f"{root}/out").groupBy("stream").agg(*sums)
    per = landed(spark, landing).join(files_read(spark, f"{checkpoint}/all"), "path").groupBy("batch").agg(F.sum("bytes").alias("bytes"))
    cut = per.agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("most")).first()
    return measures.withColumn("cut", F.lit(cut["n"] > 1 and cut["most"] <= limit))


def stream_pending(spark: SparkSession, sf: str) -> DataFrame:
    """What waits to be read before a stream starts, after it has caught up, and when more files have landed."""
    root = session.scratch(spark, "pending")
    landing, checkpoint, out = f"{root}/landing", f"{root}/checkpoint", f"{root}/out"
    messages = fx.usage_messages(fx.events(spark, sf))
    even = F.pmod(F.substring("entry_id", 3, 20).cast("long"), F.lit(2)) == 0

    def measure(minute: int) -> None:
        store_pending(spark, f"{landing}/*", f"{checkpoint}/user_usage", out, f"2024-01-01 00:0{minute}:00")

    messages.filter(even).coalesce(2).write.json(f"{landing}/first")
    measure(0)
    source = read_entry_files(spark, f"{landing}/*", streaming=True)
    start_ingest(spark, source, USAGE_STREAM, out, checkpoint, _NOW).awaitTermination()
    measure(1)
    messages.filter(~even).coalesce(1).write.json(f"{landing}/later")
    measure(2)
    return read_pending(spark, out).select("at", "entries", (F.col("bytes") > 0).alias("waiting"))


def table_sizes_query(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of stored facts, rollup and dimensions."""
    root = session.scratch(spark, "sizes")
    store.write_batch(fx.usage_facts(fx.events(spark, sf)), root, "user_usage", 0)
    store.backfill(spark, root, "user_usage")
    refresh_dimension(fx.dim_nodes(spark, sf), root, "dim_nodes")
    stored = {name: store.read_table(spark, root, name) for name in ("user_usage", "usage_5m")}
    return table_sizes({**stored, "dim_nodes": read_dimension(spark, root, "dim_nodes")})


def refreshed_networks(spark: SparkSession, sf: str) -> DataFrame:
    """The same requests in two batches, the network tables replaced between them."""
    root = session.scratch(spark, "refreshed")
    first = fx.geo_networks(spark, sf)
    later = first.withColumn("country", F.concat("country", F.lit(" 2")))
    messages = fx.request_messages(fx.events(spark, sf))
    for name, nets in (("a", first), ("b", later)):
        again = messages.withColumn("entry_id", F.concat(F.lit(f"{name}-"), "entry_id"))
        again.write.json(f"{root}/landing/{name}")
        source = read_entry_files(spark, f"{root}/landing/*", streaming=True)
        start_ingest(
            spark, source, REQUEST_STREAM, f"{root}/out", f"{root}/checkpoint", _NOW, lambda nets=nets: (nets, nets)
        ).awaitTermination()
    stored = store.read_table(spark, f"{root}/out", "sub_requests")
    return stored.groupBy("country").agg(F.count(F.lit(1)).alias("requests"))


def stream_dedup_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same entries landed twice, read as two batches: stored once."""
    root = session.scratch(spark, "redelivered")
    for name in ("first", "again"):
        fx.usage_messages(fx.events(spark, sf)).write.json(f"{root}/landing/{name}")
        source = read_entry_files(spark, f"{root}/landing/*", streaming=True)
        start_ingest(spark, source, USAGE_STREAM, f"{root}/out", f"{root}/checkpoint", _NOW).awaitTermination()
    return _usage_per_user(spark, f"{root}/out")


def replay_after_compact(spark: SparkSession, sf: str) -> DataFrame:
    """A query that stops before it commits its last batch, maintenance, and the restart that replays the batch:
    after facts and rollup are compacted, and again after the rollup is rebuilt."""
    root = session.scratch(spark, "replayed")
    fx.usage_messages(fx.events(spark, sf)).repartition(3, "entry_id").write.json(f"{root}/landing")
    out, checkpoint = f"{root}/out", f"{root}/checkpoint"

    def ingest() -> None:
        source = read_entry_files(spark, f"{root}/landing", streaming=True, max_files_per_trigger=1)
        start_ingest(spark, source, USAGE_STREAM, out, checkpoint, _NOW).awaitTermination()

    def replay() -> None:
        commits = f"{checkpoint}/user_usage/commits"
        last = max(int(name) for name in files.children(spark, commits) if name.isdigit())
        files.delete(spark, f"{commits}/{last}")
        ingest()

    ingest()
    for table in ("user_usage", "usage_5m"):
        store.compact(spark, out, table)
    replay()
    store.backfill(spark, out, "user_usage")
    replay()
    facts = store.read_table(spark, out, "user_usage").groupBy("user_id").agg(F.count(F.lit(1)).alias("facts"))
    return _usage_per_user(spark, out).join(facts, "user_id")


def dedup_many_days(spark: SparkSession, sf: str) -> DataFrame:
    """A file per day, each with copies of all entries of the day before: one batch per file, stored once."""
    root = session.scratch(spark, "many-days")
    entries = fx.usage_messages(fx.events(spark, sf)).withColumn("day", F.to_date(F.expr("fields['ts']")))
    again = entries.withColumn("day", F.date_add("day", 1))
    entries.unionByName(again).repartition("day").write.partitionBy("day").json(f"{root}/landing")
    source = read_entry_files(spark, f"{root}/landing/*", streaming=True, max_files_per_trigger=1)

    def store_batch(batch: DataFrame, number: int) -> None:
        batch.select("entry_id", "fields").write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    once = first_deliveries(source, "1 day")
    once.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(**_NOW).foreachBatch(store_batch).start().awaitTermination()
    kept = spark.read.schema("entry_id STRING, fields MAP<STRING,STRING>, batch INT").parquet(f"{root}/out")
    per = kept.groupBy(F.substring(F.expr("fields['ts']"), 1, 10).alias("day"))
    return per.agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("entry_id").alias("ids"))


def dedup_entries_query(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry delivered twice, kept once."""
    entries = fx.messages(fx.events(spark, sf))
    return dedup_entries(entries.unionByName(entries)).select("entry_id", "stream")


def ingest_quality_query(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_quality(fx.messages(fx.events(spark, sf)))


def queries() -> dict[str, Query]:
    t = _tables
    return {
        "fact_roundtrip": fact_roundtrip,
        "load_dim_users": lambda s, d: load_dim_users(fx.user_pages(s, d), fx.AS_OF).withColumn(
            "traffic_limit_bytes", as_bigint(F.col("traffic_limit_bytes"))
        ),
        "load_dim_nodes": lambda s, d: load_dim_nodes(fx.node_pages(s, d), fx.AS_OF),
        "dim_refresh_changes": dim_refresh_changes,
        "retention_filter": retention_filter,
        "schema_evolution_union": schema_evolution_union,
        "backfill_rollup": backfill_rollup,
        "backfill_live": backfill_live,
        "backfill_changed": backfill_changed,
        "compact_live": compact_live,
        "clustered_account": clustered_account,
        "retention_drop": retention_drop,
        "pruned_range": pruned_range,
        "decode_user_usage": _decode(USAGE_STREAM),
        "decode_sub_requests": _decode(REQUEST_STREAM),
        "decode_node_connections": _decode(CONNECTION_STREAM),
        "response_type_coalesce": response_type_coalesce,
        "split_packed_records": split_packed_records,
        "quarantine_counts": quarantine_counts,
        "uint64_values": uint64_values,
        "poison_message": poison_message,
        "ip_family": _address_query("family", ip_family),
        "ip_prefix": _address_query("ip_prefix", ip_prefix),
        "ip_is_routable": _address_query("routable", ip_is_routable),
        "geo_enrich": _geo_query(),
        "geo_enrich_shuffled": _geo_query(broadcast_bytes=0),
        "geo_range_join": geo_range_join,
        "geo_prefix_join": geo_prefix_join,
        "geo_v6": geo_v6,
        "geo_overlap": geo_overlap,
        "read_networks_csv": read_networks_csv,
        "read_networks_accounts": read_networks_accounts,
        "geo_two_tables": geo_two_tables,
        "custom_hosting": custom_hosting,
        "hosting_flag": hosting_flag_query,
        "ua_classify": ua_classify_query,
        "name_fallback": name_fallback,
        "usage_5m": lambda s, d: shown(t(s, d).usage_5m),
        "user_conn_5m": user_conn_5m,
        "sub_req_5m": sub_req_5m,
        "distinct_state_merge": distinct_state_merge,
        "rollup_partial_merge": rollup_partial_merge,
        "dim_latest": lambda s, d: v_users(fx.dim_users_history(s, d)),
        "v_usage": lambda s, d: v_usage(t(s, d).usage_5m, fx.dim_users(s, d), fx.dim_nodes(s, d)),
        "v_connections": lambda s, d: v_connections(
            t(s, d).node_connections, fx.dim_users(s, d), fx.dim_nodes(s, d)
        ),
        "v_sub_requests": lambda s, d: v_sub_requests(t(s, d).sub_requests, fx.dim_users(s, d)),
        "active_universe": _universe,
        "user_abuse": _abuse,
        "exact_abuse": _exact_abuse,
        "exact_rolled_abuse": exact_rolled,
        "distinct_beyond_sketch": distinct_beyond_sketch,
        "weighted_abuse": weighted_abuse,
        "sql_user_abuse": sql_user_abuse,
        "v_nodes": lambda s, d: v_nodes(fx.dim_nodes(s, d)),
        "time_range_edges": time_range_edges,
        "node_filter": report(node_reports.r_top5_per_node, nodes=NODE_LIST),
        "score_bands": _banded(abuse_reports.r_abuse_score, "abuse_score"),
        "talker_bands": _banded(node_reports.r_top_talkers, "top_talkers"),
        "node_share_bands": _banded(node_reports.r_top5_per_node, "top5_per_node"),
        "offender_bands": _banded(request_reports.r_fetch_offenders, "fetch_offenders"),
        "shared_address_bands": _banded(abuse_reports.r_shared_addresses, "shared_addresses"),
        "network_bands": _banded(request_reports.r_top_networks, "top_networks"),
        "stat_bands": stat_bands,
        **{name: report(function) for name, function in REPORTS.items()},
        "edge_abuse_score": report(abuse_reports.r_abuse_score, window=EDGES),
        "edge_top_talkers": report(node_reports.r_top_talkers, window=EDGES),
        "edge_fetch_offenders": report(request_reports.r_fetch_offenders, window=EDGES),
        "edge_account_geography": report(abuse_reports.r_account_geography, window=EDGES),
        "cut_abuse_score": report(abuse_reports.r_abuse_score, limit=20),
        "cut_top_talkers": report(node_reports.r_top_talkers, limit=9),
        "cut_fetch_offenders": report(request_reports.r_fetch_offenders, limit=20),
        "cut_refused_by_rule": report(request_reports.r_refused_by_rule, limit=4),
        "cut_top_networks": report(request_reports.r_top_networks, limit=7),
        "cut_client_families": report(request_reports.r_client_families, limit=3),
        "stream_usage_5m": _streamed(stream_usage_5m),
        "restart_new_checkpoint": _streamed(restart_new_checkpoint),
        "resume_from_now": _streamed(resume_from_now),
        "stream_dedup_two_batches": _streamed(stream_dedup_two_batches),
        "replay_after_compact": _streamed(replay_after_compact),
        "dedup_many_days": _streamed(dedup_many_days),
        "stream_small_batches": _streamed(stream_small_batches),
        "stream_byte_batches": _streamed(stream_byte_batches),
        "stream_pending": _streamed(stream_pending),
        "table_sizes": table_sizes_query,
        "refreshed_networks": _streamed(refreshed_networks),
        "unreadable_entries": _streamed(unreadable_entries),
        "stream_quality": _streamed(stream_quality),
        "stream_watermark_rollup": _streamed(stream_watermark_rollup),
        "stream_late_corrections": _streamed(stream_late_corrections),
        "stream_ingest": _streamed(stream_ingest),
        "dedup_entries": dedup_entries_query,
        "ingest_quality": ingest_quality_query,
    }
