"""Seconds per report at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Facts and rollups are stored first, as ingest would, and timed on the way;
every report then reads the stored tables. ``raw_abuse`` measures accounts from
the raw facts instead. The dense case stores every event ``DENSE`` times within
its buckets, as frequent snapshots do, and asks the same question of rollups
(``dense_user_abuse``) and of raw facts (``dense_exact_abuse``); ``dense`` gives
rows and bytes of both. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens import catalogue, session
from accesslens import fixtures as fx
from accesslens.operators.decode import STREAMS
from accesslens.operators.enrich import ASN_COLUMNS, CITY_COLUMNS, enrich_connections, enrich_requests
from accesslens.operators.networks import NetworkIndex, index_networks
from accesslens.plans.abuse import exact_abuse, user_abuse
from accesslens.plans.views import Tables
from accesslens.sources import tables as store
from accesslens.streaming.quality import ingest_quality

DENSE = 20

def facts(ev: DataFrame, nets: NetworkIndex) -> dict[str, DataFrame]:
    return {
        "user_usage": fx.usage_facts(ev),
        "sub_requests": enrich_requests(fx.request_rows(ev), nets, nets),
        "node_connections": enrich_connections(fx.connection_rows(ev), nets, nets),
    }


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def store_tables(spark: SparkSession, sf: str, nets: NetworkIndex, root: str, seconds: dict[str, float]) -> Tables:
    ev = spark.read.parquet(f"{root}/events")
    for table, rows in facts(ev, nets).items():
        seconds[f"store_{table}"] = timed(lambda: store.write_rebalanced(rows, root, table, 0))
        rollup = store.ROLLUP_OF[table][0]
        seconds[f"rollup_{rollup}"] = timed(lambda: store.backfill(spark, root, table))
    for name, rows in (("dim_users", fx.dim_users(spark, sf)), ("dim_nodes", fx.dim_nodes(spark, sf))):
        rows.write.parquet(f"{root}/{name}")
    return Tables(
        **{name: store.read_table(spark, root, name) for name in store.LAYOUT if name != "user_usage"},
        dim_users=spark.read.parquet(f"{root}/dim_users"),
        dim_nodes=spark.read.parquet(f"{root}/dim_nodes"),
    )


def raw_abuse(t: Tables, usage: DataFrame) -> DataFrame:
    """The abuse measures straight from raw facts, with exact distinct counts."""
    traffic = usage.groupBy("user_id").agg(F.sum("bytes"), F.count_distinct("node_id"))
    seen = t.node_connections.groupBy("user_id").agg(
        *[F.count_distinct(c) for c in ("ip", "ip_prefix", "asn", "country", "node_id")]
    )
    fetched = t.sub_requests.groupBy("user_id").agg(
        F.count(F.lit(1)), F.count_distinct("ip"), F.count_distinct("user_agent")
    )
    return traffic.join(seen, "user_id", "full").join(fetched, "user_id", "full")


def folder_bytes(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def dense(spark: SparkSession, nets: NetworkIndex, root: str, seconds: dict[str, float]) -> dict[str, dict[str, int]]:
    """Many snapshots per account and bucket: what rollups are for."""
    ev = spark.read.parquet(f"{root}/events")
    where = f"{root}/dense"
    for table, rows in facts(ev, nets).items():
        often = rows.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(DENSE - 1))))
        often = often.withColumn("ts", F.expr("timestampadd(SECOND, s, ts)")).drop("s")
        store.write_rebalanced(often, where, table, 0)
        seconds[f"dense_rollup_{store.ROLLUP_OF[table][0]}"] = timed(lambda: store.backfill(spark, where, table))
    t = {name: store.read_table(spark, where, name) for name in store.LAYOUT}
    users, window = spark.read.parquet(f"{root}/dim_users"), (fx.T_FROM, fx.T_TO)
    rolled = user_abuse(t["usage_5m"], t["user_conn_5m"], t["sub_req_5m"], users, *window)
    exact = exact_abuse(t["user_usage"], t["node_connections"], t["sub_requests"], users, *window)
    for name, df in (("dense_user_abuse", rolled), ("dense_exact_abuse", exact)):
        seconds[name] = timed(lambda: run(df))
    raw, small = list(store.ROLLUP_OF), [r for r, _, _ in store.ROLLUP_OF.values()]
    return {
        kind: {
            "rows": sum(t[n].count() for n in names),
            "bytes": sum(folder_bytes(spark, f"{where}/{n}") for n in names),
        }
        for kind, names in (("raw", raw), ("rollups", small))
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    root = session.scratch(spark, "bench")
    # Inputs as a stored table would hold them: several files, not one.
    fx.events(spark, sf).repartition(int(cpus)).write.parquet(f"{root}/events")
    fx.messages(spark.read.parquet(f"{root}/events")).write.parquet(f"{root}/messages")
    entries, indexed = spark.read.parquet(f"{root}/messages"), []
    # Once for all steps, as a refresh of the networks does.
    build = lambda: indexed.append(index_networks(fx.geo_networks(spark, sf), CITY_COLUMNS + ASN_COLUMNS))
    seconds["index_networks"] = timed(build)
    (nets,) = indexed
    for stream, spec in STREAMS.items():
        seconds[f"decode_{spec.table}"] = timed(lambda: run(spec.rows(entries, nets, nets)[0]))
    t = store_tables(spark, sf, nets, root, seconds)
    window = (fx.T_FROM, fx.T_TO)

    def abuse() -> DataFrame:
        return user_abuse(t.usage_5m, t.user_conn_5m, t.sub_req_5m, t.dim_users, *window)

    seconds["user_abuse"] = timed(lambda: run(abuse()))
    seconds["raw_abuse"] = timed(lambda: run(raw_abuse(t, store.read_table(spark, root, "user_usage"))))
    for name, report in catalogue.REPORTS.items():
        seconds[name] = timed(lambda: run(report(t, *window)))
    seconds["ingest_quality"] = timed(lambda: run(ingest_quality(entries)))
    # Not part of the total, which stays comparable with earlier rounds.
    extra: dict[str, float] = {}
    sizes = dense(spark, nets, root, extra)
    print(
        json.dumps(
            {
                "metric": "total seconds: decode, store facts, roll up, all reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {**seconds, **extra},
                "dense": sizes,
                "sf": os.path.basename(sf),
            }
        )
    )
    sys.stdout.flush()
    session.drop_scratch(spark)


if __name__ == "__main__":
    main()
