"""What bit states cost: bytes by values, one shuffle of the values."""

import datetime as dt

from pyspark.sql import functions as F

from accesslens import schemas
from accesslens.operators import exact_states as exact
from accesslens.sources.exact import read_numbers, read_states, store_exact_batch

AT = dt.datetime(2024, 1, 1)


def sparse(spark, n, buckets=500):
    rows = spark.range(n).select(
        (F.lit(AT).cast("timestamp_ntz") + F.expr(f"make_dt_interval(0, 0, 5 * int(id % {buckets}))")).alias("ts"),
        F.lit(1).cast("long").alias("user_id"), F.concat(F.lit("a"), "id").alias("ip"),
    )
    return schemas.conform(rows, schemas.NODE_CONNECTIONS)


def test_states_of_few_values_per_bucket_are_small(spark, tmp_path):
    root, large = str(tmp_path), spark.createDataFrame([(1,)], "user_id long")
    store_exact_batch(spark, root, 0, sparse(spark, 50_000), spark.createDataFrame([], schemas.SUB_REQUESTS), large)
    states = read_states(spark, root)
    held = sum(f.stat().st_size for f in (tmp_path / "values_5m").rglob("*.parquet"))
    assert held <= 16 * states.count()  # bitmaps of 4096 bytes before, over 100 of them left after compression
    assert exact.bit_counts(states).first().ips == 50_000
    assert read_numbers(spark, root).filter("kind = 'ips'").agg(F.max("number")).first()[0] == 50_000


def test_values_are_dealt_once(spark):
    values, known = exact.connection_values(sparse(spark, 100)), spark.createDataFrame([], schemas.VALUE_NUMBERS)
    plan = exact.dealt(values, known, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_frequent_values_are_found_and_change_no_number(spark):
    one = sparse(spark, 2000).withColumn("node_id", F.lit(5).cast("long"))
    values, known = exact.connection_values(one), spark.createDataFrame([], schemas.VALUE_NUMBERS)
    often = exact.frequent(values)
    assert values.filter("kind = 'nodes'").select(F.xxhash64("user_id", "kind", "h1")).first()[0] in often

    def placed(some):
        rows = exact.numbered(exact.dealt(values, known, 4, some), known)
        return sorted(tuple(r) for r in exact.bit_states(rows).collect())

    assert placed(often) == placed([])
