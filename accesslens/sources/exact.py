"""Stored numbers and bit states of large accounts.

Layout: ``<root>/value_numbers/batch_id=<id>`` and ``<root>/values_5m/month=<yyyyMM>/batch_id=<id>``. Numbers
are only ever added: a batch that is written again finds its values numbered and
replaces its states by the same bits. What a broken write of numbers left is kept and
counted on from. A value of several batches has one number and bits are merged by OR,
so nothing counts twice. One writer at a time.

An account that has become large needs its history once: a batch of its own with
the stored facts of that account.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslens import schemas
from accesslens.operators.exact_states import (
    KINDS, PER_TASK, bit_states, connection_values, dealt, first_seen, frequent, numbered, request_values,
)
from accesslens.sources import files

NUMBERS, STATES = "value_numbers", "values_5m"
# Encodes numbers in order as differences.
_COMPACT = ("parquet.writer.version", "PARQUET_2_0")


def read_numbers(spark: SparkSession, root: str) -> DataFrame:
    """Every number given so far."""
    if not files.exists(spark, f"{root}/{NUMBERS}"):
        return spark.createDataFrame([], schemas.VALUE_NUMBERS)
    schema = T.StructType([*schemas.VALUE_NUMBERS, T.StructField("batch_id", T.StringType())])
    return spark.read.schema(schema).parquet(f"{root}/{NUMBERS}").drop("batch_id")


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """The stored partial states with their ``month``; ``in_range`` prunes by it."""
    schema = T.StructType([*schemas.VALUES_5M, T.StructField("month", T.IntegerType())])
    if not files.exists(spark, f"{root}/{STATES}"):
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema, T.StructField("batch_id", T.StringType())])
    return spark.read.schema(stored).parquet(f"{root}/{STATES}").drop("batch_id")


def store_exact_batch(
    spark: SparkSession, root: str, batch_id: int | str, connections: DataFrame, requests: DataFrame, large: DataFrame
) -> None:
    """Number the values of the large accounts in a batch of facts and store their states.

    ``large`` (``user_id``) comes from ``large_accounts``. Numbers are stored before the states that use
    them, so a batch that broke off leaves numbers without bits at most.
    """
    own = large.select("user_id").distinct()
    parts = [f.join(own, "user_id", "left_semi") for f in (connections, requests)]
    values = connection_values(parts[0]).unionByName(request_values(parts[1]))
    known = read_numbers(spark, root)
    rows = len(KINDS) * sum(f.count() for f in parts) + known.count()
    tasks = max(spark.sparkContext.defaultParallelism, rows // PER_TASK)
    placed = dealt(values, known, tasks, frequent(values)).persist(StorageLevel.DISK_ONLY)
    # Both are written from the same numbers, which are fixed here: what is read later has the new ones too.
    given = numbered(placed, known)
    new = first_seen(given).sortWithinPartitions("user_id", "kind", "number")
    new.write.mode("append").option(*_COMPACT).parquet(f"{root}/{NUMBERS}/batch_id={batch_id}")
    states = bit_states(given).withColumns(
        {"month": F.date_format("ts5", "yyyyMM").cast("int"), "batch_id": F.lit(str(batch_id))}
    )
    writer = states.sortWithinPartitions("month", "user_id", "kind", "ts5", "slot").write.mode("overwrite").option(*_COMPACT)
    writer = writer.option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#user_id", "true")
    writer.partitionBy("month", "batch_id").parquet(f"{root}/{STATES}")
    placed.unpersist()
