"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens import session

# A word, as all contracts of this package have it: no ASCII white space.
WORD = r"[^\x20\x09-\x0D]++"
# Without this, shuffle files of a finished write stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage in a way that outlives an executor, lets the next plan see
    the true size, and frees the shuffle files made on the way.
    """
    spark = df.sparkSession
    path = session.scratch(spark, name)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(df[column], F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
