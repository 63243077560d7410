"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, version: str = "updated_at") -> DataFrame:
    """The newest row of every key; ties break on the remaining columns.

    Written as an aggregate so that old versions are dropped before the
    shuffle, however many a single key has.
    """
    rest = [c for c in df.columns if c not in (key, version)]
    newest = df.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("_row"))
    return newest.select(*[c if c == key else f"_row.{c}" for c in df.columns])
