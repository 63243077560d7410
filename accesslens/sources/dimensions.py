"""Account and node dimensions from dumped API pages.

A dimension is stored as versions: a refresh adds the rows that are new or differ
from the newest version of their key, so equal refreshes write nothing. Layout:
``<root>/<name>/<generation>/refresh=<id>/…``; a pointer in ``<root>/_log/<name>``
names the generation that readers use. Compaction writes the newest version of
every key as a new generation and then switches the pointer. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens import schemas, session
from accesslens.functions.values import moment, or_empty, or_zero
from accesslens.operators.decode import rfc3339
from accesslens.operators.latest import latest
from accesslens.sources import files

USERS_PAGE = (
    "response STRUCT<users: ARRAY<STRUCT<id: BIGINT, username: STRING, status: STRING, "
    "tag: STRING, trafficLimitBytes: DOUBLE, hwidDeviceLimit: BIGINT, expireAt: STRING>>, "
    "nextCursor: STRING, hasMore: BOOLEAN>"
)
NODES_PAGE = (
    "response ARRAY<STRUCT<id: BIGINT, uuid: STRING, name: STRING, countryCode: STRING>>"
)
UNSET_TIME = "1970-01-01 00:00:00"


def read_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON pages; one malformed page fails the load, as a refresh must be whole."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def load_dim_users(pages: DataFrame, as_of) -> DataFrame:
    """Account rows of all pages, stamped ``updated_at = as_of``.

    Missing tag, device limit or expiry become ``''``, 0 and the epoch;
    traffic limits outside 0 … 2^64 become the nearer end.
    """
    u = pages.select(F.explode("response.users").alias("u")).select("u.*")
    limit = F.least(F.greatest(F.coalesce("trafficLimitBytes", F.lit(0.0)), F.lit(0.0)), F.lit(float(2**64)))
    return u.select(
        or_zero(F.col("id")).alias("user_id"),
        or_empty(F.col("username")).alias("username"),
        or_empty(F.col("status")).alias("status"),
        or_empty(F.col("tag")).alias("tag"),
        (limit - limit % 1).cast("decimal(20,0)").alias("traffic_limit_bytes"),
        or_zero(F.col("hwidDeviceLimit")).alias("hwid_device_limit"),
        F.coalesce(rfc3339("expireAt"), moment(UNSET_TIME)).alias("expire_at"),
        moment(as_of).alias("updated_at"),
    )


def load_dim_nodes(pages: DataFrame, as_of) -> DataFrame:
    """Node rows with a positive id, stamped ``updated_at = as_of``.

    Fails when there are nodes but none has a usable id: names could then be
    attached to nothing.
    """
    n = pages.select(F.explode("response").alias("n")).select("n.*")
    seen, usable = F.count(F.lit(1)), F.count_if(F.col("id") > 0)
    problem = F.raise_error(F.concat(F.lit("none of the "), seen.cast("string"), F.lit(" nodes has a numeric id")))
    # Part of the plan, so nothing runs before the result is asked for.
    sound = n.agg(F.when((seen > 0) & (usable == 0), problem.cast("boolean")).otherwise(True).alias("ok")).scalar()
    return n.filter((F.col("id") > 0) & sound).select(
        F.col("id").alias("node_id"),
        or_empty(F.col("uuid")).alias("uuid"),
        or_empty(F.col("name")).alias("name"),
        or_empty(F.col("countryCode")).alias("country_code"),
        moment(as_of).alias("updated_at"),
    )


def append_snapshot(rows: DataFrame, path: str) -> None:
    """Append a dimension refresh, evaluated once; an empty refresh only leaves an empty file."""
    rows.write.mode("append").parquet(path)


def compact_snapshots(spark: SparkSession, path: str, key: str, schema) -> str:
    """Write the newest row of every key as a new folder beside the refreshes; returns it.

    Reports that read the folder read one row per key however often the
    dimension was refreshed; ``append_snapshot`` may go on into it.
    """
    target = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    newest = latest(spark.read.schema(schema).parquet(path), key)
    newest.select(*schema.names).write.parquet(target)
    return target


# Name -> columns and key of each stored dimension.
DIMENSIONS = {"dim_users": (schemas.DIM_USERS, "user_id"), "dim_nodes": (schemas.DIM_NODES, "node_id")}


def _pointers(spark: SparkSession, root: str, name: str) -> list[str]:
    return [n for n in files.children(spark, f"{root}/_log/{name}") if n.startswith("current-") and n[8:].isdigit()]


def _generation(spark: SparkSession, root: str, name: str) -> str | None:
    names = _pointers(spark, root, name)
    return files.read_text(spark, f"{root}/_log/{name}/{names[-1]}") if names else None


def _switch(spark: SparkSession, root: str, name: str, generation: str) -> None:
    """Point to a generation. The one before stays for who still reads it, older ones go."""
    log, names = f"{root}/_log/{name}", _pointers(spark, root, name)
    number = int(names[-1][8:]) + 1 if names else 0
    files.write_text(spark, f"{log}/current-{number:012d}", generation)
    for old in names[:-1]:
        files.delete(spark, f"{root}/{name}/{files.read_text(spark, f'{log}/{old}')}")
        files.delete(spark, f"{log}/{old}")


def read_dimension(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All stored versions of the generation in use; views take the newest of each key."""
    schema, _ = DIMENSIONS[name]
    generation = _generation(spark, root, name)
    folder = f"{root}/{name}/{generation}"
    if generation is None or not files.children(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def refresh_dimension(rows: DataFrame, root: str, name: str) -> int:
    """Store what a refresh changed; returns how many versions that were.

    ``rows`` is evaluated once. ``updated_at`` says when a row was read and is no
    change by itself; keys that a refresh does not name stay as they are.
    """
    spark = rows.sparkSession
    schema, key = DIMENSIONS[name]
    read = session.scratch(spark, name)
    rows.select(*schema.names).write.parquet(read)
    fresh = latest(spark.read.schema(schema).parquet(read), key)
    generation = _generation(spark, root, name)
    if generation is None:
        generation = uuid.uuid4().hex
        _switch(spark, root, name, generation)
    content = F.struct(*[c for c in schema.names if c not in (key, "updated_at")])
    known = latest(read_dimension(spark, root, name), key).select(F.col(key).alias("_key"), content.alias("_content"))
    same = F.col(key).eqNullSafe(F.col("_key")) & content.eqNullSafe(F.col("_content"))
    target = f"{root}/{name}/{generation}/refresh={uuid.uuid4().hex}"
    fresh.join(known, same, "left_anti").write.parquet(target)
    written = spark.read.schema(schema).parquet(target).count()
    if not written:
        files.delete(spark, target)
    files.delete(spark, read)
    return written


def compact_dimension(spark: SparkSession, root: str, name: str) -> None:
    """The newest version of every key as a new generation, which readers use from then on."""
    schema, key = DIMENSIONS[name]
    generation = uuid.uuid4().hex
    newest = latest(read_dimension(spark, root, name), key).select(*schema.names)
    newest.write.parquet(f"{root}/{name}/{generation}/refresh={uuid.uuid4().hex}")
    _switch(spark, root, name, generation)


def empty_users(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DIM_USERS)


def empty_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DIM_NODES)
