"""Partitioned Parquet tables that are maintained where they live.

Layout: ``<root>/<table>/month=<yyyyMM>/batch_id=<id>/…`` (``day=<date>`` for node
connections). A batch owns its folders, so writing it again replaces it and a
replayed micro-batch changes nothing.

Compaction, rebuilding a rollup and retention replace batches in place. What
replaces what is written to ``<root>/_log/<table>`` first: until the new batch
is committed readers skip it, from then on they skip the old ones, which are
deleted last. A replacement that broke off is finished or undone by the next
one. One maintenance job per table at a time; ingest may go on, as batches that
appear meanwhile are neither read nor replaced.

The ledger beside that log remembers which batches a replacement swallowed:
for a streaming query the highest number per partition, as its batches come in
order, for other batches their ids. Writing a swallowed batch again, as a query
does that stopped between storing a batch and committing it, changes nothing in
those partitions. It also holds what each partition of a rollup was built from.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslens import schemas
from accesslens.functions.values import moment
from accesslens.operators import rollups
from accesslens.sources import files

# Table -> (schema, time column, partition column, sort keys, days kept).
LAYOUT: dict[str, tuple[T.StructType, str, str, Sequence[str], int]] = {
    "user_usage": (schemas.USER_USAGE, "ts", "month", ("node_id", "user_id", "ts"), 90),
    "sub_requests": (schemas.SUB_REQUESTS, "ts", "month", ("user_id", "ts"), 60),
    "node_connections": (schemas.NODE_CONNECTIONS, "ts", "day", ("node_id", "user_id", "ts"), 30),
    "usage_5m": (schemas.USAGE_5M, "ts5", "month", ("node_id", "user_id", "ts5"), 365),
    "user_conn_5m": (schemas.USER_CONN_5M, "ts5", "month", ("user_id", "ts5"), 90),
    "sub_req_5m": (schemas.SUB_REQ_5M, "ts5", "month", ("user_id", "ts5"), 180),
}

# Columns that tables written by earlier versions may lack.
LATE = {"sub_requests": ("srr_response_type", "srr_rule_name"), "sub_req_5m": ("blocked",)}

# Rollup of each fact table: its name, how facts become partials, how partials merge.
ROLLUP_OF: dict[str, tuple[str, Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "user_usage": ("usage_5m", rollups.usage_5m, rollups.merge_usage),
    "node_connections": ("user_conn_5m", rollups.user_conn_5m, rollups.merge_conn),
    "sub_requests": ("sub_req_5m", rollups.sub_req_5m, rollups.merge_sub),
}

# Columns that single values are looked up by and that the sort keys do not begin with.
FOUND_BY = {
    "user_usage": ("user_id",),
    "sub_requests": ("ip",),
    "node_connections": ("user_id", "ip"),
    "usage_5m": ("user_id",),
}

Batch = tuple[str, str]  # partition value as in the folder's name, batch id


def partition_value(table: str):
    _, ts, kind, _, _ = LAYOUT[table]
    if kind == "day":
        return F.to_date(ts).alias("day")
    return F.date_format(ts, "yyyyMM").cast("int").alias("month")


def partition_in(table: str, values: Iterable[str]):
    """Whether a row's partition is one of these, named as their folders are."""
    _, _, kind, _, _ = LAYOUT[table]
    return F.col(kind).isin(*[dt.date.fromisoformat(v) if kind == "day" else int(v) for v in values])


def month_of(value: str) -> str:
    """The rollup's partition that a fact partition goes into."""
    return value.replace("-", "")[:6]


def write_batch(df: DataFrame, root: str, table: str, batch_id: int | str) -> None:
    """Write one batch of rows, replacing an earlier write of the same batch.

    Rows are sorted inside their task on the table's key so that Parquet
    row-group statistics can skip; nothing is shuffled. Partitions in which the
    batch was swallowed by a replacement hold its rows already and stay as they are.
    """
    schema, _, kind, keys, _ = LAYOUT[table]
    rows = df.select(*schema.names, partition_value(table), F.lit(str(batch_id)).alias("batch_id"))
    if held := swallowed(df.sparkSession, root, table, batch_id):
        rows = rows.filter(~partition_in(table, held))
    writer = rows.sortWithinPartitions(kind, *keys).write.mode("overwrite")
    for column in FOUND_BY.get(table, ()):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    (
        writer.option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy(kind, "batch_id")
        .parquet(f"{root}/{table}")
    )


def rebalanced(df: DataFrame, table: str) -> DataFrame:
    """Rows gathered by partition value; AQE then splits a busy month or day by
    size and merges small ones, so neither giant nor tiny files appear."""
    _, _, kind, _, _ = LAYOUT[table]
    return df.withColumn(kind, partition_value(table)).hint("rebalance", kind)


def write_rebalanced(df: DataFrame, root: str, table: str, batch_id: int | str) -> None:
    """``write_batch`` into files of even size, for loads of history."""
    write_batch(rebalanced(df, table), root, table, batch_id)


def stored_schema(table: str) -> T.StructType:
    """Columns as stored; those that old files lack have a default, which the scan fills in,
    so that filters on them still reach Parquet."""
    schema, _, kind, _, _ = LAYOUT[table]
    fields = []
    for field in schema:
        late = field.name in LATE.get(table, ())
        empty = "''" if isinstance(field.dataType, T.StringType) else "0"
        default = {"EXISTS_DEFAULT": empty, "CURRENT_DEFAULT": empty} if late else None
        fields.append(T.StructField(field.name, field.dataType, True, default))
    partition = T.StructField(kind, T.DateType() if kind == "day" else T.IntegerType())
    return T.StructType([*fields, partition, T.StructField("batch_id", T.StringType())])


def _stored(spark: SparkSession, root: str, table: str, batch_id: int | str | None = None) -> DataFrame:
    """All batches, seen or not, or one, for which only its own folders are listed."""
    schema = stored_schema(table)
    path = f"{root}/{table}" + ("" if batch_id is None else f"/*/batch_id={batch_id}")
    try:
        return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, table: str, batch_id: int | str | None = None) -> DataFrame:
    """The rows of a table, or of one batch; columns an old batch lacks read as empty values."""
    hidden, replaced = _skipped(spark, root, table)
    rows = _stored(spark, root, table, batch_id)
    if hidden:
        rows = rows.filter(~F.col("batch_id").isin(*hidden))
    if replaced:
        rows = rows.filter(~_in_batches(table, replaced))
    return rows.drop("batch_id")


def _in_batches(table: str, batches: Collection[Batch]):
    _, _, kind, _, _ = LAYOUT[table]
    name = F.concat_ws("/", F.col(kind).cast("string"), F.col("batch_id"))
    return name.isin(*[f"{value}/{batch}" for value, batch in batches])


# --- replacing batches ---------------------------------------------------------


def _log(root: str, table: str) -> str:
    return f"{root}/_log/{table}"


def _done(spark: SparkSession, root: str, table: str) -> dict[str, dict]:
    """Committed replacements whose old files may still be there: new batch id -> what was logged."""
    log = _log(root, table)
    names = [n for n in files.children(spark, log) if n.endswith(".done")]
    return {n.removesuffix(".done"): json.loads(files.read_text(spark, f"{log}/{n}")) for n in names}


def _entries(spark: SparkSession, root: str, table: str) -> dict[str, list[Batch] | None]:
    """Open replacements: new batch id -> batches it replaces, None while it is being written."""
    names = files.children(spark, _log(root, table))
    found: dict[str, list[Batch] | None] = {n.removesuffix(".writing"): None for n in names if n.endswith(".writing")}
    for name, logged in _done(spark, root, table).items():
        found[name] = [tuple(b) for b in logged["old"]]
    return found


# Ids of micro-batches: the query's own id and a number that only grows.
_NUMBERED = re.compile(r"([0-9a-f]{32})-(\d+)")
# Ids that replacements give themselves; nobody writes them twice.
_OWN = re.compile(r"r[0-9a-f]{32}")


@dataclass
class Ledger:
    """``held``: partition -> query -> highest number swallowed, or id of another batch -> 0.
    ``built``: fact partition -> mark of the files that the rollup was last built from."""

    held: dict[str, dict[str, int]] = field(default_factory=dict)
    built: dict[str, str] = field(default_factory=dict)

    def take(self, logged: dict) -> None:
        for value, batch in [*logged["old"], *logged.get("read", ())]:
            if _OWN.fullmatch(batch):
                continue
            numbered = _NUMBERED.fullmatch(batch)
            name, number = (numbered[1], int(numbered[2])) if numbered else (f"={batch}", 0)
            own = self.held.setdefault(value, {})
            own[name] = max(own.get(name, 0), number)
        self.built |= logged.get("built", {})

    def holds(self, value: str, batch: str) -> bool:
        own, numbered = self.held.get(value, {}), _NUMBERED.fullmatch(batch)
        return numbered[1] in own and int(numbered[2]) <= own[numbered[1]] if numbered else f"={batch}" in own


def _ledgers(spark: SparkSession, root: str, table: str) -> list[str]:
    return [n for n in files.children(spark, _log(root, table)) if re.fullmatch(r"ledger-\d+\.json", n)]


def read_ledger(spark: SparkSession, root: str, table: str) -> Ledger:
    """What replacements swallowed, those included that are committed and not yet cleaned up."""
    done = _done(spark, root, table)  # first: what is cleaned up meanwhile is in the ledger by then
    ledger = Ledger()
    if names := _ledgers(spark, root, table):
        ledger = Ledger(**json.loads(files.read_text(spark, f"{_log(root, table)}/{names[-1]}")))
    for logged in done.values():
        ledger.take(logged)
    return ledger


def _write_ledger(spark: SparkSession, root: str, table: str, ledger: Ledger) -> None:
    """A new version; the one before is kept for who is reading it."""
    log, names = _log(root, table), _ledgers(spark, root, table)
    number = int(names[-1][7:-5]) + 1 if names else 0
    files.write_text(spark, f"{log}/ledger-{number:012d}.json", json.dumps(vars(ledger)))
    for name in names[:-1]:
        files.delete(spark, f"{log}/{name}")


def swallowed(spark: SparkSession, root: str, table: str, batch_id: int | str) -> list[str]:
    """Partitions in which a replacement holds the rows of this batch."""
    ledger = read_ledger(spark, root, table)
    return sorted(value for value in ledger.held if ledger.holds(value, str(batch_id)))


def _skipped(spark: SparkSession, root: str, table: str) -> tuple[list[str], list[Batch]]:
    entries = _entries(spark, root, table)
    return [n for n, old in entries.items() if old is None], [b for old in entries.values() for b in old or ()]


def batches(spark: SparkSession, root: str, table: str) -> list[Batch]:
    """Partition value and id of every batch that readers see."""
    _, _, kind, _, _ = LAYOUT[table]
    hidden, replaced = _skipped(spark, root, table)
    replaced = set(replaced)
    found = []
    for folder in files.children(spark, f"{root}/{table}"):
        if folder.startswith(f"{kind}="):
            for batch in files.children(spark, f"{root}/{table}/{folder}"):
                pair = (folder.split("=", 1)[1], batch.removeprefix("batch_id="))
                if batch.startswith("batch_id=") and pair[1] not in hidden and pair not in replaced:
                    found.append(pair)
    return found


def recover(spark: SparkSession, root: str, table: str) -> None:
    """Finish replacements that were committed, undo those that were not."""
    _, _, kind, _, _ = LAYOUT[table]
    log, done = _log(root, table), _done(spark, root, table)
    if done:
        _write_ledger(spark, root, table, read_ledger(spark, root, table))
    for new, old in _entries(spark, root, table).items():
        if old is None:
            for folder in files.children(spark, f"{root}/{table}"):
                files.delete(spark, f"{root}/{table}/{folder}/batch_id={new}")
        for value, batch in old or ():
            files.delete(spark, f"{root}/{table}/{kind}={value}/batch_id={batch}")
        files.delete(spark, f"{log}/{new}.writing")
        files.delete(spark, f"{log}/{new}.done")


def replace(
    spark: SparkSession,
    root: str,
    table: str,
    old: Sequence[Batch],
    build: Callable[[DataFrame], DataFrame | None],
    *,
    clean: bool = True,
    read: Sequence[Batch] = (),
    built: dict[str, str] | None = None,
) -> str:
    """Replace the batches ``old`` by one that ``build`` makes of their rows (None: by nothing).

    Other batches whose rows the new one holds are named in ``read``, the files
    that it was built from in ``built``, for the ledger. ``clean=False`` leaves the old files, unseen, to the next ``recover``, for
    readers that still work on them.
    """
    log, new = _log(root, table), f"r{uuid.uuid4().hex}"
    files.write_text(spark, f"{log}/{new}.writing", "")
    rows = _stored(spark, root, table)
    rows = rows.filter(_in_batches(table, old)) if old else rows.limit(0)
    made = build(rows.drop("batch_id"))
    if made is not None:
        write_batch(made, root, table, new)
    files.write_text(spark, f"{log}/{new}.done", json.dumps({"old": old, "read": read, "built": built or {}}))
    if clean:
        recover(spark, root, table)
    return new


def clustered(df: DataFrame, table: str) -> DataFrame:
    """Rows in ranges of the partition and the sort key, so that files hold few accounts and an
    account few files; AQE merges small ranges."""
    _, _, kind, keys, _ = LAYOUT[table]
    return df.withColumn(kind, partition_value(table)).repartitionByRange(kind, *keys)


def compact(spark: SparkSession, root: str, table: str, values: Collection[str] | None = None) -> list[str]:
    """Merge the batches of a table, per partition value, into one; returns the values rewritten.

    Rollup partials merge into one row per key; then, as facts, they are
    clustered on the sort key. A partition that is one batch already is left alone.
    """
    recover(spark, root, table)
    merges = {rollup: merge for rollup, _, merge in ROLLUP_OF.values()}
    seen = batches(spark, root, table)
    times = Counter(value for value, _ in seen)
    many = sorted(v for v, n in times.items() if n > 1 and (values is None or v in values))
    if not many:
        return []
    rollup = ROLLUP_OF[table][0] if table in ROLLUP_OF else None
    current = built_from(spark, root, table) if rollup else []  # before, as their rows stay the same
    old = [b for b in seen if b[0] in set(many)]
    replace(spark, root, table, old, lambda rows: clustered(merges[table](rows) if table in merges else rows, table))
    if current:
        ledger, marks = read_ledger(spark, root, rollup), _marks(_files(spark, root, table))
        ledger.built |= {value: marks[value] for value in current if value in many}
        _write_ledger(spark, root, rollup, ledger)
    return many


def _files(spark: SparkSession, root: str, table: str) -> dict[Batch, list[str]]:
    """The files of every batch that readers see, listed by Spark."""
    _, _, kind, _, _ = LAYOUT[table]
    hidden, replaced = _skipped(spark, root, table)
    replaced, found = set(replaced), {}
    for path in _stored(spark, root, table).inputFiles():
        value, batch, name = path.rsplit("/", 3)[1:]
        key = value.removeprefix(f"{kind}="), batch.removeprefix("batch_id=")
        if key[1] not in hidden and key not in replaced:
            found.setdefault(key, []).append(name)
    return found


def _marks(found: dict[Batch, list[str]]) -> dict[str, str]:
    """A mark of the files of each partition; every write gives its files names of their own."""
    names: dict[str, list[str]] = {}
    for (value, batch), own in found.items():
        names.setdefault(value, []).extend(f"{batch}/{name}" for name in own)
    return {value: hashlib.sha256("\n".join(sorted(own)).encode()).hexdigest() for value, own in names.items()}


def built_from(spark: SparkSession, root: str, table: str) -> list[str]:
    """The partitions of a fact table from whose present files the rollup was last built."""
    built = read_ledger(spark, root, ROLLUP_OF[table][0]).built
    return sorted(value for value, mark in _marks(_files(spark, root, table)).items() if built.get(value) == mark)


def backfill(spark: SparkSession, root: str, table: str, months: Collection[str] | None = None) -> list[str]:
    """Rebuild the rollup of a fact table from its raw facts, in place; returns the months rebuilt.

    By default these are the months whose facts changed since the last call
    (all at first); only their partitions are read, and the rollup of other months stays.
    Rollup rows before the first raw fact stay as they are: raw facts are
    dropped earlier than rollups. Run it while the table's ingest is stopped; a
    batch that the ingest then replays is not added a second time.
    The aggregate has already spread the rows by bucket and account and AQE has
    sized its partitions, so they are written as they are.
    """
    rollup, partial, _ = ROLLUP_OF[table]
    _, ts, _, _, _ = LAYOUT[table]
    recover(spark, root, table)
    recover(spark, root, rollup)
    found = _files(spark, root, table)
    marks, built = _marks(found), read_ledger(spark, root, rollup).built
    if months is None:
        months = {month_of(value) for value, mark in marks.items() if built.get(value) != mark}
    months = sorted(set(months) & {month_of(value) for value in marks})
    if not months:
        return []
    values = [value for value in marks if month_of(value) in months]
    taken = [b for b in found if b[0] in set(values)]
    facts = read_table(spark, root, table).filter(partition_in(table, values))
    rebuilt = partial(facts)
    first = min(map(month_of, marks))
    start = None
    if first in months:
        own = facts.filter(partition_in(table, [v for v in values if month_of(v) == first]))
        start = own.agg(F.min(ts)).first()[0]
        start = start and start - (start - dt.datetime(1970, 1, 1)) % dt.timedelta(minutes=5)

    def build(rows: DataFrame) -> DataFrame:
        if start is None:
            return rebuilt
        kept = rows.filter(partition_in(rollup, [first]) & (F.col("ts5") < moment(start)))
        return rebuilt.unionByName(kept.drop("month"))

    replace(
        spark, root, rollup, [b for b in batches(spark, root, rollup) if b[0] in months], build,
        read=[(month_of(value), batch) for value, batch in taken], built={value: marks[value] for value in values},
    )
    return months


# --- retention -----------------------------------------------------------------


def retain(df: DataFrame, ts: str, days: int, now) -> DataFrame:
    """Rows not older than ``days`` before ``now``, pruning partitions too."""
    cutoff = moment(now) - F.make_dt_interval(F.lit(int(days)))
    out = df.filter(F.col(ts) >= cutoff)
    if "month" in df.columns:
        out = out.filter(F.col("month") >= F.date_format(cutoff, "yyyyMM").cast("int"))
    if "day" in df.columns:
        out = out.filter(F.col("day") >= F.to_date(cutoff))
    return out


def apply_retention(spark: SparkSession, root: str, table: str, now, days: int | None = None) -> None:
    """Drop expired partitions and rewrite only the one the cutoff falls into."""
    _, ts, kind, _, kept_days = LAYOUT[table]
    now = now if isinstance(now, dt.datetime) else dt.datetime.fromisoformat(str(now))
    days = kept_days if days is None else days
    cutoff = now - dt.timedelta(days=days)
    edge = f"{cutoff:%Y-%m-%d}" if kind == "day" else f"{cutoff:%Y%m}"
    recover(spark, root, table)
    seen = batches(spark, root, table)
    if expired := [b for b in seen if b[0] < edge]:
        replace(spark, root, table, expired, lambda rows: None)
    if cut := [b for b in seen if b[0] == edge]:
        outdated = read_table(spark, root, table).filter(F.col(kind).cast("string") == edge)
        if not outdated.filter(F.col(ts) < moment(cutoff)).isEmpty():
            replace(spark, root, table, cut, lambda rows: rebalanced(retain(rows, ts, days, now), table))
