"""What ingest keeps on disk: bounded by a batch, apart from tables, ids and compressed landing files."""

import time

import pytest
from pyspark.sql import functions as F

from accesslens import catalogue, session
from accesslens import fixtures as fx
from accesslens.operators.decode import USAGE_STREAM
from accesslens.sources.entries import read_entry_files
from accesslens.streaming.ingest import start_ingest


@pytest.fixture
def cut(tmp_path, monkeypatch):
    """Lets the queries land small files below ``tmp_path`` and take few of them into a batch."""
    monkeypatch.setattr(catalogue, "_FILE_ENTRIES", 400)
    monkeypatch.setattr(catalogue, "_BATCH_BYTES", 60_000)
    real, own = session.scratch, ("unreadable", "stream-ingest", "stream-quality")
    monkeypatch.setattr(session, "scratch", lambda s, name: f"{tmp_path}/{name}" if name in own else real(s, name))
    return tmp_path


def _shuffles(spark):
    """Names of the shuffle files that exist; the session's tests run on one machine."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {path.rsplit("/", 1)[-1] for path in found.split("\n") if "/shuffle_" in path}


def _left(spark, before):
    """Shuffle files made since; those of the last write go a moment after it."""
    for _ in range(50):
        if not (left := _shuffles(spark) - before):
            return left
        time.sleep(0.1)
    return left


def _batches(root):
    landed = list((root / "landing").glob("part-*"))
    assert len(landed) > 8 and all(path.suffix == ".gz" for path in landed)
    return len(list((root / "out" / "measures").glob("batch_id=*")))


def test_unreadable_entries_come_in_bounded_batches(spark, sf, cut):
    n, before = fx.events(spark, sf).count(), _shuffles(spark)
    query = catalogue.unreadable_entries(spark, sf)
    assert not _left(spark, before)
    assert _batches(cut / "unreadable") > 1
    got = {(r.stream, r.reason): r.n for r in query.collect()}
    assert got["", "unreadable_entry"] == 2 * n and got["other", "unknown_stream"] == n
    assert sum(got.values()) == 6 * n


def test_stream_ingest_is_the_same_in_many_batches(spark, sf, cut, monkeypatch):
    """All events of a day at one moment, so that every batch has partials of the same buckets."""
    events = fx.events(spark, sf).withColumn("ts", F.date_trunc("DAY", "ts"))
    monkeypatch.setattr(fx, "events", lambda *_: events)
    got = sorted(map(tuple, catalogue.stream_ingest(spark, sf).collect()))
    assert _batches(cut / "stream-ingest") > 1
    monkeypatch.setattr(catalogue, "_BATCH_BYTES", 1 << 30)
    monkeypatch.setattr(session, "scratch", lambda _, name: f"{cut}/whole/{name}")
    assert got == sorted(map(tuple, catalogue.stream_ingest(spark, sf).collect()))
    assert _batches(cut / "whole" / "stream-ingest") == 1


def test_stream_quality_adds_up_bounded_batches(spark, sf, cut):
    n, before = fx.events(spark, sf).count(), _shuffles(spark)
    got = catalogue.stream_quality(spark, sf).collect()
    # The write of the network index leaves its one small shuffle.
    assert len({name.split("_")[1] for name in _left(spark, before)}) <= 1
    assert _batches(cut / "stream-quality") > 1
    assert len(got) == 3 and {r.messages for r in got} == {2 * n}


def test_the_checkpoint_keeps_two_batches(spark, sf, tmp_path):
    root = str(tmp_path)
    fx.usage_messages(fx.events(spark, sf)).repartition(5).write.json(f"{root}/landing")
    source = read_entry_files(spark, f"{root}/landing", streaming=True, max_files_per_trigger=1)
    start_ingest(spark, source, USAGE_STREAM, f"{root}/out", f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    kept = {int(path.name) for path in (tmp_path / "checkpoint/user_usage/commits").glob("[0-9]*")}
    assert max(kept) == 4 and {3, 4} <= kept and 0 not in kept
