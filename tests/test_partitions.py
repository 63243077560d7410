"""Work that must grow in tasks, not in the size of a task."""

from pyspark.sql import functions as F

from accesslens import catalogue, session
from accesslens import fixtures as fx


def test_rollup_shuffles_grow_with_the_events(spark, sf):
    n = fx.events(spark, sf).count()
    with session.setting(spark, "spark.sql.shuffle.partitions", "2"):
        assert catalogue._partitions(spark, sf) == "2"
        assert catalogue._partitions(spark, sf, per=n // 50) == "50"
        seen = []
        real, catalogue._partitions = catalogue._partitions, lambda s, d: seen.append(d) or "9"
        try:
            got = catalogue.rollup_partial_merge(spark, sf)
        finally:
            catalogue._partitions = real
        assert seen == [sf] and spark.conf.get("spark.sql.shuffle.partitions") == "2"
    assert got.agg(F.sum("requests")).first()[0] == 3 * n


def _landed(spark, sf, tmp_path, monkeypatch, query, names):
    """Files per landing folder, and the rows of a query whose events come in four partitions."""
    events = fx.events(spark, sf).repartition(4)
    monkeypatch.setattr(fx, "events", lambda *_: events)
    real, own = session.scratch, ("refreshed", "redelivered")
    monkeypatch.setattr(session, "scratch", lambda s, name: str(tmp_path) if name in own else real(s, name))
    rows = query(spark, sf).collect()
    return [len(list((tmp_path / "landing" / name).glob("part-*"))) for name in names], rows, events.count()


def test_refreshed_networks_lands_in_many_files(spark, sf, tmp_path, monkeypatch):
    files, rows, n = _landed(spark, sf, tmp_path, monkeypatch, catalogue.refreshed_networks, "ab")
    assert files == [4, 4]
    assert sum(r.requests for r in rows) == 2 * n


def test_redelivered_entries_land_in_many_files(spark, sf, tmp_path, monkeypatch):
    files, rows, n = _landed(spark, sf, tmp_path, monkeypatch, catalogue.stream_dedup_two_batches, ["first", "again"])
    assert files == [4, 4]
    batches = {p.name.split("-")[-1] for p in (tmp_path / "out" / "measures").glob("batch_id=*")}
    assert batches == {"0", "1"} and rows


def test_reports_of_the_bands_read_stored_tables(spark, sf):
    read = catalogue.stat_bands(spark, sf).inputFiles()
    assert read and not [path for path in read if "/events.parquet" in path]  # each report built its tables before
