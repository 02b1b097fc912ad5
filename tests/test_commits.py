"""The commit log of stream outputs: whole batches, repeats, pruning by day, bounded folders."""

import pytest
from pyspark.sql import functions as F

from sensorloom.compressor import COMPRESSOR
from sensorloom.functions import gates
from sensorloom.sources import events as ev
from sensorloom.streaming import jobs, pipeline
from sensorloom.streaming.commits import Change, Commits
from sensorloom.streaming.stores import Files
from tests.test_events_risk import event
from tests.test_tables_streams import put

SCHEMA = "v int, dt string"


def rows(spark, *values):
    return spark.createDataFrame([(v, f"2024-01-0{1 + v % 3}") for v in values], SCHEMA)


def held(spark, log, **kw):
    return sorted(r["v"] for r in log.read(spark, "t", rows(spark, 1).schema, **kw).collect())


def test_a_batch_counts_when_it_is_committed_and_once(spark, tmp_path):
    log = Commits(str(tmp_path / "c"))
    assert held(spark, log) == []
    log.write(rows(spark, 1, 2), "t", 0, "dt")  # an attempt that stopped
    assert held(spark, log) == []
    log.commit(spark, 0, [Change("t", log.write(rows(spark, 1, 2), "t", 0, "dt"))])
    log.commit(spark, 1, [Change("t", log.write(rows(spark, 3), "t", 1, "dt"))])
    assert held(spark, log) == [1, 2, 3]
    seen = log.read(spark, "t", rows(spark, 1).schema)
    again = log.write(rows(spark, 3, 4), "t", 1, "dt")
    assert held(spark, log) == [1, 2, 3]  # while the batch is repeated
    log.commit(spark, 1, [Change("t", again)])
    assert held(spark, log) == [1, 2, 3, 4]
    assert sorted(r["v"] for r in seen.collect()) == [1, 2, 3]  # a reader that began before
    assert held(spark, log, before=1) == [1, 2]


def test_days_are_pruned_and_replaced(spark, tmp_path):
    log = Commits(str(tmp_path / "c"))
    for batch in range(3):
        log.commit(spark, batch, [Change("t", log.write(rows(spark, *range(10 * batch, 10 * batch + 3)), "t", batch, "dt"))])
    files = log.read(spark, "t", rows(spark, 1).schema, ["2024-01-02"]).inputFiles()
    assert files and all("_day=2024-01-02" in f for f in files)
    log.commit(spark, 3, [Change("t", log.write(rows(spark, 90), "t", 3, "dt"), replace=True)])
    assert held(spark, log, days=["2024-01-01"]) == [90]
    assert len(held(spark, log)) == 7


def test_compaction_bounds_folders_and_records(spark, tmp_path):
    log = Commits(str(tmp_path / "c"))
    for batch in range(7):
        log.commit(spark, batch, [Change("t", log.write(rows(spark, batch), "t", batch, "dt")), Change("u", log.write(rows(spark, batch), "u", batch))])
    before = held(spark, log)
    early = log.read(spark, "t", rows(spark, 1).schema)
    log.compact(spark, 6, most=1)
    assert held(spark, log) == before == sorted(r["v"] for r in early.collect())
    assert len(Files(spark, f"{log.base}/_commits").names()) < 4 + 1
    assert held(spark, log, before=6) == [0, 1, 2, 3, 4, 5]
    log.commit(spark, 6, [Change("t", log.write(rows(spark, 60), "t", 6, "dt"))])  # the last batch once more
    assert held(spark, log) == [0, 1, 2, 3, 4, 5, 60]
    removed = log.clean(spark, older_than_seconds=-5)
    assert removed >= 6 and held(spark, log) == [0, 1, 2, 3, 4, 5, 60]
    assert len(Files(spark, f"{log.base}/t").names()) == 4


def test_a_stop_before_the_snapshot_loses_nothing(spark, tmp_path, monkeypatch):
    log = Commits(str(tmp_path / "c"))
    for batch in range(4):
        log.commit(spark, batch, [Change("t", log.write(rows(spark, batch), "t", batch, "dt"))])

    def stop(self, name):
        raise InterruptedError(name)

    for method in ("put", "remove"):
        with monkeypatch.context() as m:
            m.setattr(Files, method, stop if method == "remove" else lambda self, name, text: stop(self, name))
            with pytest.raises(InterruptedError):
                log.compact(spark, 4, most=1)
        assert held(spark, log) == [0, 1, 2, 3]
    log.compact(spark, 4, most=1)
    assert held(spark, log) == [0, 1, 2, 3]


def batch_of(spark, folder, name, *events):
    put(folder, name, *events)
    return spark.read.text(str(folder / name))


def test_deduplication_reads_only_the_days_of_the_batch(spark, tmp_path):
    sink = jobs.FirstSeen(COMPRESSOR, str(tmp_path / "out"))
    accepted = lambda df: pipeline.accepted(pipeline.gated(ev.decode_events(df, COMPRESSOR), gates.strict_rules(COMPRESSOR)))
    for k, day in enumerate(["2020-02-01", "2020-02-02", "2020-02-03"]):
        sink.handle(accepted(batch_of(spark, tmp_path / "in", f"{k}.json", *[event(event_id=f"{day}-{i}", event_time=f"{day} 00:00:0{i}") for i in range(3)])), k)
    late = accepted(batch_of(spark, tmp_path / "in", "9.json", event(event_id="2020-02-02-1", event_time="2020-02-02 00:00:01"), event(event_id="new", event_time="2020-02-02 00:00:01")))
    found = jobs.first_seen(pipeline.readings_with_day(late, COMPRESSOR), sink.log, "rows", "dt", 3)
    assert [r["event_id"] for r in found.collect()] == ["new"]
    files = [f for f in found.inputFiles() if "/out/" in f]
    assert files and all("_day=2020-02-02" in f for f in files)


def test_minute_kpi_has_one_folder_a_day_after_any_number_of_batches(spark, tmp_path):
    job = jobs.MinuteKpi(COMPRESSOR, str(tmp_path / "kpi"), compact_every=3)
    accepted = lambda df: pipeline.accepted(pipeline.gated(ev.decode_events(df, COMPRESSOR), gates.strict_rules(COMPRESSOR)))
    batches = [batch_of(spark, tmp_path / "in", f"{k}.json", event(event_id=f"{k}", event_time=f"2020-02-0{1 + k % 2} 00:00:0{k}")) for k in range(7)]
    for k, batch in enumerate(batches):
        job.handle(accepted(batch), k)
        job.handle(accepted(batch), k)  # repeated at once
    assert {r["minute_bucket"]: r["sample_count"] for r in job.read(spark).collect()} == {"2020-02-01 00:00:00": 4, "2020-02-02 00:00:00": 3}
    assert len(job.log.folders(spark, "partials")) == 2
    assert sorted(r["batch"] for r in job.late(spark).collect()) == list(range(7))


def test_all_outputs_of_a_batch_appear_together(spark, tmp_path):
    job = jobs.FanOut(COMPRESSOR, gates.strict_rules(COMPRESSOR), str(tmp_path / "out"), compact_every=2)
    seen = {}

    class Watching(Commits):
        def write(self, rows, output, batch_id, day=None):
            out = super().write(rows, output, batch_id, day)
            seen[batch_id, output] = {n: job.read(spark, n).count() for n in ("dead_letters", "readings", "kpi_partials", "risk_events")}
            return out

    class Watched(jobs.FanOut):
        log = property(lambda self: Watching(self.base))

    watched = Watched(COMPRESSOR, gates.strict_rules(COMPRESSOR), str(tmp_path / "out"), compact_every=2)
    for k in range(4):
        watched.handle(batch_of(spark, tmp_path / "in", f"{k}.json", event(event_id=f"e{k}", event_time=f"2020-04-18 00:0{k}:00"), "{cut"), k)
    for (k, _), counts in seen.items():
        assert set(counts.values()) == {k}
    assert job.read(spark, "readings").count() == 4 and job.read(spark, "dead_letters").agg(F.count("*")).first()[0] == 4


def test_a_day_is_not_written_by_every_task(spark, tmp_path):
    """Rows of all days lie in all tasks; files grow with the rows of a day and not with tasks times days."""
    days = spark.range(20_000).selectExpr("concat('e', id) AS event_id", "timestamp_ntz '2024-01-01 01:00:00' + make_dt_interval(id % 4) AS event_time")
    sink = jobs.FirstSeen(COMPRESSOR, str(tmp_path / "out"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sink.handle(days.repartition(8), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [list((tmp_path / "out" / f).glob("*.parquet")) for d in sink.log.state(spark)["rows"].values() for f in d]
    assert len(files) == 4 and all(len(f) == 1 for f in files)
    assert sink.read(spark, days.schema).count() == 20_000
