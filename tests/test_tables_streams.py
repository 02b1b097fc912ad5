import itertools
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sensorloom.compressor import COMPRESSOR
from sensorloom.functions import gates
from sensorloom.operators import analysis, kpi, quality, reconcile, reshape
from sensorloom.plans import warehouse
from sensorloom.sources import events as ev
from sensorloom.sources import readings as src
from sensorloom.sources import sinks
from sensorloom.spec import SensorSpec
from sensorloom.streaming import jobs, pipeline, stores
from tests.test_events_risk import event
from tests.test_labels_features import CAL, compressor_rows

NOW = jobs.Trigger(available_now=True)


def write_csv(tmp_path, header, rows):
    names = ["", "timestamp", "TP2", "TP3", "H1", "DV_pressure", "Reservoirs", "Oil_temperature", "Motor_current", "COMP",
             header, "Towers", "MPG", "LPS", "Pressure_switch", "Oil_level", "Caudal_impulses"]
    lines = [",".join(names)] + [",".join([str(i), t, *[v] * 15]) for i, (t, v) in enumerate(rows)]
    path = tmp_path / f"{header}.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_to_layers_keeps_every_row(spark, tmp_path):
    rows = [("2024-01-02 01:00:00", "1.0"), ("2024-01-02 01:00:10", "bad"), ("broken", "1.0"), ("2024-01-03 02:00:00", "0.0")]
    csv = write_csv(tmp_path, "DV_eletric", rows)
    base = str(tmp_path / "base")
    first = warehouse.build_readings(spark, csv, base, COMPRESSOR, CAL).first()
    assert (first["expected_rows"], first["written_rows"]) == (3, 3)
    report = {r["label"]: r["written_rows"] for r in warehouse.build_layers(spark, base, COMPRESSOR).collect()}
    assert report["sensor_long"] == 45 and report["sensor_kpi"] == 15 and report["overall_kpi"] == 1
    back = src.read_layer(spark, base, "readings")
    assert back.filter(F.col("tp2").isNull()).count() == 1 and "source_file" in back.columns
    plan = back.filter(F.col("dt") == "2024-01-03").select("tp2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    with pytest.raises(ValueError):
        src.read_layer(spark, base, "nope")


def test_projected_csv_reads_only_what_is_asked(spark, tmp_path):
    csv = write_csv(tmp_path, "DV_electric", [("2024-01-02 01:00:10", "1.5"), ("2024-01-02 01:00:00", "0.1")])
    out = src.read_projected_csv(spark, csv, COMPRESSOR, ["event_time", "dv_electric"], single_precision=True, ordered=True)
    assert [round(r["dv_electric"], 3) for r in out.collect()] == [0.1, 1.5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp:string,DV_electric:string>" in plan


def test_verified_write_refuses_a_wrong_count(spark, tmp_path):
    with pytest.raises(RuntimeError, match="5 rows expected"):
        sinks.verified_write(spark.range(4), str(tmp_path / "t"), expected_rows=5)


def test_wide_and_long_sensor_kpi_agree(spark):
    _, df = compressor_rows(spark, 200)
    rows = df.withColumn("is_failure_window", (F.col("raw_index") % 7 == 0).cast("int"))
    wide = kpi.sensor_kpi(rows, COMPRESSOR)
    long = kpi.sensor_kpi_from_long(reshape.with_dimension(reshape.to_long(rows, COMPRESSOR), COMPRESSOR), COMPRESSOR)
    rounded = lambda d: d.select("sensor_name", "station_id", "sample_count", *[F.round(c, 9) for c in ("avg_sensor_value", "std_sensor_value", "failure_window_rate")])
    assert rounded(wide).exceptAll(rounded(long)).count() == 0 and wide.count() == 15


def test_weighted_rollup_null_weights(spark):
    df = spark.createDataFrame([(1, 2.0, 3, 0), (1, None, 5, 0), (2, 1.0, 0, 0)], "k int, avg_x double, sample_count long, failure_sample_count long")
    kept = {r["k"]: r["avg_x"] for r in kpi.weighted_rollup(df, ["k"], ["avg_x"]).collect()}
    skipped = {r["k"]: r["avg_x"] for r in kpi.weighted_rollup(df, ["k"], ["avg_x"], skip_null_weight=True).collect()}
    assert kept == {1: 6 / 8, 2: None} and skipped == {1: 2.0, 2: None}


def test_verdicts_take_the_worst(spark):
    for statuses, overall in ((["PASS"], "PASS"), (["PASS", "WARN"], "PASS_WITH_WARNINGS"), (["WARN", "FAIL"], "FAIL")):
        df = spark.createDataFrame([(str(i), s) for i, s in enumerate(statuses)], "item string, status string")
        rows = {r["item"]: r["status"] for r in reconcile.with_overall(df, "item").collect()}
        assert rows["overall"] == overall


def test_attention_fills_up_by_deviation(spark):
    contrast = spark.createDataFrame([("a", 1, 2.0)], "sensor_name string, contrast_rank int, avg_delta_failure_minus_normal double")
    stats = spark.createDataFrame([("a", 0.1), ("b", 3.0), ("c", None), ("d", 9.0)], "sensor_name string, std_sensor_value double")
    rows = analysis.attention_sensors(contrast, stats).orderBy("attention_rank").collect()
    assert [r["sensor_name"] for r in rows] == ["a", "d", "b"]
    assert rows[0]["reason"] == "failure-window mean shift 2.000000; std 0.100000"


def test_daily_outliers_truncates_the_median(spark):
    spec = replace(COMPRESSOR)
    days = [("d1", 10), ("d2", 11), ("d3", 7), ("d4", 13)]  # median 10.5 -> 10, band 8..12
    df = spark.createDataFrame([(d,) for d, n in days for _ in range(n)], "dt string")
    assert isinstance(spec, SensorSpec)
    assert {r["dt"] for r in quality.daily_outliers(df, spec).collect()} == {"d3", "d4"}


def test_published_tables_and_views(spark, tmp_path):
    _, df = compressor_rows(spark, 50)
    from sensorloom.operators.normalize import with_interval_label, with_state, with_time_columns

    rows = with_interval_label(with_state(with_time_columns(df, COMPRESSOR), COMPRESSOR), COMPRESSOR, CAL)
    tables = {"w": (kpi.window_kpi(rows, COMPRESSOR), ["dt"]), "s": (kpi.sensor_kpi(rows, COMPRESSOR), [])}
    gate = warehouse.publish_tables(spark, tables, "pub_test", str(tmp_path / "db"))
    assert {r["status"] for r in gate.collect()} == {"PASS"}
    warehouse.realtime_placeholder(spark, "pub_test", "rt", pipeline.KPI_AVERAGES)
    names = {"window": "pub_test.v_w", "sensor": "pub_test.v_s", "realtime": "pub_test.v_rt"}
    sources = {"window": "pub_test.w", "sensor": "pub_test.s", "realtime": "pub_test.rt"}
    warehouse.create_views(spark, sources, pipeline.KPI_AVERAGES, names, bucket_type="TIMESTAMP_NTZ", temporary=False)
    assert spark.table("pub_test.v_s").count() == 15 and spark.table("pub_test.v_rt").count() == 0
    assert dict(spark.table("pub_test.v_w").dtypes)["sample_count"] == "bigint"


_written = itertools.count()


def put(folder, name, *events):
    folder.mkdir(exist_ok=True)
    file = folder / name
    file.write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
    at = 1_700_000_000 + next(_written)  # a file source takes files by their time, and those of one millisecond in any order
    os.utime(file, (at, at))


def test_fan_out_resumes_and_repeats_without_duplicates(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1.json", event(event_id="a", raw_index=1), event(event_id=None), "{cut")
    state = stores.ParquetStore(str(tmp_path / "state"), ["equipment_id"], ["event_time", "raw_index"])
    job = jobs.FanOut(COMPRESSOR, gates.strict_rules(COMPRESSOR), str(tmp_path / "out"), risk_state=state)
    checkpoint = str(tmp_path / "cp")
    job.start(ev.text_source(spark, str(inbox)), checkpoint, NOW).awaitTermination()
    put(inbox, "2.json", event(event_id="b", raw_index=2, event_time="2020-04-18 00:00:30"))
    job.start(ev.text_source(spark, str(inbox)), checkpoint, NOW).awaitTermination()
    # a batch that is delivered again replaces its own output
    job.handle(spark.read.text(str(inbox / "2.json")), 1)
    assert job.read(spark, "readings").count() == 2
    assert {r["dt"] for r in job.read(spark, "risk_events").collect()} == {"2020-04-18"}
    assert job.read(spark, "dead_letters").count() == 2
    merged = jobs.merge_kpi(job.read(spark, "kpi_partials"), COMPRESSOR).collect()
    assert len(merged) == 1 and merged[0]["sample_count"] == 2 and merged[0]["failure_window_rate"] == 1.0
    assert state.read(spark).first()["event_id"] == "b"


def test_failing_cache_does_not_stop_the_stream(spark, tmp_path):
    class Broken:
        def write(self, latest, batch_id):
            raise ConnectionError("down")

    inbox = tmp_path / "in"
    put(inbox, "1.json", event())
    job = jobs.FanOut(COMPRESSOR, gates.strict_rules(COMPRESSOR), str(tmp_path / "out"), Broken(), Broken())
    job.start(ev.text_source(spark, str(inbox)), str(tmp_path / "cp"), NOW).awaitTermination()
    assert job.read(spark, "risk_events").count() == 1


def test_state_expires(spark, tmp_path):
    store = stores.ParquetStore(str(tmp_path / "s"), ["k"], ["t"], ttl_seconds=60)
    rows = spark.createDataFrame([("old", 1, "2024-01-01 00:00:00"), ("new", 1, "2024-01-01 00:01:30")], "k string, t int, at string")
    store.write(rows, 0)
    kept = store.read(spark, F.lit("2024-01-01 00:02:00").cast("timestamp"), "at").collect()
    assert [r["k"] for r in kept] == ["new"]


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    store = stores.ParquetStore(str(tmp_path / "s"), ["k"], ["t"])
    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 5)]]):
        store.write(spark.createDataFrame(rows, "k string, t int"), batch)
    before = sorted(map(tuple, store.read(spark).collect()))
    store.compact(spark, 1)
    assert sorted(map(tuple, store.read(spark).collect())) == before == [("a", 2), ("b", 1), ("c", 5)]
    assert spark.read.parquet(store.path).count() == 3


def test_stream_watermark_drops_late_rows_and_dedups(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1.json", event(event_id="a", event_time="2020-04-18 00:00:10"), event(event_id="b", event_time="2020-04-18 00:05:00"))
    events = ev.decode_events(ev.text_source(spark, str(inbox)), COMPRESSOR)
    valid = pipeline.accepted(pipeline.gated(events, gates.strict_rules(COMPRESSOR)))
    out, checkpoint = str(tmp_path / "kpi"), str(tmp_path / "cp")

    def run():
        jobs.append_parquet(pipeline.minute_kpi(valid, COMPRESSOR, "event_time"), out, checkpoint, trigger=NOW).awaitTermination()

    run()
    put(inbox, "2.json", event(event_id="late", event_time="2020-04-18 00:00:20"), event(event_id="c", event_time="2020-04-18 00:09:00"))
    run()
    got = {r["minute_bucket"]: r["sample_count"] for r in spark.read.parquet(out).collect()}
    assert got == {"2020-04-18 00:00:00": 1, "2020-04-18 00:05:00": 1}
    twice = str(tmp_path / "twice")
    put(tmp_path / "in2", "1.json", event(event_id="a"), event(event_id="a"), event(event_id="b"))
    events = ev.decode_events(ev.text_source(spark, str(tmp_path / "in2")), COMPRESSOR)
    unique = pipeline.deduplicated(pipeline.accepted(pipeline.gated(events, gates.strict_rules(COMPRESSOR))), COMPRESSOR)
    jobs.append_parquet(unique, twice, str(tmp_path / "cp2"), trigger=NOW).awaitTermination()
    assert spark.read.parquet(twice).count() == 2


def valid_events(spark, folder):
    return pipeline.accepted(pipeline.gated(ev.decode_events(ev.text_source(spark, str(folder), 1), COMPRESSOR), gates.strict_rules(COMPRESSOR)))


def test_late_events_count_and_are_counted(spark, tmp_path):
    inbox = tmp_path / "in"
    times = ["2020-04-18 00:05:00", "2020-04-18 00:00:10", "2020-04-18 00:05:30.250", "2020-04-17 23:59:59"]
    for i, t in enumerate(times):
        put(inbox, f"{i}.json", event(event_id=f"e{i}", event_time=t))
    job = jobs.MinuteKpi(COMPRESSOR, str(tmp_path / "kpi"))
    jobs.each_batch(valid_events(spark, inbox), job.handle, str(tmp_path / "cp"), trigger=NOW).awaitTermination()
    got = {r["minute_bucket"]: r["sample_count"] for r in job.read(spark).collect()}
    assert got == {"2020-04-17 23:59:00": 1, "2020-04-18 00:00:00": 1, "2020-04-18 00:05:00": 2}
    assert sum(r["late_rows"] for r in job.late(spark).collect()) == 2


def test_first_seen_keeps_an_id_once_over_batches_and_replays(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1.json", event(event_id="a"), event(event_id="a"), event(event_id="b"))
    put(inbox, "2.json", event(event_id="b"), event(event_id="old", event_time="2020-02-01 00:00:00.5"))
    put(inbox, "3.json", event(event_id="a"))
    rows = valid_events(spark, inbox)
    sink = jobs.FirstSeen(COMPRESSOR, str(tmp_path / "out"))
    jobs.each_batch(rows, sink.handle, str(tmp_path / "cp"), trigger=NOW).awaitTermination()
    assert sorted(r["event_id"] for r in sink.read(spark, rows.schema).collect()) == ["a", "b", "old"]
    again = pipeline.accepted(pipeline.gated(ev.decode_events(spark.read.text(str(inbox / "1.json")), COMPRESSOR), gates.strict_rules(COMPRESSOR)))
    sink.handle(again, 0)
    assert sorted(r["event_id"] for r in sink.read(spark, rows.schema).collect()) == ["a", "b", "old"]


def test_kpi_cache_over_batches_and_rejected_only_output(spark, tmp_path):
    inbox = tmp_path / "in"
    for i in range(4):
        put(inbox, f"{i}.json", event(event_id=f"e{i}", raw_index=i, event_time=f"2020-04-18 00:00:{10 * i:02d}"), event(event_id="e0", raw_index=0, event_time="2020-04-18 00:00:00"))
    cache = stores.ParquetStore(str(tmp_path / "kpi"), ["window_start", "operating_state"], ["sample_count"], compact_every=2)
    job = jobs.FanOut(COMPRESSOR, gates.strict_rules(COMPRESSOR), str(tmp_path / "out"), cache)
    job.start(ev.text_source(spark, str(inbox), 1), str(tmp_path / "cp"), NOW).awaitTermination()
    assert [r["sample_count"] for r in cache.read(spark).collect()] == [4]
    put(tmp_path / "bad", "1.json", "{cut")
    empty = jobs.FanOut(COMPRESSOR, gates.strict_rules(COMPRESSOR), str(tmp_path / "none"))
    empty.start(ev.text_source(spark, str(tmp_path / "bad")), str(tmp_path / "cp2"), NOW).awaitTermination()
    assert empty.read(spark, "readings").count() == 0 and empty.read(spark, "dead_letters").count() == 1


def test_compaction_stopped_anywhere_loses_nothing(spark, tmp_path, monkeypatch):
    store = stores.ParquetStore(str(tmp_path / "s"), ["k"], ["t"], ttl_seconds=60, written_at="at", compact_every=None)
    now = F.lit("2024-01-01 00:02:00").cast("timestamp")
    for batch in range(4):
        store.write(spark.createDataFrame([("a", batch, "2024-01-01 00:01:30"), (f"k{batch}", batch, "2024-01-01 00:00:00")], "k string, t int, at string"), batch)

    def stop(self, name):
        raise InterruptedError(name)

    monkeypatch.setattr(stores.Files, "remove", stop)
    with pytest.raises(InterruptedError):
        store.compact(spark, 2, now)
    assert [tuple(r) for r in store.read(spark, now).collect()] == [("a", 3, "2024-01-01 00:01:30")]
    monkeypatch.undo()
    store.compact(spark, 3, now)
    assert spark.read.parquet(store.path).count() == 1
    assert [tuple(r) for r in store.read(spark, now).collect()] == [("a", 3, "2024-01-01 00:01:30")]


def test_reload_of_a_day_and_of_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i % 3}") for i in range(30)], "v int, dt string")
    assert sinks.verified_write(rows, path, ["dt"]).first()["written_rows"] == 30
    day = rows.filter("dt = '2024-01-02'").limit(4)
    assert sinks.verified_write(day, path, ["dt"]).first()["written_rows"] == 4
    assert spark.read.parquet(path).count() == 24
    assert sinks.verified_write(day, path, ["dt"], whole_table=True).first()["written_rows"] == 4
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(RuntimeError):
        sinks.verified_write(rows.limit(0), path, ["dt"], conserve=False)
