"""Calendars as tables next to literal ones and next to plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.adapters import EVENTS, OVERLAPPING
from sensorloom.functions import intervals
from sensorloom.operators import calendars, features, labels, ordered
from sensorloom.operators.ordered import Order

T0 = datetime(2024, 1, 1)
CAL = "interval_id long, unit string, start timestamp_ntz, end timestamp_ntz, interval_type string"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def loop(t, unit, incidents, pick=max, horizons=(1, 6, 24)):
    mine = [i for i in incidents if i[1] == unit and i[2] <= i[3]]
    over = [i for i in mine if i[2] <= t <= i[3]]
    flags = [int(bool(over))] + [int(any(i[2] - timedelta(hours=h) <= t < i[2] for i in mine)) for h in horizons]
    flags.append(int(any(i[3] < t <= i[3] + timedelta(hours=24) for i in mine)))
    later = [i[2] for i in mine if i[2] > t]
    rul = 0.0 if over else (min(later) - t).total_seconds() if later else None
    return (*flags, pick(over)[4] if over else "normal", rul)


@pytest.mark.parametrize("on_overlap,pick", [("last", max), ("first", min)])
def test_labels_equal_a_loop(spark, on_overlap, pick):
    rng = random.Random(11)
    incidents = []
    for k in range(160):
        s = rng.randrange(30_000)
        incidents.append((k, rng.choice("aab"), at(s), at(s + rng.choice([0, 1, 30, 400, -5])), rng.choice(["x", "y", "z"])))
    incidents.append((900, "a", at(0), at(30_000), "whole"))
    rows = [(k, rng.choice("aabc"), at(rng.randrange(-100, 33_000))) for k in range(9_000)] + [(k, "a", at(50)) for k in range(9_000, 9_300)] + [(9_400, "a", None)]
    df = spark.createDataFrame(rows, "id long, unit string, event_time timestamp_ntz")
    cal = spark.createDataFrame([*incidents, (901, "a", None, at(3), "n")], CAL)
    got = calendars.labels_by_table(df, cal, Order("event_time", "id", ("unit",)), on_overlap=on_overlap)
    assert set(df.columns) < set(got.columns) and not [c for c in got.columns if c.startswith("_")]
    names = ["failure_window", "pre_failure_1h", "pre_failure_6h", "pre_failure_24h", "post_maintenance", "failure_type", "rul_seconds"]
    found = {r["id"]: tuple(r[n] for n in names) for r in got.collect()}
    assert len(found) == len(rows)
    for k, unit, t in rows:
        assert found[k] == (loop(t, unit, incidents, pick) if t else (0, 0, 0, 0, 0, "normal", None)), (k, unit, t)


def test_table_equals_the_literal_calendar(spark):
    rows = [(k, T0 + timedelta(minutes=7 * k, microseconds=k % 3)) for k in range(2_500)]
    rows += [(10_000 + k, t) for k, t in enumerate(x for i in OVERLAPPING.intervals for e in (i.start, i.end) for x in (e, e - timedelta(microseconds=1), e + timedelta(microseconds=1)))]
    df = spark.createDataFrame(rows, "raw_index long, event_time timestamp_ntz")
    table = spark.createDataFrame([(i.id, i.start, i.end, i.type) for i in OVERLAPPING.intervals], "interval_id long, start timestamp_ntz, end timestamp_ntz, interval_type string")
    one, two = (features.horizon_labels(df, EVENTS, c) for c in (OVERLAPPING, table))
    assert sorted(one.columns) == sorted(two.columns)
    assert one.exceptAll(two.select(one.columns)).count() == 0 and one.count() == two.count()
    first = calendars.labels_by_table(df, table, Order("event_time", "raw_index"), on_overlap="first").select("raw_index", "failure_type")
    want = df.select("raw_index", intervals.interval_type(F.col("event_time"), OVERLAPPING, "first").alias("failure_type"))
    assert want.exceptAll(first).count() == 0


def test_empty_calendar_and_empty_rows(spark):
    df = spark.createDataFrame([(1, T0)], "raw_index long, event_time timestamp_ntz")
    cal = spark.createDataFrame([], "interval_id long, start timestamp_ntz, end timestamp_ntz, interval_type string")
    row = features.horizon_labels(df, EVENTS, cal).first()
    assert (row["failure_window"], row["normal_candidate"], row["failure_type"], row["rul_seconds"]) == (0, 1, "normal", None)
    assert features.horizon_labels(df.limit(0), EVENTS, cal).count() == 0


def test_lead_time_equals_a_loop(spark):
    rng = random.Random(12)
    incidents = [(k, rng.choice("ab"), at(rng.randrange(9_000)), at(9_500), "x") for k in range(80)]
    rows = [(rng.choice("ab"), at(rng.randrange(500, 8_500)), int(rng.random() < 0.02)) for _ in range(4_000)]
    rows += [(i[1], i[2] - timedelta(hours=24), 1) for i in incidents[:5]] + [(i[1], i[2], 1) for i in incidents[5:9]]
    df = spark.createDataFrame(rows, "unit string, event_time timestamp_ntz, alarm int")
    got = calendars.lead_time_by_table(df, spark.createDataFrame(incidents, CAL), "event_time", "alarm", ("unit",)).collect()
    want = {}
    for k, unit, s, _, _ in incidents:
        times = [t for u, t, _ in rows if u == unit]
        if min(times) <= s <= max(times):
            alarms = [t for u, t, a in rows if u == unit and a and s - timedelta(hours=24) <= t < s]
            want[k] = (min(alarms), (s - min(alarms)).total_seconds() / 3600) if alarms else (None, None)
    assert {r["interval_id"]: (r["first_alarm"], r["lead_time_hours"]) for r in got} == {k: (t, pytest.approx(h) if h else h) for k, (t, h) in want.items()}
    assert all(r["detected"] == (r["first_alarm"] is not None) for r in got)


def test_running_maximum_leaves_no_helper_columns(spark):
    cal = spark.createDataFrame([(1, "a", at(0), at(9), "x"), (2, "a", at(5), at(6), "y"), (3, "a", at(20), at(21), "z")], CAL)
    out = labels.with_overlap_flag(cal, ("unit",))
    assert out.columns == [*cal.columns, "overlaps_earlier"]
    assert {r["interval_id"]: r["overlaps_earlier"] for r in out.collect()} == {1: 0, 2: 1, 3: 0}


@pytest.mark.parametrize("on_overlap,pick", [("last", max), ("first", min)])
@pytest.mark.parametrize("keyed", [True, False])
def test_incidents_over_many_slices(spark, monkeypatch, on_overlap, pick, keyed):
    """Slices that an incident covers whole have no end of it; a row of a null key meets no incident of a key."""
    monkeypatch.setattr(calendars, "SLICE_ROWS", 150)
    rng = random.Random(13)
    incidents = [(k, rng.choice("aab"), at(s := rng.randrange(3_000)), at(s + rng.choice([2, 40, 900, 2_500])), rng.choice("xyz")) for k in range(60)]
    rows = [(k, rng.choice("aaab"), at(rng.randrange(-100, 6_000))) for k in range(3_000)] + [(k, "a", at(700)) for k in range(3_000, 3_400)]
    df = spark.createDataFrame([*rows, (9_000, None, at(700))], "id long, unit string, event_time timestamp_ntz")
    cal = spark.createDataFrame([*incidents, (99, None, at(0), at(3_000), "n")] if keyed else incidents, CAL)
    got = calendars.labels_by_table(df, cal if keyed else cal.drop("unit"), Order("event_time", "id", ("unit",)), on_overlap=on_overlap)
    found = {r["id"]: (r["failure_window"], r["pre_failure_1h"], r["pre_failure_6h"], r["pre_failure_24h"], r["post_maintenance"], r["failure_type"], r["rul_seconds"]) for r in got.collect()}
    for k, unit, t in [*rows, (9_000, None, at(700))]:
        known = incidents if keyed else [(i[0], unit, *i[2:]) for i in incidents]
        assert found[k] == loop(t, unit, known, pick), (k, unit, t)


def test_stored_rows_are_readings_and_two_per_incident(spark, monkeypatch):
    """Neither borders nor blocks multiply the calendar: long incidents that all overlap are stored as they are."""
    made, real = {}, calendars.stored

    def counted(df, name):
        made[name] = made.get(name, 0) + (out := real(df, name)).count()
        return out

    monkeypatch.setattr(calendars, "stored", counted)
    monkeypatch.setattr(ordered, "stored", counted)
    cal = spark.createDataFrame([(k, "a", at(k), at(5_000 + k), "x") for k in range(300)], CAL)
    df = spark.createDataFrame([(k, "a", at(20 * k)) for k in range(400)], "id long, unit string, event_time timestamp_ntz")
    assert calendars.labels_by_table(df, cal, Order("event_time", "id", ("unit",))).count() == 400
    assert made["calendar"] == 300 and made["ordered"] == 1_000
    assert sum(made.values()) <= 1_300 + 10, made


def test_rows_are_shuffled_once_and_written_narrow(spark, monkeypatch):
    """A slice is settled where the exchange delivers it; no sort column is written, nor what an incident is beside both its ends."""
    made, real = {}, calendars.stored
    monkeypatch.setattr(calendars, "stored", lambda df, name: made.setdefault(name, real(df, name)))
    monkeypatch.setattr(ordered, "stored", calendars.stored)
    cal = spark.createDataFrame([(k, "a", at(7 * k), at(7 * k + 5), "x") for k in range(300)], CAL)
    df = spark.createDataFrame([(k, "a", at(5 * k)) for k in range(400)], "id long, unit string, event_time timestamp_ntz")
    out = calendars.labels_by_table(df, cal, Order("event_time", "id", ("unit",)))
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    assert not {"_pos", "_key", "_tie", "_last", "_rank"} & set(made["ordered"].columns)
    ends = made["ordered"].where("_side is not null")
    slices = made["ordered"].select("_slice").distinct().count()
    assert ends.count() == 600 and ends.where("_s is not null").count() <= 2 * (slices - 1)


@pytest.mark.parametrize("on_overlap,pick", [("last", max), ("first", min)])
def test_incidents_that_repeat_and_slices_without_ends(spark, monkeypatch, on_overlap, pick):
    monkeypatch.setattr(calendars, "SLICE_ROWS", 60)
    incidents = [(k // 3, "a", at(50 * (k // 3)), at(50 * (k // 3) + 900 * (k // 3 % 2) + 20), "xyz"[k // 3 % 3]) for k in range(60)]
    rows = [(k, "ab"[k % 2], at(4 * k - 50)) for k in range(800)]
    df = spark.createDataFrame(rows, "id long, unit string, event_time timestamp_ntz")
    got = calendars.labels_by_table(df, spark.createDataFrame(incidents, CAL), Order("event_time", "id", ("unit",)), on_overlap=on_overlap)
    names = ["failure_window", "pre_failure_1h", "pre_failure_6h", "pre_failure_24h", "post_maintenance", "failure_type", "rul_seconds"]
    found = {r["id"]: tuple(r[n] for n in names) for r in got.collect()}
    for k, unit, t in rows:
        assert found[k] == loop(t, unit, incidents, pick), (k, unit, t)
