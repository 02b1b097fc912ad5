from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.compressor import COMPRESSOR, INCIDENTS
from sensorloom.functions import intervals
from sensorloom.operators import features
from sensorloom.operators.labels import interval_calendar
from sensorloom.operators.normalize import normalize, quarantine, standardise_columns, with_state
from sensorloom.spec import Calendar


def times(spark, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))


CAL = Calendar.of([("2024-01-02 00:00:00", "2024-01-02 06:00:00", "a_high"), ("2024-01-05 00:00:00", "2024-01-05 01:00:00", "b")])


def test_calendar_text_and_severity():
    cal = Calendar.from_text("2020-04-18 00:00:00|2020-04-18 23:59:59|air_leak_high; 2020-07-15 14:30:00|2020-07-15 19:00:00|x")
    assert [i.severity for i in cal.intervals] == ["high_stress", "unknown"]
    assert len(INCIDENTS.intervals) == 4
    for bad in ("2020-01-01|2020-01-02", "2020-01-01|2020-01-02|", "soon|2020-01-02|x"):
        with pytest.raises(ValueError):
            Calendar.from_text(bad)


def test_interval_borders(spark):
    df = times(
        spark,
        "2024-01-01 00:00:00",  # exactly 24 h before
        "2024-01-01 23:59:59",
        "2024-01-02 00:00:00",
        "2024-01-02 06:00:00",
        "2024-01-02 06:00:01",
        "2024-01-03 06:00:00",
        "2024-01-03 06:00:01",
        "2024-01-06 01:00:01",
    )
    spec = COMPRESSOR
    out = features.horizon_labels(df.withColumnRenamed("t", spec.time), spec, CAL).orderBy("id").collect()
    assert [r["failure_window"] for r in out] == [0, 0, 1, 1, 0, 0, 0, 0]
    assert [r["pre_failure_24h"] for r in out] == [1, 1, 0, 0, 0, 0, 0, 0]
    assert [r["pre_failure_1h"] for r in out] == [0, 1, 0, 0, 0, 0, 0, 0]
    assert [r["post_maintenance"] for r in out] == [0, 0, 0, 0, 1, 1, 0, 0]
    assert [r["normal_candidate"] for r in out] == [0, 0, 0, 0, 0, 0, 1, 1]
    assert [r["rul_seconds"] for r in out] == [86400.0, 1.0, 0.0, 0.0, 237599.0, 151200.0, 151199.0, None]
    assert out[2]["failure_type"] == "a_high" and out[7]["failure_type"] == "normal"


def test_overlap_choice_and_unsorted_calendar(spark):
    cal = Calendar.of([("2024-01-03 00:00:00", "2024-01-04 00:00:00", "late"), ("2024-01-01 00:00:00", "2024-01-05 00:00:00", "wide")])
    df = times(spark, "2024-01-03 12:00:00", "2023-12-31 00:00:00")
    t = F.col("t")
    row = df.select(
        intervals.interval_type(t, cal).alias("last"),
        intervals.interval_type(t, cal, "first").alias("first"),
        intervals.seconds_to_start(t, cal).alias("wait"),
    ).collect()
    assert (row[0]["last"], row[0]["first"]) == ("wide", "late")
    assert row[1]["wait"] == 86400.0  # nearest start, whatever the listing order


def test_state_of_missing_current(spark):
    df = spark.createDataFrame([(1, 7.0), (2, 1.0), (3, 0.5), (4, None), (5, float("nan"))], "id int, motor_current double")
    got = [r["operating_state"] for r in with_state(df, COMPRESSOR).orderBy("id").collect()]
    assert got == ["loaded", "unloaded", "stopped", "stopped", "stopped"]


def raw(spark, header="DV_eletric", time="2024-01-02 01:00:00"):
    names = ["_c0", "timestamp", "TP2", "TP3", "H1", "DV_pressure", "Reservoirs", "Oil_temperature", "Motor_current", "COMP",
             header, "Towers", "MPG", "LPS", "Pressure_switch", "Oil_level", "Caudal_impulses"]
    return spark.createDataFrame([("5", time, *["1.5"] * 15)], ", ".join(f"`{n}` string" for n in names))


@pytest.mark.parametrize("header", ["DV_eletric", "DV_electric"])
def test_both_header_spellings(spark, header):
    row = normalize(raw(spark, header), COMPRESSOR, CAL).first()
    assert row["raw_index"] == 5 and row["dv_electric"] == 1.5 and row["is_failure_window"] == 1
    assert row["operating_state"] == "unloaded" and row["dt"] == "2024-01-02"
    assert row["event_time"] == datetime(2024, 1, 2, 1)


def test_missing_column_raises_and_bad_time_is_quarantined(spark):
    with pytest.raises(ValueError, match="tp2"):
        standardise_columns(raw(spark).drop("TP2"), COMPRESSOR)
    bad = raw(spark, time="yesterday")
    assert normalize(bad, COMPRESSOR, CAL).count() == 0
    assert quarantine(bad, COMPRESSOR).first()["reason"] == "unparsable_time"


def test_row_id_without_index_is_reproducible(spark):
    df = raw(spark).drop("_c0")
    assert normalize(df, COMPRESSOR, CAL).first()["raw_index"] == normalize(df, COMPRESSOR, CAL).first()["raw_index"]


def test_interval_calendar_issues(spark):
    rows = [
        (1, "2024-01-01 00:00:00|2024-01-02 00:00:00|leak_high"),
        (2, "2024-01-01 00:00:00|leak"),
        (3, "x|2024-01-02 00:00:00|leak"),
        (4, "2024-01-01 00:00:00|y|"),
        (5, "2024-01-03 00:00:00|2024-01-02 00:00:00|leak"),
    ]
    df = spark.createDataFrame(rows, "n int, line string")
    got = {r["n"]: r for r in interval_calendar(df, "line", "n").collect()}
    assert got[1]["issues"] == [] and got[1]["severity"] == "high_stress"
    assert got[2]["issues"] == ["not_three_parts"]
    assert got[3]["issues"] == ["bad_start"]
    assert got[4]["issues"] == ["bad_end", "empty_type"]
    assert got[5]["issues"] == ["end_before_start"]


def compressor_rows(spark, rows=400, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({n: rng.normal(5, 3, rows) if n in COMPRESSOR.analog else rng.integers(0, 2, rows).astype(float) for n in COMPRESSOR.names})
    pdf["raw_index"] = np.arange(rows)
    pdf["event_time"] = pd.Timestamp("2024-01-01 20:00:00") + pd.to_timedelta(np.sort(rng.integers(0, 7200, rows)), unit="s")
    return pdf, spark.createDataFrame(pdf).withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).repartition(4)


def test_full_feature_table_against_pandas(spark, monkeypatch):
    from sensorloom.operators import ordered

    monkeypatch.setattr(ordered, "PARTITIONS", 12)
    pdf, df = compressor_rows(spark)
    got = features.feature_table(df, COMPRESSOR, CAL)
    assert len(got.columns) == 507
    assert len(features.model_feature_names(COMPRESSOR, got.columns)) == 221
    got = got.toPandas().sort_values("event_minute").reset_index(drop=True)
    pdf = pdf.sort_values(["event_time", "raw_index"]).reset_index(drop=True)
    pdf["m"] = pdf["event_time"].dt.floor("min")
    state = np.select([pdf["motor_current"] >= 7, pdf["motor_current"] >= 1], ["loaded", "unloaded"], "stopped")
    pdf["flag"] = (pd.Series(state) != pd.Series(state).shift(1)).astype(int)
    pdf["tog"] = pdf["lps"].diff().abs().fillna(0)
    want = pdf.groupby("m").agg(
        n=("tp2", "size"), mean=("tp2", "mean"), std=("tp2", "std"), first=("tp2", "first"), last=("tp2", "last"),
        tr=("flag", "sum"), tog=("tog", "sum"),
    ).reset_index()
    for column, name in [("sample_count", "n"), ("mean_tp2", "mean"), ("std_tp2", "std"), ("first_tp2", "first"),
                         ("last_tp2", "last"), ("state_transition_count", "tr"), ("toggle_count_lps", "tog")]:
        np.testing.assert_allclose(got[column].astype(float), want[name], rtol=1e-9, err_msg=column)
    roll = want["mean"].rolling(15, min_periods=1)
    np.testing.assert_allclose(got["roll15_std_mean_tp2"], roll.std().fillna(0), atol=1e-9)
    np.testing.assert_allclose(got["roll15_q25_mean_tp2"], roll.quantile(0.25), atol=1e-9)


def test_labels_never_become_features():
    from sensorloom.models.matrix import guard_features

    with pytest.raises(ValueError, match="rul_seconds"):
        guard_features(["mean_tp2", "rul_seconds"])
