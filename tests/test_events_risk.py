import json

import pytest
from pyspark.sql import functions as F

from sensorloom.compressor import COMPRESSOR, INCIDENTS
from sensorloom.functions import gates, risk
from sensorloom.functions.scalars import finite_or
from sensorloom.sources import events as ev
from sensorloom.streaming import pipeline


def event(**changes):
    base = {
        "event_id": "r-1", "raw_index": 1, "event_time": "2020-04-18 00:00:00", "ingest_time": "2026-06-06 12:00:00",
        "source": "replay", "operating_state": "loaded", "is_failure_window": 1, "failure_type": "leak",
        **{n: 1.0 for n in COMPRESSOR.names},
        "tp2": 5.8, "tp3": 7.2, "reservoirs": 7.9, "oil_temperature": 64.3, "motor_current": 8.1,
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v != "GONE"}


def payloads(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")


@pytest.mark.parametrize(
    "payload,errors",
    [
        (event(), []),
        (event(event_time="GONE"), ["missing_required_field:event_time"]),
        (event(event_time=None), ["missing_required_field:event_time", "invalid_event_time_format"]),
        (event(event_time="2020-04-18"), ["invalid_event_time_format"]),
        (event(event_time="2020-02-31 00:00:00"), ["invalid_event_time_format"]),
        (event(dv_electric="GONE"), ["missing_required_field:dv_electric"]),
        (event(motor_current="not-a-number"), ["non_numeric_sensor:motor_current"]),
        (event(motor_current="7.1"), ["non_numeric_sensor:motor_current"]),
        (event(lps=True), ["non_numeric_sensor:lps"]),
        (event(lps=1), []),
        (event(is_failure_window=2), ["invalid_is_failure_window"]),
        (event(operating_state="idle"), ["invalid_operating_state"]),
        (event(operating_state=None), ["missing_required_field:operating_state", "invalid_operating_state"]),
        ('{"event_id": "r-bad", "raw_index": 1, ', ["invalid_json"]),
        ("[1, 2]", ["payload_not_json_object"]),
    ],
)
def test_contract(spark, payload, errors):
    row = ev.validate_contract(payloads(spark, payload), COMPRESSOR).first()
    assert row["errors"] == errors
    assert row["status"] == ("invalid" if errors else "valid")


def test_contract_summary(spark):
    checked = ev.validate_contract(payloads(spark, event(), event(tp2="x"), "{"), COMPRESSOR)
    assert ev.contract_summary(checked).first().asDict() == {"total": 3, "invalid": 2, "valid": 1}


def reasons(spark, rules, *texts):
    gate = pipeline.gated(ev.decode_events(payloads(spark, *texts), COMPRESSOR), rules(COMPRESSOR))
    return [r["reason"] for r in gate.select("reason").collect()]


def test_gates_report_the_first_broken_rule(spark):
    texts = [
        event(), event(event_id=None), event(raw_index=None), event(event_time="bad"), event(ingest_time=None),
        event(operating_state=None), event(operating_state="idle"), event(is_failure_window=None),
        event(is_failure_window=7), event(failure_type=None), event(h1=None), event(h1="x"), "{",
    ]
    missing = "missing_required_business_field"
    parse = "missing_event_id_or_parse_error"
    assert reasons(spark, gates.basic_rules, *texts) == [
        None, parse, "missing_raw_index", "missing_event_time", None, "missing_operating_state", None, None, None, None,
        missing, missing, parse,
    ]
    assert reasons(spark, gates.strict_rules, *texts) == [
        None, parse, "missing_raw_index", "missing_event_time", "missing_ingest_time", "missing_operating_state",
        "invalid_operating_state", "missing_is_failure_window", "invalid_is_failure_window", "missing_failure_type",
        missing, missing, parse,
    ]


def test_dead_letter_shape_keeps_raw_text(spark):
    gate = pipeline.gated(ev.decode_events(payloads(spark, event(event_id=None), "{cut"), COMPRESSOR), gates.basic_rules(COMPRESSOR))
    rows = pipeline.rejected(gate, COMPRESSOR).collect()
    assert rows[0]["payload"] == "source=replay,state=loaded,failure_type=leak"
    assert rows[1]["payload"] == "source=null,state=null,failure_type=null" and rows[1]["raw_text"] == "{cut"


def test_decode_parses_each_payload_once(spark):
    gate = pipeline.gated(ev.decode_events(payloads(spark, event()), COMPRESSOR), gates.strict_rules(COMPRESSOR))
    plan = pipeline.accepted(gate)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def python_score(e):
    def clip(x):
        return max(0.0, min(1.0, x))

    delta, gap = abs(e["tp3"] - e["reservoirs"]), abs(e["tp2"] - e["tp3"])
    digital = sum(e[n] for n in COMPRESSOR.digital) / 8
    parts = [clip((delta + gap * 0.05) / 2), clip((e["oil_temperature"] - 55) / 20), clip((e["motor_current"] - 6.5) / 4), clip(digital)]
    return clip(0.12 + sum(w * p for w, p in zip((0.36, 0.28, 0.18, 0.06), parts)))


def test_scores_levels_and_reasons(spark):
    samples = [
        event(),
        event(tp2=-0.01, tp3=9.33, reservoirs=9.33, oil_temperature=53.5, motor_current=0.04),
        event(tp2=9.0, tp3=9.0, reservoirs=9.0, oil_temperature=60.0, motor_current=7.5),
        event(tp3=100.0, oil_temperature=500.0, motor_current=99.0),
    ]
    valid = pipeline.accepted(pipeline.gated(ev.decode_events(payloads(spark, *samples), COMPRESSOR), gates.strict_rules(COMPRESSOR)))
    rows = pipeline.scored(valid, COMPRESSOR).collect()
    for sample, row in zip(samples, rows):
        assert row["risk_score"] == pytest.approx(python_score(sample), abs=1e-6)
    assert rows[0]["risk_reason"] == "pressure_balance_shift,oil_temperature_elevated,motor_current_elevated"
    assert rows[1]["risk_reason"] == "pressure_balance_shift"  # only the gap of discharge and panel
    assert rows[2]["risk_reason"] == "baseline_signal_level"
    assert [r["risk_level"] for r in rows] == ["high" if s >= 0.5636003790254064 else "medium" if s >= 0.4 else "low" for s in map(python_score, samples)]
    assert rows[0]["feature_window_minutes"] == "1,5,15,60" and rows[0]["dt"] == "2020-04-18"


def test_given_score_is_clipped_and_passed_through(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 0.3), (2, None, -1.0), (3, float("nan"), None)], "i int, risk_score double, model_score double"
    ).withColumns({n: F.lit(1.0) for n in COMPRESSOR.names})
    value, why, source = risk.passthrough(F.col("risk_score"), F.col("model_score"))
    rows = df.orderBy("i").select(value.alias("v"), why.alias("w"), source.alias("s")).collect()
    assert (rows[0]["v"], rows[0]["w"], rows[0]["s"]) == (1.0, ["passed_through_existing_risk_score"], "provided_risk_score")
    assert (rows[1]["v"], rows[1]["s"]) == (0.0, "model_score")
    assert rows[2]["s"] == "signal_rules" and rows[2]["w"] == ["baseline_signal_level"]


def test_finite_or(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("-Infinity",), (None,)], "v string")
    assert [r[0] for r in df.select(finite_or(F.col("v"), 9.0)).collect()] == [1.5, 9.0, 9.0, 9.0, 9.0]


def test_encode_then_decode_is_lossless(spark):
    rows = spark.createDataFrame(
        [(i, f"2020-04-18 0{i}:00:00", *[0.1 * i + j for j in range(14)], float("nan")) for i in range(5)],
        "raw_index long, event_time string, " + ", ".join(f"{n} double" for n in COMPRESSOR.names),
    ).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    made = ev.event_columns(rows, COMPRESSOR, INCIDENTS, "r", "test", F.lit("2026-01-01").cast("timestamp_ntz"))
    back = ev.decode_events(ev.encode_events(made), COMPRESSOR).orderBy("raw_index").collect()
    assert [r["event_id"] for r in back] == [f"r-{i}" for i in range(5)]
    assert all(r["caudal_impulses"] == 0.0 and r["is_failure_window"] == 1 for r in back)
    assert back[3]["tp3"] == pytest.approx(1.3) and back[3]["_corrupt"] is None
