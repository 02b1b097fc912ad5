"""SQL for DuckDB that states each query's result independently."""

from __future__ import annotations

import re

from sensorloom.operators.evaluate import SINGLE_CLASS_SHARE, sweep_shares

ORACLE: dict[str, str] = {}


def r(expression: str, name: str | None = None, places: int = 6) -> str:
    alias = f" AS {name}" if name else ""
    return f"round(({expression})::DOUBLE, {places}) + 0.0::DOUBLE{alias}"


def add(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + body


# ---- adapters ----------------------------------------------------------------------

INTERVALS = [
    (1, "2024-01-05 00:00:00", "2024-01-05 23:59:59", "leak_a_high"),
    (2, "2024-01-12 23:30:00", "2024-01-13 06:00:00", "leak_b_high"),
    (3, "2024-01-18 10:00:00", "2024-01-20 14:30:00", "leak_c"),
    (4, "2024-01-27 14:30:00", "2024-01-27 19:00:00", "leak_d"),
]
OVERLAPS = [
    (1, "2024-01-05 00:00:00", "2024-01-07 00:00:00", "wide"),
    (2, "2024-01-06 00:00:00", "2024-01-06 12:00:00", "inner"),
    (3, "2024-01-06 10:00:00", "2024-01-09 00:00:00", "late"),
]


def _values(rows) -> str:
    listed = ", ".join(f"({i}, TIMESTAMP '{s}', TIMESTAMP '{e}', '{t}')" for i, s, e, t in rows)
    return f"(VALUES {listed}) AS c(id, s, e, t)"


CAL = f"cal AS (SELECT * FROM {_values(INTERVALS)})"
CAL2 = f"cal AS (SELECT * FROM {_values(OVERLAPS)})"
K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
BARE = f"""bare AS (
  SELECT event_id AS raw_index, ts AS event_time, user_id AS equipment_id, value AS pressure, {K} AS temperature,
         (event_type = 'error')::INT::DOUBLE AS d_error, (event_type = 'click')::INT::DOUBLE AS d_click,
         (event_type = 'view')::INT::DOUBLE AS d_view
  FROM events)"""
STATE = "CASE WHEN pressure >= 70 THEN 'loaded' WHEN pressure >= 15 THEN 'unloaded' ELSE 'stopped' END"
READINGS = f"""readings AS (
  SELECT b.*, date_trunc('hour', event_time)::TIMESTAMP AS event_bucket, strftime(event_time, '%Y-%m-%d') AS dt,
         {STATE} AS operating_state,
         EXISTS (SELECT 1 FROM cal WHERE event_time BETWEEN s AND e)::INT AS is_failure_window,
         coalesce((SELECT max_by(t, id) FROM cal WHERE event_time BETWEEN s AND e), 'normal') AS failure_type,
         pressure - temperature AS delta_pt
  FROM bare b)"""
R3 = (CAL, BARE, READINGS)
SENSORS = ["pressure", "temperature", "d_error", "d_click", "d_view"]
ANALOG = ["pressure", "temperature"]
DIGITAL = ["d_error", "d_click", "d_view"]
SIGNALS = ["pressure", "temperature", "delta_pt"]
DIM = """dim AS (SELECT * FROM (VALUES
  ('pressure', 'analog', 'plant', 'bar'), ('temperature', 'analog', 'plant', 'celsius'),
  ('d_error', 'digital', 'control', 'binary'), ('d_click', 'digital', 'control', 'binary'),
  ('d_view', 'digital', 'control', 'binary')) AS d(sensor_name, sensor_type, station_id, unit))"""
LONG = f"""long AS (
  SELECT * FROM (SELECT * FROM readings) UNPIVOT INCLUDE NULLS (sensor_value FOR sensor_name IN ({', '.join(SENSORS)})))"""
COMP_NAMES = [
    "tp2", "tp3", "h1", "dv_pressure", "reservoirs", "oil_temperature", "motor_current", "comp", "dv_electric",
    "towers", "mpg", "lps", "pressure_switch", "oil_level", "caudal_impulses",
]
COMP = f"""comp AS (
  SELECT event_id AS raw_index, date_trunc('second', ts)::TIMESTAMP AS event_time, value / 10.0 AS tp2,
         8.0 + {K} / 50.0 AS tp3, 8.0::DOUBLE + (event_id % 7)::DOUBLE / 10.0 AS h1,
         (event_id % 5)::DOUBLE / 10.0 - 0.2 AS dv_pressure,
         8.0::DOUBLE + (event_id * 13 % 200)::DOUBLE / 100.0 AS reservoirs,
         50.0 + value / 5.0 AS oil_temperature, value / 10.0 AS motor_current,
         (event_type = 'click')::INT::DOUBLE AS comp, (event_type = 'error')::INT::DOUBLE AS dv_electric,
         (event_type = 'view')::INT::DOUBLE AS towers, (event_id % 2)::DOUBLE AS mpg,
         (event_id % 3 = 0)::INT::DOUBLE AS lps, (user_id % 2)::DOUBLE AS pressure_switch,
         (event_id % 11 = 0)::INT::DOUBLE AS oil_level, (event_type = 'signup')::INT::DOUBLE AS caudal_impulses
  FROM events)"""
CSTATE = "CASE WHEN motor_current >= 7 THEN 'loaded' WHEN motor_current >= 1 THEN 'unloaded' ELSE 'stopped' END"
CEVENTS = f"""cevents AS (
  SELECT 'reading-' || raw_index AS event_id, c.*, TIMESTAMP '2024-02-01' AS ingest_time, 'replay' AS source,
         CASE WHEN raw_index % 89 = 0 THEN 'broken' ELSE {CSTATE} END AS operating_state,
         EXISTS (SELECT 1 FROM cal WHERE event_time BETWEEN s AND e)::INT AS is_failure_window,
         coalesce((SELECT min_by(t, id) FROM cal WHERE event_time BETWEEN s AND e), 'normal') AS failure_type
  FROM comp c)"""
VALID = "valid AS (SELECT * FROM cevents WHERE raw_index % 97 <> 0 AND raw_index % 89 <> 0 AND raw_index % 83 <> 0)"
V4 = (CAL, COMP, CEVENTS, VALID)


def clip(e: str) -> str:
    return f"greatest(0.0, least(1.0, {e}))"


DIGITAL_SUM = " + ".join(COMP_NAMES[7:])
PARTS = f"""parts AS (
  SELECT *, {clip('(abs(tp3 - reservoirs) + abs(tp2 - tp3) * 0.05) / 2.0')} AS pressure_component,
         {clip('(oil_temperature - 55.0) / 20.0')} AS oil_component,
         {clip('(motor_current - 6.5) / 4.0')} AS current_component,
         {clip(f'({DIGITAL_SUM}) / 8.0')} AS digital_component FROM SOURCE)"""
SCORE = clip(
    "0.12 + 0.36 * pressure_component + 0.28 * oil_component + 0.18 * current_component + 0.06 * digital_component"
)
ALARMS = """coalesce(nullif(concat_ws(',',
  CASE WHEN abs(tp3 - reservoirs) > 0.35 OR abs(tp2 - tp3) > 2.0 THEN 'pressure_balance_shift' END,
  CASE WHEN oil_temperature > 60 THEN 'oil_temperature_elevated' END,
  CASE WHEN motor_current > 7.5 THEN 'motor_current_elevated' END), ''), 'baseline_signal_level')"""


def level(e: str) -> str:
    return f"CASE WHEN {e} >= 0.5636003790254064 THEN 'high' WHEN {e} >= 0.40 THEN 'medium' ELSE 'low' END"


RISK = f"""risk AS (
  SELECT *, {r(SCORE)} AS risk_score, {level(r(SCORE))} AS risk_level, {ALARMS} AS risk_reason FROM parts)"""
R5 = (*V4, PARTS.replace("SOURCE", "valid"), RISK)

# ---- sources and sinks -------------------------------------------------------------

add(
    "src_csv",
    """SELECT count(*) AS row_count, count(*) FILTER (raw_index % 89 = 0) AS bad_numbers,
    count(*) FILTER (raw_index % 97 = 0) AS bad_times, sum(raw_index)::BIGINT AS index_sum,
    sum(dv_electric) AS dv_electric_sum FROM comp""",
    COMP,
)
add(
    "src_csv_projected",
    f"""SELECT event_time, raw_index, {r('CASE WHEN raw_index % 89 <> 0 THEN tp2 END', 'tp2')}, dv_electric
    FROM comp WHERE raw_index % 97 <> 0""",
    COMP,
)
add("scan_parquet", "SELECT event_id, ts, value FROM events WHERE value >= 100.0")
add(
    "sink_partitioned_roundtrip",
    f"""SELECT raw_index, event_time, {r("pressure + (dt = '2024-01-05')::INT", 'pressure')}, dt, operating_state
    FROM readings""",
    *R3,
)
add(
    "verified_write",
    f"""SELECT label, n::BIGINT AS expected_rows, n::BIGINT AS written_rows, 'PASS' AS status FROM (
      SELECT 'readings' AS label, count(*) AS n FROM readings
      UNION ALL SELECT 'sensor_long', count(*) * {len(SENSORS)} FROM readings
      UNION ALL SELECT 'overall_kpi', 1
      UNION ALL SELECT 'window_kpi', count(DISTINCT (event_bucket, operating_state)) FROM readings
      UNION ALL SELECT 'sensor_kpi', {len(SENSORS)})""",
    *R3,
)
add(
    "publish_tables",
    f"""SELECT table_name, n::BIGINT AS row_count, 'PASS' AS status FROM (
      SELECT 'readings' AS table_name, count(*) AS n FROM readings
      UNION ALL SELECT 'sensor_long', count(*) * {len(SENSORS)} FROM readings
      UNION ALL SELECT 'overall_kpi', 1
      UNION ALL SELECT 'window_kpi', count(DISTINCT (event_bucket, operating_state)) FROM readings
      UNION ALL SELECT 'sensor_kpi', {len(SENSORS)} UNION ALL SELECT 'realtime_kpi', 0)""",
    *R3,
)
add(
    "table_gate",
    """SELECT 'events' AS table_name, count(*) AS row_count, 'PASS' AS status FROM events
    UNION ALL SELECT 'orders', count(*), 'PASS' FROM orders
    UNION ALL SELECT 'lineitem', count(*), 'PASS' FROM lineitem
    UNION ALL SELECT 'nothing', 0, 'FAIL' UNION ALL SELECT 'may_be_empty', 0, 'PASS'""",
)
RATE = "sum(is_failure_window) / count(*)"
COUNTS = "count(*) AS sample_count, sum(is_failure_window)::BIGINT AS failure_sample_count"
KPI = f"""kpi AS (
  SELECT event_bucket, dt, operating_state, {COUNTS}, {RATE} AS failure_window_rate,
    {', '.join(f'avg({c}) AS avg_{c}, stddev_samp({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}' for c in ANALOG)},
    {', '.join(f'sum({c}) AS active_count_{c}' for c in DIGITAL)},
    strftime(event_bucket, '%Y-%m-%d %H:%M:00') AS minute_bucket
  FROM readings GROUP BY ALL)"""
SENSOR_KPI = f"""sensor_kpi AS (
  SELECT sensor_name, sensor_type, station_id, unit, {COUNTS}, avg(sensor_value) AS avg_sensor_value,
    stddev_samp(sensor_value) AS std_sensor_value, min(sensor_value) AS min_sensor_value,
    max(sensor_value) AS max_sensor_value, {RATE} AS failure_window_rate
  FROM long JOIN dim USING (sensor_name) GROUP BY sensor_name, sensor_type, station_id, unit)"""
add(
    "view_window_kpi",
    f"""SELECT minute_bucket, event_bucket, operating_state, sample_count, failure_sample_count,
    {r('failure_window_rate', 'failure_window_rate')}, {r('avg_pressure', 'avg_pressure')},
    {r('avg_temperature', 'avg_temperature')}, dt FROM kpi""",
    *R3,
    KPI,
)
S_COLS = ", ".join(
    r(c, c)
    for c in ("failure_window_rate", "avg_sensor_value", "std_sensor_value", "min_sensor_value", "max_sensor_value")
)
S5 = (*R3, LONG, DIM, SENSOR_KPI)
add(
    "view_sensor_kpi",
    f"SELECT sensor_name, sensor_type, station_id, unit, sample_count, failure_sample_count, {S_COLS} FROM sensor_kpi",
    *S5,
)
WINDOW_STATE = f"""window_state AS (
  SELECT dt, operating_state, count(*) AS minute_count, sum(sample_count)::BIGINT AS sample_count,
    sum(failure_sample_count)::BIGINT AS failure_sample_count,
    {r('avg(failure_window_rate)', 'avg_failure_window_rate')}, {r('avg(avg_pressure)', 'avg_pressure')},
    {r('avg(avg_temperature)', 'avg_temperature')}
  FROM kpi GROUP BY dt, operating_state)"""
add("sink_tsv", "SELECT * FROM window_state", *R3, KPI, WINDOW_STATE)
add(
    "encode_events",
    f"""SELECT 'reading-' || raw_index AS key, 'reading-' || raw_index AS event_id,
    strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, '2024-02-01 00:00:00' AS ingest_time, 'replay' AS source,
    {CSTATE} AS operating_state, failure_type, raw_index::DOUBLE AS raw_index,
    is_failure_window::DOUBLE AS is_failure_window, {r('tp2', 'tp2')}, {r('oil_temperature', 'oil_temperature')}, lps
    FROM cevents""",
    CAL,
    COMP,
    CEVENTS,
)
add(
    "latest_state",
    """SELECT 'risk:latest:' || operating_state AS state_key, max(event_time) AS event_time,
    max_by(raw_index, (event_time, raw_index)) AS raw_index, max_by(event_id, (event_time, raw_index)) AS event_id,
    max_by(risk_score, (event_time, raw_index)) AS risk_score,
    max_by(risk_level, (event_time, raw_index)) AS risk_level FROM risk GROUP BY operating_state""",
    *R5,
)

# ---- projections -------------------------------------------------------------------

BROKEN = f"""broken AS (
  SELECT * REPLACE (CASE WHEN raw_index % 89 <> 0 THEN tp2 END AS tp2,
                    CASE WHEN raw_index % 83 = 0 THEN 'NaN'::DOUBLE ELSE motor_current END AS motor_current)
  FROM comp WHERE raw_index % 97 <> 0)"""
add(
    "normalize",
    f"""SELECT raw_index, event_time, {', '.join(r(c, c) for c in COMP_NAMES if c != 'motor_current')},
    CASE WHEN isnan(motor_current) THEN motor_current ELSE {r('motor_current')} END AS motor_current,
    date_trunc('minute', event_time)::TIMESTAMP AS event_minute, strftime(event_time, '%Y-%m-%d') AS dt,
    EXISTS (SELECT 1 FROM cal WHERE event_time BETWEEN s AND e)::INT AS is_failure_window,
    coalesce((SELECT max_by(t, id) FROM cal WHERE event_time BETWEEN s AND e), 'normal') AS failure_type,
    CASE WHEN isnan(motor_current) THEN 'stopped' ELSE {CSTATE} END AS operating_state,
    'csv' AS source_system, 'raw' AS source_file FROM broken""",
    CAL,
    COMP,
    BROKEN,
)
add(
    "normalize_quarantine",
    """SELECT event_id::VARCHAR AS raw_index, 'not-a-time' AS event_time_raw, 'unparsable_time' AS reason
    FROM events WHERE event_id % 97 = 0""",
)
add(
    "time_buckets",
    """SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS event_minute, date_trunc('hour', ts)::TIMESTAMP AS event_hour,
    strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%Y-%m-%d %H:%M:00') AS minute_bucket FROM events""",
)
add(
    "state_banding",
    f"""SELECT raw_index, CASE WHEN raw_index % 31 = 0 OR raw_index % 37 = 0 THEN 'stopped' ELSE {STATE} END
    AS operating_state FROM bare""",
    BARE,
)
add(
    "interaction_deltas",
    f"""SELECT raw_index, {r('tp3 - reservoirs', 'delta_tp3_reservoirs')}, {r('tp2 - tp3', 'delta_tp2_tp3')} FROM comp""",
    COMP,
)
add(
    "finite_or",
    """SELECT event_id, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0
    THEN 0.0 ELSE value END AS value FROM events""",
)
add(
    "one_hot_state",
    """SELECT raw_index, (st = 'loaded')::INT AS state_loaded, (st = 'unloaded')::INT AS state_unloaded,
    (st = 'stopped')::INT AS state_stopped, (st = 'unknown')::INT AS state_unknown
    FROM (SELECT raw_index, CASE WHEN raw_index % 29 = 0 THEN 'unknown' ELSE operating_state END AS st FROM readings)""",
    *R3,
)
add(
    "binary_target",
    "SELECT event_bucket, operating_state, (failure_sample_count > 0)::INT AS label FROM kpi",
    *R3,
    KPI,
)
add(
    "decode_events",
    f"""SELECT (raw_index % 83 = 0)::INT AS is_corrupt,
    CASE WHEN raw_index % 83 = 0 THEN 'none' ELSE operating_state END AS operating_state, count(*) AS event_rows,
    count(*) FILTER (raw_index % 97 <> 0 AND (raw_index % 83 <> 0)) AS id_rows,
    {r('sum(CASE WHEN raw_index % 83 <> 0 THEN tp2 END)', 'tp2_sum')},
    min(CASE WHEN raw_index % 83 <> 0 THEN event_time END) AS min_event_time FROM cevents GROUP BY 1, 2""",
    CAL,
    COMP,
    CEVENTS,
)
ERRORS = """errors AS (
  SELECT CASE WHEN raw_index % 83 = 0 THEN 'invalid_json'
    WHEN f = 'array' THEN 'payload_not_json_object'
    ELSE concat_ws(',', CASE WHEN raw_index % 97 = 0 THEN 'missing_required_field:event_id' END,
      CASE WHEN f = 'gone' THEN 'missing_required_field:h1' END,
      CASE WHEN f = 'time' THEN 'invalid_event_time_format' END,
      CASE WHEN raw_index % 89 = 0 THEN 'invalid_operating_state' END,
      CASE WHEN f = 'text' THEN 'non_numeric_sensor:tp2' WHEN f = 'bool' THEN 'non_numeric_sensor:lps' END) END AS errors
  FROM (SELECT event_id AS raw_index, CASE WHEN event_id % 71 = 0 THEN 'text' WHEN event_id % 73 = 0 THEN 'bool'
    WHEN event_id % 79 = 0 THEN 'time' WHEN event_id % 67 = 0 THEN 'gone' WHEN event_id % 61 = 0 THEN 'array' END AS f
    FROM events))"""
add(
    "validate_contract",
    """SELECT CASE WHEN errors = '' THEN 'valid' ELSE 'invalid' END AS status,
    CASE WHEN errors = '' THEN 'none' ELSE errors END AS errors, count(*) AS event_rows FROM errors GROUP BY 1, 2""",
    ERRORS,
)
add(
    "contract_summary",
    """SELECT count(*) AS total, count(*) FILTER (errors <> '') AS invalid, count(*) FILTER (errors = '') AS valid
    FROM errors""",
    ERRORS,
)
PC = PARTS.replace("SOURCE", "comp")
COMPONENTS = ("pressure_component", "oil_component", "current_component", "digital_component")
add("risk_score", f"SELECT raw_index, {', '.join(r(c, c) for c in COMPONENTS)}, {r(SCORE, 'risk_score')} FROM parts", COMP, PC)
add("risk_reason", f"SELECT raw_index, {ALARMS} AS risk_reason FROM comp", COMP)
add(
    "risk_passthrough",
    f"""SELECT raw_index, {r('v', 'risk_score')},
    CASE WHEN raw_index % 5 = 0 THEN 'passed_through_existing_risk_score'
         WHEN raw_index % 7 = 0 THEN 'passed_through_model_score'
         ELSE coalesce(nullif(concat_ws(',', CASE WHEN pressure_component >= 0.25 THEN 'pressure_balance_shift' END,
           CASE WHEN oil_component >= 0.25 THEN 'oil_temperature_elevated' END,
           CASE WHEN current_component >= 0.25 THEN 'motor_current_elevated' END), ''), 'baseline_signal_level') END
      AS risk_reason,
    CASE WHEN raw_index % 5 = 0 THEN 'provided_risk_score' WHEN raw_index % 7 = 0 THEN 'model_score'
         ELSE 'signal_rules' END AS risk_score_source, {level('v')} AS risk_level
    FROM (SELECT *, {clip(f'CASE WHEN raw_index % 5 = 0 THEN tp2 / 4.0 WHEN raw_index % 7 = 0 THEN tp2 / 50.0 ELSE {SCORE} END')} AS v FROM parts)""",
    COMP,
    PC,
)
add(
    "risk_level",
    f"""SELECT raw_index, {r('v', 'risk_score')}, {level('v')} AS risk_level
    FROM (SELECT raw_index, tp2 / 15.0 - 0.05 AS v FROM comp) WHERE v BETWEEN 0 AND 1""",
    COMP,
)
add(
    "risk_enrich",
    f"""SELECT event_id, raw_index, event_time, source, operating_state, is_failure_window, failure_type, risk_score,
    risk_level, risk_reason, 'compressor_1' AS equipment_id, 'signal_rules' AS risk_score_source,
    'signal_rules' AS risk_model_name, '1' AS risk_model_version, '1' AS model_version,
    {r('0.5636003790254064')} AS risk_threshold, '1,5,15,60' AS feature_window_minutes, event_time AS feature_window_end,
    'raw_event_v1' AS model_feature_set_version, '2024-02-01 00:00:00' AS scoring_time,
    strftime(event_time, '%Y-%m-%d') AS dt FROM risk""",
    *R5,
)
add("sensor_long", f"SELECT raw_index, event_time, dt, sensor_name, {r('sensor_value', 'sensor_value')} FROM long", *R3, LONG)

# ---- joins -------------------------------------------------------------------------

add(
    "dim_join",
    f"""SELECT raw_index, sensor_name, {r('sensor_value', 'sensor_value')}, sensor_type, station_id, unit
    FROM long LEFT JOIN dim USING (sensor_name)""",
    *R3,
    LONG,
    DIM,
)
for key, pick in (("interval_label", "max_by"), ("interval_label_first", "min_by")):
    add(
        key,
        f"""SELECT raw_index, event_time, (count(id) > 0)::INT AS is_failure_window,
        coalesce({pick}(t, id), 'normal') AS failure_type
        FROM bare LEFT JOIN cal ON event_time BETWEEN s AND e GROUP BY raw_index, event_time""",
        CAL2,
        BARE,
    )


def _horizon(hours: int) -> str:
    test = f"event_time >= s - INTERVAL {hours} HOUR AND event_time < s"
    return f"EXISTS (SELECT 1 FROM cal WHERE {test})::INT AS pre_failure_{hours}h"


LABELLED = f"""labelled0 AS (
  SELECT b.*, {STATE} AS operating_state, pressure - temperature AS delta_pt,
    date_trunc('hour', event_time)::TIMESTAMP AS event_bucket, strftime(event_time, '%Y-%m-%d') AS dt,
    EXISTS (SELECT 1 FROM cal WHERE event_time BETWEEN s AND e)::INT AS failure_window,
    {_horizon(1)}, {_horizon(6)}, {_horizon(24)},
    EXISTS (SELECT 1 FROM cal WHERE event_time > e AND event_time <= e + INTERVAL 24 HOUR)::INT AS post_maintenance,
    coalesce((SELECT max_by(t, id) FROM cal WHERE event_time BETWEEN s AND e), 'normal') AS failure_type,
    (SELECT min(s) FROM cal WHERE s > event_time) AS next_start FROM bare b),
labelled AS (
  SELECT * EXCLUDE (next_start), CASE WHEN failure_window = 1 THEN 0.0
      ELSE (epoch_us(next_start) - epoch_us(event_time)) / 1e6 END AS rul_seconds,
    1 - greatest(failure_window, pre_failure_24h, post_maintenance) AS normal_candidate FROM labelled0)"""
L3 = (CAL, BARE, LABELLED)
FLAGS = ["failure_window", "pre_failure_1h", "pre_failure_6h", "pre_failure_24h", "post_maintenance", "normal_candidate"]
add("rul_seconds", f"SELECT raw_index, {r('rul_seconds', 'rul_seconds')} FROM labelled", *L3)
for key, same in (("seconds_to_next", ""), ("seconds_to_next_by_key", "AND n.equipment_id = b.equipment_id")):
    part = "PARTITION BY equipment_id" if same else ""
    # distinct times per key: the next error after a row is the first error later in order
    add(
        key,
        f"""SELECT raw_index, {r("(epoch_us(nxt) - epoch_us(event_time)) / 1e6", 'seconds_to_next')} FROM (
        SELECT raw_index, event_time, min(CASE WHEN d_error = 1 THEN event_time END) OVER (
          {part} ORDER BY event_time RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
        FROM bare)""",
        BARE,
    )
SEGMENT = """CASE WHEN failure_window = 1 THEN 'failure_window' WHEN pre_failure_1h = 1 THEN 'pre_failure_1h'
  WHEN pre_failure_6h = 1 THEN 'pre_failure_6h_only' WHEN pre_failure_24h = 1 THEN 'pre_failure_24h_only'
  WHEN post_maintenance = 1 THEN 'post_maintenance' WHEN normal_candidate = 1 THEN 'normal_candidate'
  ELSE 'other' END"""
add(
    "failure_contrast",
    f"""SELECT sensor_name, {r('n', 'normal_avg')}, {r('f', 'failure_avg')}, nc::BIGINT AS normal_count, fc::BIGINT AS failure_count,
    {r('f - n', 'avg_delta_failure_minus_normal')},
    row_number() OVER (ORDER BY abs(coalesce(f - n, 0)) DESC, sensor_name)::INT AS contrast_rank
    FROM (SELECT sensor_name, avg(sensor_value) FILTER (is_failure_window = 0) AS n,
      avg(sensor_value) FILTER (is_failure_window = 1) AS f, count(*) FILTER (is_failure_window = 0) AS nc,
      count(*) FILTER (is_failure_window = 1) AS fc FROM long GROUP BY sensor_name)""",
    *R3,
    LONG,
)
SEG = f"""seg AS (SELECT {SEGMENT} AS segment, count(*) AS segment_rows,
  {', '.join(f'avg({c}) AS {c}' for c in SIGNALS)} FROM labelled GROUP BY 1)"""
add(
    "segment_contrast",
    f"""SELECT x.segment, sensor_name, {r('mean', 'mean')}, {r('mean - base', 'delta_vs_normal')} FROM
    (SELECT * FROM (SELECT segment, pressure, temperature FROM seg) UNPIVOT (mean FOR sensor_name IN (pressure, temperature))) x
    JOIN (SELECT * FROM (SELECT pressure, temperature FROM seg WHERE segment = 'normal_candidate')
      UNPIVOT (base FOR sensor_name IN (pressure, temperature))) y USING (sensor_name)
    WHERE segment <> 'normal_candidate'""",
    *L3,
    SEG,
)

# ---- aggregations ------------------------------------------------------------------

add(
    "kpi_overall",
    f"""SELECT {COUNTS}, min(event_time) AS min_event_time, max(event_time) AS max_event_time,
    count(DISTINCT dt) AS active_day_count, {r(RATE, 'failure_window_rate')}, 'overall' AS metric_type FROM readings""",
    *R3,
)
KPI_DOUBLES = ["failure_window_rate"] + [f"{k}_{c}" for c in ANALOG for k in ("avg", "std", "min", "max")]


def _replace(columns, places: int = 6) -> str:
    return "* REPLACE (" + ", ".join(r(c, c, places) for c in columns) + ")"


add("kpi_window", f"SELECT {_replace(KPI_DOUBLES)} FROM kpi", *R3, KPI)
W_ANALOG = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
W_ALL = [*W_ANALOG, "d_returned", "d_final"]
WIDE = """wide AS (
  SELECT l_orderkey AS raw_index, l_shipdate AS event_time, date_trunc('day', l_shipdate)::TIMESTAMP AS event_bucket,
    strftime(l_shipdate, '%Y-%m-%d') AS dt, l_quantity, l_extendedprice, l_discount, l_tax,
    (l_returnflag = 'R')::INT::DOUBLE AS d_returned, (l_linestatus = 'F')::INT::DOUBLE AS d_final,
    CASE WHEN l_quantity >= 35 THEN 'loaded' WHEN l_quantity >= 10 THEN 'unloaded' ELSE 'stopped' END AS operating_state,
    (l_discount > 0.08::DOUBLE)::INT AS is_failure_window FROM lineitem)"""


def _r3(e: str, name: str) -> str:
    return r(e, name, 3)


add(
    "kpi_window_wide",
    f"""SELECT event_bucket, dt, operating_state, {COUNTS}, {r(RATE, 'failure_window_rate')},
    {', '.join(f"{r(f'avg({c})', f'avg_{c}')}, {r(f'stddev_samp({c})', f'std_{c}')}, {r(f'min({c})', f'min_{c}')}, {r(f'max({c})', f'max_{c}')}" for c in W_ANALOG)},
    sum(d_returned) AS active_count_d_returned, sum(d_final) AS active_count_d_final,
    strftime(event_bucket, '%Y-%m-%d %H:%M:00') AS minute_bucket FROM wide GROUP BY event_bucket, dt, operating_state""",
    WIDE,
)
add("kpi_sensor", f"SELECT {_replace([c for c in ('failure_window_rate', 'avg_sensor_value', 'std_sensor_value', 'min_sensor_value', 'max_sensor_value')])} FROM sensor_kpi", *S5)
add(
    "kpi_sensor_wide",
    f"""SELECT sensor_name, CASE WHEN sensor_name LIKE 'd\\_%' ESCAPE '\\' THEN 'digital' ELSE 'analog' END AS sensor_type,
    'unknown' AS station_id, 'unknown' AS unit, {COUNTS}, {_r3('avg(v)', 'avg_sensor_value')},
    {_r3('stddev_samp(v)', 'std_sensor_value')}, {_r3('min(v)', 'min_sensor_value')}, {_r3('max(v)', 'max_sensor_value')},
    {_r3(RATE, 'failure_window_rate')}
    FROM (SELECT * FROM (SELECT * FROM wide) UNPIVOT (v FOR sensor_name IN ({', '.join(W_ALL)}))) GROUP BY sensor_name""",
    WIDE,
)
add(
    "kpi_state",
    f"""SELECT operating_state, {COUNTS}, {r('avg(pressure)', 'avg_pressure')}, {r('avg(temperature)', 'avg_temperature')},
    {r(RATE, 'failure_window_rate')} FROM readings GROUP BY operating_state""",
    *R3,
)
add("daily_counts", f"SELECT dt, {COUNTS} FROM readings GROUP BY dt", *R3)
add(
    "daily_stats",
    f"""SELECT count(*) AS active_days, min(n) AS min_daily_samples, max(n) AS max_daily_samples,
    {r('avg(n)', 'avg_daily_samples')} FROM (SELECT dt, count(*) AS n FROM readings GROUP BY dt)""",
    *R3,
)
add(
    "daily_outliers",
    """SELECT dt, n AS count, m AS median_count FROM (
      SELECT dt, n, floor((SELECT median(n) FROM days))::BIGINT AS m FROM days)
    WHERE m > 0 AND (n < m * 0.8::DOUBLE OR n > m * 1.2::DOUBLE)""",
    WIDE,
    "days AS (SELECT dt, count(*) AS n FROM wide GROUP BY dt)",
)
add(
    "duplicate_times",
    """SELECT count(*) AS duplicate_event_time_count FROM (
      SELECT event_time FROM wide GROUP BY event_time HAVING count(*) > 1)""",
    WIDE,
)
NULLED = """nulled AS (SELECT * REPLACE (CASE WHEN raw_index % 41 <> 0 THEN pressure END AS pressure,
  CASE WHEN raw_index % 43 <> 0 THEN d_view END AS d_view) FROM readings)"""
add(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM nulled"
        for c in ["event_time", "operating_state", *SENSORS]
    ),
    *R3,
    NULLED,
)
add(
    "value_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS sensor_name, coalesce({c}, -1.0) AS value, count(*) AS value_rows FROM nulled GROUP BY 2"
        for c in DIGITAL
    ),
    *R3,
    NULLED,
)
CATEGORY = " UNION ALL ".join(
    f"SELECT '{c}' AS category_name, {c} AS category, count(*) AS category_rows FROM readings GROUP BY 2"
    for c in ("failure_type", "operating_state")
)
add("category_counts", CATEGORY, *R3)
add("risk_level_counts", "SELECT risk_level, count(*) AS event_rows FROM risk GROUP BY 1", *R5)
add(
    "analog_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS sensor_name, {r(f'avg({c})', 'avg_sensor_value')}, {r(f'stddev_samp({c})', 'std_sensor_value')},
        {r(f'min({c})', 'min_sensor_value')}, {r(f'max({c})', 'max_sensor_value')} FROM bare"""
        for c in ANALOG
    ),
    BARE,
)
add("time_bounds", "SELECT min(ts) AS min_event_time, max(ts) AS max_event_time FROM events")
add(
    "weighted_rollup",
    f"""SELECT event_bucket, dt, sum(sample_count)::BIGINT AS sample_count,
    sum(failure_sample_count)::BIGINT AS failure_sample_count,
    {', '.join(r(f'sum(avg_{c} * sample_count) / sum(sample_count)', f'avg_{c}') for c in ANALOG)}
    FROM kpi GROUP BY event_bucket, dt""",
    *R3,
    KPI,
)
add("dash_window", "SELECT * FROM window_state ORDER BY dt, operating_state LIMIT 100", *R3, KPI, WINDOW_STATE)
for key in ("long_counts", "long_counts_sql", "long_counts_wide"):
    add(
        key,
        "SELECT sensor_name, sensor_type, count(*) AS rows_in_long_table FROM long JOIN dim USING (sensor_name) GROUP BY 1, 2",
        *R3,
        LONG,
        DIM,
    )
add("ods_count", "SELECT count(*) AS ods_rows FROM events")
add(
    "window_consistency",
    """SELECT count(*) AS window_rows, sum(sample_count)::BIGINT AS sample_count,
    sum(failure_sample_count)::BIGINT AS failure_sample_count FROM kpi""",
    *R3,
    KPI,
)
LABEL_SUMMARY = "label_summary AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS label, sum({c})::BIGINT AS positive_rows, (count(*) - sum({c}))::BIGINT AS negative_rows,
    {r(f'sum({c}) / count(*)', 'positive_rate')} FROM labelled"""
    for c in FLAGS
) + ")"
add("label_summary", "SELECT * FROM label_summary", *L3, LABEL_SUMMARY)
add(
    "rul_summary",
    f"""SELECT count(rul_seconds) AS rul_non_null_rows, {r('min(rul_seconds)', 'rul_min_seconds')},
    {r('max(rul_seconds)', 'rul_max_seconds')} FROM labelled""",
    *L3,
)
add("segment_means", f"SELECT {_replace(SIGNALS)} FROM seg", *L3, SEG)
add(
    "volatility_rank",
    f"""SELECT sensor_name, {r('m', 'mean')}, {r('s', 'std')},
    row_number() OVER (ORDER BY abs(s) DESC, sensor_name)::INT AS volatility_rank FROM ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS sensor_name, avg({c}) AS m, stddev_samp({c}) AS s FROM readings" for c in SIGNALS)
    + ")",
    *R3,
)
CORR = ["tp2", "tp3", "h1", "dv_pressure", "reservoirs", "oil_temperature", "delta_tp3_reservoirs", "delta_tp2_tp3"]
DELTAS = "deltas AS (SELECT *, tp3 - reservoirs AS delta_tp3_reservoirs, tp2 - tp3 AS delta_tp2_tp3 FROM comp)"


def _corr(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS \"left\", '{y}' AS \"right\", {r(f'corr({x}, {y})', 'correlation') if x != y else '1.0::DOUBLE AS correlation'} FROM deltas"
        for x, y in pairs
    )


add("corr_matrix", "SELECT DISTINCT * FROM (" + _corr([(x, y) for x in CORR for y in CORR]) + ")", COMP, DELTAS)
UPPER = [(x, y) for i, x in enumerate(CORR) for y in CORR[i + 1 :]]
add(
    "corr_top",
    f"""SELECT "left", "right", correlation, abs(correlation) AS abs_correlation FROM ({_corr(UPPER)})
    ORDER BY abs_correlation DESC, "left", "right" LIMIT 10""",
    COMP,
    DELTAS,
)
add(
    "hourly_mean",
    f"""SELECT event_bucket AS bucket_start, {r('avg(pressure)', 'pressure')}, {r('avg(temperature)', 'temperature')}
    FROM nulled GROUP BY event_bucket HAVING avg(pressure) IS NOT NULL OR avg(temperature) IS NOT NULL""",
    *R3,
    NULLED,
)

# ---- ordered rows and features -----------------------------------------------------

CHANGED = f"""changed AS (
  SELECT *, (lag(operating_state) OVER w IS DISTINCT FROM operating_state)::INT AS state_transition_flag,
    {', '.join(f'coalesce(abs({d} - lag({d}) OVER w), 0.0::DOUBLE) AS toggle_{d}' for d in DIGITAL)}
  FROM labelled WINDOW w AS (ORDER BY event_time, raw_index))"""
C4 = (*L3, CHANGED)
add(
    "daily_transitions",
    "SELECT dt, sum(state_transition_flag)::BIGINT AS state_transition_count FROM changed GROUP BY dt",
    *C4,
)
SPAN = "nullif((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6, 0)"
ORD = "(event_time, raw_index)"
BASE = f"""base AS (
  SELECT event_bucket, count(*) AS sample_count, min(event_time) AS window_start, max(event_time) AS window_end,
    {', '.join(f'max({f}) AS {f}' for f in FLAGS)}, min(rul_seconds) AS rul_seconds,
    sum(state_transition_flag)::BIGINT AS state_transition_count,
    {', '.join(f"count(*) FILTER (operating_state = '{s}') AS state_{s}_count" for s in ('loaded', 'unloaded', 'stopped'))},
    {', '.join(f'avg({c}) AS mean_{c}, stddev_samp({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}, arg_min({c}, {ORD}) AS first_{c}, arg_max({c}, {ORD}) AS last_{c}' for c in SIGNALS)},
    {', '.join(f'sum({d}) AS active_count_{d}, sum(toggle_{d}) AS toggle_count_{d}' for d in DIGITAL)},
    {', '.join(f'(arg_max({c}, {ORD}) - arg_min({c}, {ORD})) / {SPAN} AS slope_{c}' for c in SIGNALS)}
  FROM changed GROUP BY event_bucket)"""
B5 = (*C4, BASE)
SLOPES = [f"slope_{c}" for c in SIGNALS]
BASE_DOUBLES = ["rul_seconds"] + [f"{k}_{c}" for c in SIGNALS for k in ("mean", "std", "min", "max", "first", "last")]
add(
    "minute_features",
    f"SELECT * EXCLUDE ({', '.join(SLOPES)}) REPLACE ({', '.join(r(c, c) for c in BASE_DOUBLES)}) FROM base",
    *B5,
)
add("minute_slope", f"SELECT event_bucket, {', '.join(r(c, c) for c in SLOPES)} FROM base", *B5)
ROLL_BASE = [
    *[f"mean_{c}" for c in ANALOG],
    *[f"std_{c}" for c in ANALOG],
    "mean_delta_pt",
    "state_transition_count",
    *[f"toggle_count_{d}" for d in DIGITAL],
    *[f"active_count_{d}" for d in DIGITAL],
]


def _framed(n: int) -> str:
    return f"OVER (ORDER BY event_bucket ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


ROLL = {f"roll1_mean_{c}": f"{c}::DOUBLE" for c in ROLL_BASE}
for n in (5, 15, 60):
    for c in ROLL_BASE:
        ROLL[f"roll{n}_mean_{c}"] = f"avg({c}) {_framed(n)}"
        ROLL[f"roll{n}_std_{c}"] = f"coalesce(stddev_samp({c}) {_framed(n)}, 0)"
        ROLL[f"roll{n}_min_{c}"] = f"min({c}) {_framed(n)}"
        ROLL[f"roll{n}_max_{c}"] = f"max({c}) {_framed(n)}"
QUANT = {
    f"roll{n}_{q}_mean_{c}": f"quantile_cont(mean_{c}, {p}) {_framed(n)}"
    for n in (15, 60)
    for c in SIGNALS
    for q, p in (("q25", 0.25), ("q75", 0.75))
}


def _roll_columns(chosen: dict[str, str]) -> str:
    # quartiles sit on quarter steps between means, where six places meet exact ties
    return ", ".join(r(e, n, 8 if n in QUANT else 6) for n, e in chosen.items())


add("rolling_stats", f"SELECT event_bucket, {_roll_columns(ROLL)} FROM base", *B5)
add("rolling_quantiles", f"SELECT event_bucket, {_roll_columns(QUANT)} FROM base", *B5)
add(
    "feature_table",
    f"""SELECT * REPLACE ({', '.join(r(c, c) for c in BASE_DOUBLES + SLOPES)}), {_roll_columns(ROLL)},
    {_roll_columns(QUANT)} FROM base""",
    *B5,
)
add("state_transitions", "SELECT raw_index, state_transition_flag FROM changed", *C4)
add("toggles", f"SELECT raw_index, {', '.join(f'toggle_{d}' for d in DIGITAL)} FROM changed", *C4)
add(
    "keyed_transitions",
    """SELECT raw_index, (lag(operating_state) OVER (PARTITION BY equipment_id ORDER BY event_time, raw_index)
    IS DISTINCT FROM operating_state)::INT AS state_transition_flag FROM readings""",
    *R3,
)
GAPS = """gaps AS (
  SELECT raw_index, event_time, lag(event_time) OVER (ORDER BY event_time, raw_index) AS previous_event_time FROM bare)"""
WHOLE = "date_diff('second', previous_event_time, event_time)"
add(
    "interval_stats",
    f"""SELECT min(g) AS min_interval_seconds, max(g) AS max_interval_seconds, {r('avg(g)', 'avg_interval_seconds')},
    {r('quantile_cont(g, 0.5)', 'median_interval_seconds')}
    FROM (SELECT {WHOLE} AS g FROM gaps WHERE previous_event_time IS NOT NULL)""",
    BARE,
    GAPS,
)
add(
    "interval_hist",
    f"""SELECT {WHOLE} AS interval_seconds, count(*) AS interval_rows FROM gaps
    WHERE previous_event_time IS NOT NULL GROUP BY 1""",
    BARE,
    GAPS,
)
add(
    "top_gaps",
    f"""SELECT previous_event_time, event_time,
    {r('(epoch_us(event_time) - epoch_us(previous_event_time)) / 1e6', 'interval_seconds')}
    FROM gaps WHERE previous_event_time IS NOT NULL ORDER BY interval_seconds DESC, event_time LIMIT 10""",
    BARE,
    GAPS,
)
add(
    "downsample",
    """SELECT raw_index, event_time, pressure FROM (
      SELECT *, row_number() OVER (ORDER BY event_time, raw_index) AS i, count(*) OVER () AS n FROM bare)
    WHERE n <= 300 OR i % greatest(1, n // 300) = 0""",
    BARE,
)
add(
    "ordered_split",
    """SELECT event_bucket, operating_state, sample_count,
    CASE WHEN i <= greatest(1, least(floor(n * 0.7::DOUBLE)::BIGINT, n - 1)) THEN 'train' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (ORDER BY event_bucket, operating_state) AS i, count(*) OVER () AS n FROM kpi)""",
    *R3,
    KPI,
)
T1, T2 = "TIMESTAMP '2024-01-16 00:00:00'", "TIMESTAMP '2024-01-23 00:00:00'"
SPLIT = f"CASE WHEN event_time < {T1} THEN 'train' WHEN event_time < {T2} THEN 'validation' ELSE 'test' END"
add(
    "chrono_split",
    f"""SELECT {', '.join(f"min(event_time) FILTER (s = '{k}') AS {k}_min, max(event_time) FILTER (s = '{k}') AS {k}_max" for k in ('train', 'validation', 'test'))},
    'PASS' AS status FROM (SELECT event_time, {SPLIT} AS s FROM bare)""",
    BARE,
)
SCORED = """scored AS (
  SELECT raw_index, event_time, pressure / (pressure + 50.0) AS score, pre_failure_24h AS label FROM labelled
  WHERE failure_window = 0 AND post_maintenance = 0)"""
S4 = (*L3, SCORED)
AP = """(SELECT sum(label * tp / i) / sum(label) FROM (
  SELECT label, row_number() OVER w AS i, sum(label) OVER (w ROWS UNBOUNDED PRECEDING) AS tp
  FROM {src} WINDOW w AS (ORDER BY score DESC, event_time)))"""
add(
    "average_precision",
    f"SELECT sum(label)::BIGINT AS positive_rows, {r(AP.format(src='scored'), 'average_precision')} FROM scored",
    *S4,
)
add(
    "average_precision_grouped",
    f"""SELECT sum(y)::BIGINT AS positive_rows, {r('sum(y * tp / n) / sum(y)', 'average_precision')} FROM (
      SELECT y, sum(y) OVER w AS tp, sum(c) OVER w AS n FROM (
        SELECT score, sum(label) AS y, count(*) AS c FROM scored GROUP BY score)
      WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""",
    *S4,
)

# ---- dashboards --------------------------------------------------------------------

add(
    "dash_sensor",
    f"""SELECT sensor_name, sensor_type, unit, sample_count, failure_sample_count,
    {', '.join(r(c, c) for c in ('failure_window_rate', 'avg_sensor_value', 'std_sensor_value'))}
    FROM sensor_kpi ORDER BY failure_window_rate DESC, sensor_name LIMIT 15""",
    *S5,
)
add(
    "latest_risk",
    """SELECT event_id, event_time, operating_state, risk_score, risk_level, risk_reason, '1' AS model_version
    FROM risk ORDER BY event_time DESC, event_id LIMIT 20""",
    *R5,
)
add("dash_window_state", "SELECT * FROM window_state ORDER BY dt, operating_state LIMIT 100", *R3, KPI, WINDOW_STATE)


def _metrics(score: str, threshold: str, src: str) -> str:
    """precision, recall, f1 and alarms per day of a score rule over scored rows."""
    return f"""SELECT *, CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END AS f1 FROM (
      SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS q, fp / greatest(days, 1) AS a FROM (
      SELECT count(*) AS rows, count(*) FILTER ({score} >= {threshold} AND label = 1) AS tp,
        count(*) FILTER ({score} >= {threshold} AND label = 0) AS fp,
        count(*) FILTER ({score} < {threshold} AND label = 0) AS tn,
        count(*) FILTER ({score} < {threshold} AND label = 1) AS fn,
        count(DISTINCT event_time::DATE) AS days FROM {src}))"""


RULES = {"plain": "score", "inverse": "(1.0 - score)", "flat": "(score * 0.5)"}
SOURCES = {"csv_derived": "(SELECT * REPLACE (floor(score * 100.0::DOUBLE) / 100.0::DOUBLE AS score) FROM scored)", "warehouse_derived": "scored"}
MODELS = "models AS (" + " UNION ALL ".join(
    f"""SELECT '{s}' AS source_type, '{m}' AS model_name,
    '{'skipped' if (s, m) == ('csv_derived', 'flat') else 'trained'}' AS status, p AS precision, q AS recall, f1,
    a AS false_alarms_per_day FROM ({_metrics(e, '0.5', src)})"""
    for s, src in SOURCES.items()
    for m, e in RULES.items()
) + ")"
MEASURES = ["precision", "recall", "f1", "false_alarms_per_day"]
add(
    "metric_delta",
    f"""SELECT source_type, model_name, status, {', '.join(r(m, m) for m in MEASURES)} FROM models
    UNION ALL SELECT 'warehouse_derived_minus_csv_derived', model_name, 'delta',
    {', '.join(r(f'w.{m} - c.{m}', m) for m in MEASURES)} FROM models w JOIN models c USING (model_name)
    WHERE w.source_type = 'warehouse_derived' AND c.source_type = 'csv_derived'
      AND w.status = 'trained' AND c.status = 'trained'""",
    *S4,
    MODELS,
)
add(
    "dash_models",
    f"SELECT source_type, model_name, status, {', '.join(r(m, m) for m in MEASURES)} FROM models",
    *S4,
    MODELS,
)
add("dash_labels", "SELECT * FROM label_summary ORDER BY positive_rate DESC, label", *L3, LABEL_SUMMARY)
add(
    "attention_top",
    """SELECT i::INT AS attention_rank, sensor_name,
    'failure-window mean shift ' || d::DECIMAL(38,6) || '; std ' || s::DECIMAL(38,6) AS reason FROM (
      SELECT sensor_name, f - n AS d, s, row_number() OVER (ORDER BY abs(coalesce(f - n, 0)) DESC, sensor_name) AS i FROM (
        SELECT sensor_name, avg(sensor_value) FILTER (is_failure_window = 0) AS n,
          avg(sensor_value) FILTER (is_failure_window = 1) AS f, stddev_samp(sensor_value) AS s
        FROM long GROUP BY sensor_name)) WHERE i <= 3""",
    *R3,
    LONG,
)
add(
    "consistency_metrics",
    """SELECT 'sensor_rows' AS metric, count(*)::BIGINT AS value FROM sensor_kpi
    UNION ALL SELECT 'sensor_sample_sum', sum(sample_count)::BIGINT FROM sensor_kpi
    UNION ALL SELECT 'window_state_rows', count(*) FROM window_state
    UNION ALL SELECT 'window_sample_sum', sum(sample_count)::BIGINT FROM window_state
    UNION ALL SELECT 'window_failure_sample_sum', sum(failure_sample_count)::BIGINT FROM window_state""",
    *S5,
    KPI,
    WINDOW_STATE,
)

# ---- labels ------------------------------------------------------------------------

add(
    "interval_calendar",
    """SELECT k AS line_no,
    CASE WHEN k % 97 = 0 OR k % 89 = 0 THEN 'none' WHEN k % 83 <> 0 AND k % 79 = 0 THEN e ELSE s END AS start_time,
    CASE WHEN k % 97 = 0 THEN 'none' WHEN k % 89 <> 0 AND k % 83 <> 0 AND k % 79 = 0 THEN s ELSE e END AS end_time,
    CASE WHEN k % 97 = 0 OR (k % 89 <> 0 AND k % 83 = 0) THEN 'none' ELSE t END AS interval_type,
    CASE WHEN k % 97 = 0 OR (k % 89 <> 0 AND k % 83 = 0) THEN 'none'
         WHEN t LIKE '%high%' THEN 'high_stress' ELSE 'unknown' END AS severity,
    CASE WHEN k % 97 = 0 THEN 'not_three_parts' WHEN k % 89 = 0 THEN 'bad_start' WHEN k % 83 = 0 THEN 'empty_type'
         WHEN k % 79 = 0 THEN 'end_before_start' ELSE '' END AS issues
    FROM (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS s,
      strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS e,
      o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN '_high' ELSE '' END AS t FROM orders)""",
)
add(
    "calendar_overlaps",
    """SELECT interval_id, coalesce((s <= latest)::INT, 0) AS overlaps_earlier FROM (
      SELECT o_orderkey AS interval_id, o_orderdate AS s, max(o_orderdate + INTERVAL 30 DAY) OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM orders)""",
)
add(
    "interval_flags_by_table",
    """SELECT r.o_orderkey AS raw_index,
    max(coalesce(t BETWEEN s AND e, false)::INT) AS failure_window,
    max(coalesce(t >= s - INTERVAL 24 HOUR AND t < s, false)::INT) AS pre_failure,
    max(coalesce(t > e AND t <= e + INTERVAL 24 HOUR, false)::INT) AS post_maintenance
    FROM (SELECT *, o_orderdate + INTERVAL 20 DAY AS t FROM orders) r
    LEFT JOIN (SELECT o_custkey, o_orderdate AS s, o_orderdate + INTERVAL 12 DAY AS e FROM orders) c ON r.o_custkey = c.o_custkey GROUP BY 1""",
)
ORDER_CAL = """ocal AS (SELECT id, equipment_id, s, s + to_seconds(id * 31 % 7200) AS e, t FROM (
  SELECT o_orderkey AS id, o_custkey // 10 AS equipment_id, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 7919 % 2592000) AS s,
    'kind_' || (o_orderkey % 5) AS t FROM orders))"""


def _order_labels(match: str, pick: str) -> str:
    pre = ", ".join(f"max(coalesce(event_time >= s - INTERVAL {h} HOUR AND event_time < s, false)::INT) AS pre_failure_{h}h" for h in (1, 6, 24))
    return f"""olab AS (SELECT *, 1 - greatest(failure_window, pre_failure_24h, post_maintenance) AS normal_candidate,
      CASE WHEN failure_window = 1 THEN 0 ELSE (epoch_us(nxt) - epoch_us(event_time)) / 1e6 END AS rul_seconds FROM (
      SELECT raw_index, b.equipment_id, event_time, pressure, max(coalesce(event_time BETWEEN s AND e, false)::INT) AS failure_window, {pre},
        max(coalesce(event_time > e AND event_time <= e + INTERVAL 24 HOUR, false)::INT) AS post_maintenance,
        coalesce({pick}(t, id) FILTER (event_time BETWEEN s AND e), 'normal') AS failure_type, min(s) FILTER (s > event_time) AS nxt
      FROM bare b LEFT JOIN ocal c ON {match} GROUP BY ALL))"""


BY_KEY = (BARE, ORDER_CAL, _order_labels("b.equipment_id = c.equipment_id", "max_by"))
add("labels_by_table", f"SELECT raw_index, {', '.join(FLAGS)}, failure_type, {r('rul_seconds', 'rul_seconds')} FROM olab", *BY_KEY)
add(
    "labels_by_table_first",
    f"""SELECT raw_index, max((event_time BETWEEN s AND e)::INT) AS failure_window,
    coalesce(min_by(t, id) FILTER (event_time BETWEEN s AND e), 'normal') AS failure_type,
    {r('CASE WHEN max((event_time BETWEEN s AND e)::INT) = 1 THEN 0 ELSE (epoch_us(min(s) FILTER (s > event_time)) - epoch_us(event_time)) / 1e6 END', 'rul_seconds')}
    FROM bare, ocal GROUP BY raw_index, event_time""",
    BARE,
    ORDER_CAL,
)
add(
    "feature_table_by_calendar",
    f"""SELECT equipment_id, event_bucket, sample_count, {', '.join(FLAGS)}, {r('rul_seconds', 'rul_seconds')}, {r('mean_pressure', 'mean_pressure')},
    {r('avg(mean_pressure) OVER (PARTITION BY equipment_id ORDER BY event_bucket ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)', 'roll5_mean_mean_pressure')}
    FROM (SELECT equipment_id, date_trunc('hour', event_time)::TIMESTAMP AS event_bucket, count(*) AS sample_count,
      {', '.join(f'max({f}) AS {f}' for f in FLAGS)}, min(rul_seconds) AS rul_seconds, avg(pressure) AS mean_pressure FROM olab GROUP BY 1, 2)""",
    *BY_KEY,
)
add(
    "lead_time_by_table",
    f"""SELECT equipment_id, id AS interval_id, s AS interval_start, first_alarm, (first_alarm IS NOT NULL)::INT AS detected,
    {r('(epoch_us(s) - epoch_us(first_alarm)) / 3.6e9', 'lead_time_hours')} FROM (
    SELECT c.equipment_id, id, s, min(event_time) FILTER (pressure >= 60 AND event_time >= s - INTERVAL 24 HOUR AND event_time < s) AS first_alarm
    FROM ocal c JOIN bare b ON b.equipment_id = c.equipment_id GROUP BY ALL HAVING s BETWEEN min(event_time) AND max(event_time))""",
    BARE,
    ORDER_CAL,
)
add("horizon_labels", f"SELECT raw_index, {', '.join(FLAGS)}, failure_type FROM labelled", *L3)
add("label_segment", f"SELECT raw_index, {SEGMENT} AS segment FROM labelled", *L3)

# ---- streaming ---------------------------------------------------------------------

REASON = """CASE WHEN raw_index % 97 = 0 OR raw_index % 83 = 0 THEN 'missing_event_id_or_parse_error'
  WHEN raw_index % 89 = 0 THEN '{state}' ELSE 'valid' END"""
for key, state in (("gate_basic", "valid"), ("gate_strict", "invalid_operating_state")):
    add(key, f"SELECT {REASON.format(state=state)} AS reason, count(*) AS event_rows FROM cevents GROUP BY 1", CAL, COMP, CEVENTS)
KPI_AVG = ["tp2", "tp3", "reservoirs", "oil_temperature", "motor_current"]
MINUTE = f"""minutes AS (
  SELECT date_trunc('minute', event_time)::TIMESTAMP AS m, operating_state, count(*) AS sample_count,
    sum(is_failure_window)::BIGINT AS failure_sample_count, {r(RATE, 'failure_window_rate')},
    {', '.join(r(f'avg({c})', f'avg_{c}') for c in KPI_AVG)},
    strftime(date_trunc('minute', event_time), '%Y-%m-%d %H:%M:00') AS minute_bucket,
    strftime(event_time, '%Y-%m-%d') AS dt FROM valid GROUP BY ALL)"""
add("kpi_1m", "SELECT * EXCLUDE (m) FROM minutes", *V4, MINUTE)
add(
    "stream_event_kpi",
    "SELECT * EXCLUDE (m) FROM minutes",
    *V4,
    MINUTE,
)
add(
    "stream_kpi_1m",
    """SELECT operating_state, count(*)::BIGINT AS sample_count, sum(is_failure_window)::BIGINT AS failure_sample_count
    FROM valid GROUP BY 1""",
    *V4,
)
add(
    "stream_ods",
    f"""SELECT event_id, raw_index, event_time, operating_state, {r('tp2', 'tp2')}, strftime(event_time, '%Y-%m-%d') AS dt
    FROM valid""",
    *V4,
)
add(
    "stream_dlq",
    f"""SELECT reason, CASE WHEN cut THEN 'source=null,state=null,failure_type=null'
      ELSE 'source=replay,state=' || operating_state || ',failure_type=' || failure_type END AS payload,
    count(*) AS event_rows FROM (SELECT *, {REASON.format(state='invalid_operating_state')} AS reason,
      raw_index % 83 = 0 AS cut FROM cevents) WHERE reason <> 'valid' GROUP BY 1, 2""",
    CAL,
    COMP,
    CEVENTS,
)
add(
    "stream_risk",
    """SELECT event_id, event_time, risk_score, risk_level, risk_reason, strftime(event_time, '%Y-%m-%d') AS dt
    FROM risk""",
    *R5,
)
add("stream_dedup", "SELECT event_id, raw_index, event_time FROM valid", *V4)
add(
    "stream_fanout",
    """SELECT output, value::BIGINT AS value FROM (
      SELECT 'dead_letters' AS output, 2 * ((SELECT count(*) FROM cevents) - (SELECT count(*) FROM valid)) AS value
      UNION ALL SELECT 'readings', count(*) FROM valid
      UNION ALL SELECT 'risk_events', count(*) FROM valid
      UNION ALL SELECT 'minute_rows', count(*) FROM minutes
      UNION ALL SELECT 'minute_samples', count(*) FROM valid
      UNION ALL SELECT 'latest_raw_index', arg_max(raw_index, (event_time, raw_index)) FROM valid)""",
    *V4,
    MINUTE,
)
add("stream_fanout_kpi", "SELECT * EXCLUDE (m) FROM minutes", *V4, MINUTE)
add(
    "stream_fanout_readings",
    f"""SELECT event_id, raw_index, event_time, operating_state, {', '.join(r(c, c) for c in COMP_NAMES)},
    strftime(event_time, '%Y-%m-%d') AS dt FROM valid""",
    *V4,
)
add(
    "stream_late_rows",
    "SELECT count(*)::BIGINT AS event_rows, true AS has_late_rows, max(event_time) AS newest FROM valid",
    *V4,
)

# ---- quality -----------------------------------------------------------------------

NGAPS = """ngaps AS (
  SELECT date_diff('second', lag(event_time) OVER (ORDER BY event_time, raw_index), event_time) AS g FROM nulled)"""
add(
    "profile",
    f"""SELECT section, name, {r('value', 'value')} FROM (
    SELECT 'overview' AS section, unnest(['row_count', 'min_event_epoch', 'max_event_epoch', 'row_count_matches_expected']) AS name,
      unnest([count(*)::DOUBLE, floor(epoch(min(event_time))), floor(epoch(max(event_time))), (count(*) = 10000)::INT::DOUBLE]) AS value FROM nulled
    UNION ALL SELECT 'category_rows', category_name || '=' || category, category_rows FROM ({CATEGORY.replace('FROM readings', 'FROM nulled')})
    UNION ALL SELECT 'daily_samples', unnest(['active_days', 'min_daily_samples', 'max_daily_samples', 'avg_daily_samples']),
      unnest([count(*)::DOUBLE, min(n)::DOUBLE, max(n)::DOUBLE, avg(n)]) FROM (SELECT dt, count(*) AS n FROM nulled GROUP BY dt)
    UNION ALL SELECT 'duplicates', 'duplicate_event_time_count', count(*) FROM (
      SELECT event_time FROM nulled GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'interval_seconds', unnest(['min_interval_seconds', 'max_interval_seconds', 'avg_interval_seconds', 'median_interval_seconds']),
      unnest([min(g)::DOUBLE, max(g)::DOUBLE, avg(g), quantile_cont(g, 0.5)::DOUBLE]) FROM ngaps WHERE g IS NOT NULL
    UNION ALL SELECT 'digital_value_rows', sensor_name || '=' || coalesce(value::VARCHAR, 'null'), n FROM (
      {' UNION ALL '.join(f"SELECT '{c}' AS sensor_name, {c} AS value, count(*) AS n FROM nulled GROUP BY 2" for c in DIGITAL)})
    UNION ALL {' UNION ALL '.join(f"SELECT 'null_rows', '{c}', count(*) FILTER ({c} IS NULL) FROM nulled" for c in SENSORS)})""",
    *R3,
    NULLED,
    NGAPS,
)
add(
    "expectations",
    """SELECT CASE metric WHEN 'reading_rows' THEN CASE WHEN actual > 0 THEN 'PASS' ELSE 'FAIL' END
      WHEN 'absent' THEN 'FAIL' ELSE CASE WHEN actual = expected::DOUBLE THEN 'PASS' ELSE 'FAIL' END END AS level,
    metric, actual, expected FROM (
      SELECT 'reading_rows' AS metric, count(*)::DOUBLE AS actual, '>0' AS expected FROM events
      UNION ALL SELECT 'sensor_rows', 5, '5' UNION ALL SELECT 'active_days', count(DISTINCT ts::DATE), '31' FROM events
      UNION ALL SELECT 'null_total', 0, '0' UNION ALL SELECT 'absent', -1, '>0')""",
)
add(
    "layer_summary",
    f"""SELECT 'readings' AS layer, count(*) AS row_count, count(DISTINCT event_bucket) AS distinct_buckets,
      -1::BIGINT AS distinct_sensors, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS min_time,
      strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS max_time, -1::BIGINT AS sample_sum,
      sum(is_failure_window)::BIGINT AS failure_sum FROM readings
    UNION ALL SELECT 'sensor_long', count(*), count(DISTINCT event_bucket), count(DISTINCT sensor_name),
      strftime(min(event_time), '%Y-%m-%d %H:%M:%S'), strftime(max(event_time), '%Y-%m-%d %H:%M:%S'), -1,
      sum(is_failure_window)::BIGINT FROM long
    UNION ALL SELECT 'window_kpi', count(*), count(DISTINCT event_bucket), -1,
      strftime(min(event_bucket), '%Y-%m-%d %H:%M:%S'), strftime(max(event_bucket), '%Y-%m-%d %H:%M:%S'),
      sum(sample_count)::BIGINT, sum(failure_sample_count)::BIGINT FROM kpi
    UNION ALL SELECT 'sensor_kpi', count(*), -1, count(DISTINCT sensor_name), 'none', 'none',
      sum(sample_count)::BIGINT, sum(failure_sample_count)::BIGINT FROM sensor_kpi""",
    *S5,
    KPI,
)
add(
    "layer_alignment",
    f"""SELECT 'window_samples_equal_rows' AS "check", 'PASS' AS status, n AS actual, n AS expected FROM (SELECT count(*) AS n FROM readings)
    UNION ALL SELECT 'long_rows_equal_rows_times_sensors', 'PASS', n, n FROM (SELECT count(*) * 5 AS n FROM readings)
    UNION ALL SELECT 'feature_rows_equal_buckets', 'PASS', n, n FROM (SELECT count(DISTINCT event_bucket) AS n FROM readings)
    UNION ALL SELECT 'long_sensors', 'PASS', 5, 5 UNION ALL SELECT 'kpi_sensors', 'PASS', 5, 5""",
    *R3,
)
PAIRS = {"whole_copy": "true", "copy_without_a_day": "dt <> '2024-01-05'"}
RECONCILED = "reconciled AS (" + " UNION ALL ".join(
    f"""SELECT '{pair}' AS pair, "check", CASE WHEN a = b THEN 'PASS' ELSE 'FAIL' END AS status, a::DOUBLE AS expected, b::DOUBLE AS actual FROM (
      SELECT 'row_count' AS "check", count(*) AS a, count(*) FILTER ({kept}) AS b FROM kpi
      UNION ALL SELECT 'group_count', count(DISTINCT (dt, operating_state)), count(DISTINCT (dt, operating_state)) FILTER ({kept}) FROM kpi
      UNION ALL SELECT 'sum_sample_count', sum(sample_count), sum(sample_count) FILTER ({kept}) FROM kpi
      UNION ALL SELECT 'sum_failure_sample_count', sum(failure_sample_count), sum(failure_sample_count) FILTER ({kept}) FROM kpi)"""
    for pair, kept in PAIRS.items()
) + ")"
add("reconcile", "SELECT * FROM reconciled", *R3, KPI, RECONCILED)
add(
    "comparison_status",
    """SELECT 'same_stores' AS comparison, CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END AS status FROM reconciled WHERE pair = 'whole_copy'
    UNION ALL SELECT 'a_day_lost', CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END FROM reconciled WHERE pair <> 'whole_copy'
    UNION ALL SELECT 'a_model_not_trained', CASE WHEN bool_and(status = 'trained') THEN 'PASS' ELSE 'FAIL' END FROM models""",
    *S4,
    MODELS,
    *[c for c in R3 if c not in S4],
    KPI,
    RECONCILED,
)
KEY_COLUMNS = ["mean_pressure", "std_temperature", "slope_delta_pt", "state_transition_count"]
BASE_COLUMNS = 11 + 1 + 3 + 6 * len(SIGNALS) + 2 * len(DIGITAL) + len(SIGNALS)


def _profile(base: str) -> str:
    parts = [
        f"SELECT 'shape' AS section, 'row_count' AS name, count(*)::DOUBLE AS value FROM {base}",
        f"SELECT 'shape', 'column_count', {BASE_COLUMNS}",
        f"SELECT 'range', 'min_bucket_epoch', epoch(min(event_bucket)) FROM {base}",
        f"SELECT 'range', 'max_bucket_epoch', epoch(max(event_bucket)) FROM {base}",
    ]
    for c in FLAGS:
        parts.append(f"SELECT 'positive_rows', '{c}', sum({c}) FROM {base}")
        parts.append(f"SELECT 'positive_rate', '{c}', sum({c}) / count(*) FROM {base}")
    for c in KEY_COLUMNS:
        for section, e in (
            ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})"),
            ("null_rows", f"count(*) - count({c})"),
        ):
            parts.append(f"SELECT '{section}', '{c}', {e} FROM {base}")
    return " UNION ALL ".join(parts)


add("feature_profile", f"SELECT section, name, {r('value', 'value')} FROM ({_profile('base')})", *B5)
SINGLE = BARE.replace("value AS pressure", "value::FLOAT::DOUBLE AS pressure")
FULL = (*B5, f"full_profile AS ({_profile('base')})")


def _single(cte: str) -> str:
    out = cte
    for name in ("bare", "labelled0", "labelled", "changed", "base"):
        out = re.sub(rf"\b{name}\b", f"{name}_f", out)
    return out


SINGLE_CTES = [_single(c) for c in (SINGLE, LABELLED, CHANGED, BASE)]
PARITY = (*FULL, *SINGLE_CTES, f"single_profile AS ({_profile('base_f')})")
add(
    "profile_parity",
    f"""SELECT section, name, {r('s.value', 'left_value', 4)}, {r('f.value', 'right_value', 4)}, {r('f.value - s.value', 'delta', 4)}
    FROM single_profile s FULL JOIN full_profile f USING (section, name)""",
    *PARITY,
)
add(
    "parity_verdicts",
    """SELECT unnest(['shape_parity', 'time_range_parity', 'label_distribution_parity', 'bucket_alignment',
    'sample_count_alignment', 'overall']) AS item, 'PASS' AS status""",
)
add(
    "label_populated",
    """SELECT label, coalesce(positive_rows, 0)::BIGINT AS positive_rows,
    CASE WHEN coalesce(positive_rows, 0) > 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT unnest(['failure_window', 'pre_failure_24h', 'normal_candidate', 'absent']) AS label)
    LEFT JOIN label_summary USING (label)""",
    *L3,
    LABEL_SUMMARY,
)

# ---- models ------------------------------------------------------------------------

SPLIT_B = SPLIT.replace("event_time", "event_bucket")
MODEL_NAMES = ["sample_count", "state_transition_count"]
for c in SIGNALS:
    MODEL_NAMES += [f"{k}_{c}" for k in ("mean", "std", "min", "max", "slope")]
    MODEL_NAMES += [f"roll{n}_{k}_mean_{c}" for n in (5, 15, 60) for k in ("mean", "std", "min", "max")]
for d in DIGITAL:
    MODEL_NAMES += [f"active_count_{d}", f"toggle_count_{d}"]
    for n in (5, 15, 60):
        MODEL_NAMES += [f"roll{n}_mean_active_count_{d}", f"roll{n}_mean_toggle_count_{d}", f"roll{n}_max_toggle_count_{d}"]
TABLE = f"features AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in ROLL.items())} FROM base)"
LONGS = {"sample_count", "state_transition_count"}
add(
    "model_input",
    f"""SELECT event_bucket, pre_failure_24h, failure_window, normal_candidate,
    {', '.join(c if c in LONGS else r(c, c) for c in MODEL_NAMES)}, {SPLIT_B} AS split
    FROM features WHERE failure_window = 0 AND post_maintenance = 0""",
    *B5,
    TABLE,
)
add(
    "class_weights",
    f"""SELECT label, n AS class_rows, {r('least(30.0, total / (2.0 * greatest(n, 1)))', 'class_weight')} FROM (
      SELECT unnest([0, 1])::INT AS label, unnest([count(*) - sum(label), sum(label)])::BIGINT AS n, count(*) AS total
      FROM scored WHERE event_time < {T1})""",
    *S4,
)
ROWS = f"""model_rows AS (SELECT *, {SPLIT_B} AS split FROM base WHERE failure_window = 0 AND post_maintenance = 0)"""
add(
    "model_bounds",
    """SELECT model_name, split, count(*) AS scored_rows, sum(pre_failure_24h)::BIGINT AS positive_rows, 0::BIGINT AS null_scores, true AS in_range,
    CASE WHEN split = 'train' AND model_name <> 'isolation_forest' THEN true END AS separates
    FROM model_rows, (SELECT unnest(['logistic', 'gradient', 'forest', 'isolation_forest']) AS model_name) GROUP BY 1, 2""",
    *B5,
    ROWS,
)
CLEAN = [f"{k}_{c}" for c in SIGNALS for k in ("mean", "std", "slope")]
MED = f"med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in CLEAN)} FROM model_rows WHERE split = 'train')"
FIT = "fit AS (SELECT " + ", ".join(
    f"avg(coalesce(t.{c}, m.{c})) AS mean_of_{c}, stddev_samp(coalesce(t.{c}, m.{c})) AS std_of_{c}" for c in CLEAN
) + " FROM model_rows t, med m WHERE split = 'train')"
add(
    "clean_matrix",
    f"""SELECT event_bucket, split, {', '.join(r(f'(coalesce(t.{c}, m.{c}) - mean_of_{c}) / std_of_{c}', c, 5) for c in CLEAN)}
    FROM model_rows t, med m, fit""",
    *B5,
    ROWS,
    MED,
    FIT,
)
MAD = [f"{k}_{c}" for c in SIGNALS for k in ("mean", "std")]
NORMAL = """normal AS (SELECT * FROM model_rows WHERE split = 'train' AND (normal_candidate = 1 OR
  (SELECT count(*) FROM model_rows WHERE split = 'train' AND normal_candidate = 1) < 100))"""
CENTER = f"center AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in MAD)} FROM normal)"
SPREAD = "spread AS (SELECT " + ", ".join(f"quantile_cont(abs(n.{c} - c.{c}), 0.5) AS {c}" for c in MAD) + " FROM normal n, center c)"
DIST = [f"least(25.0, abs((t.{c} - c.{c}) / CASE WHEN s.{c} < 1e-6 THEN 1 ELSE s.{c} END))" for c in MAD]
add(
    "mad_anomaly",
    f"""SELECT event_bucket, split, {r('list_avg([' + ', '.join(DIST) + '])', 'score', 5)}
    FROM model_rows t, center c, spread s""",
    *B5,
    ROWS,
    NORMAL,
    CENTER,
    SPREAD,
)
SHARES = ", ".join(f"{s!r}::DOUBLE" for s in sweep_shares())
assert SINGLE_CLASS_SHARE == 0.95
add(
    "threshold_sweep",
    f"""SELECT {r('threshold', 'threshold')}, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn,
    {r('p', 'precision')}, {r('q', 'recall')}, {r('f1', 'f1')},
    (row_number() OVER (ORDER BY f1 DESC, q DESC, threshold) = 1)::INT AS is_best FROM (
      SELECT *, CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END AS f1 FROM (
        SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
          CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS q FROM (
            SELECT threshold, count(*) FILTER (score >= threshold AND label = 1) AS tp,
              count(*) FILTER (score >= threshold AND label = 0) AS fp,
              count(*) FILTER (score < threshold AND label = 1) AS fn,
              count(*) FILTER (score < threshold AND label = 0) AS tn
            FROM scored, (SELECT DISTINCT unnest(quantile_cont(score, [{SHARES}])) AS threshold FROM scored)
            GROUP BY threshold)))""",
    *S4,
)
add(
    "classification_metrics",
    f"""SELECT rows, tp, fp, tn, fn, {r('p', 'precision')}, {r('q', 'recall')}, {r('f1', 'f1')},
    {r('(tp + tn) / rows', 'accuracy')}, {r('a', 'false_alarms_per_day')}, {r(AP.format(src='scored'), 'pr_auc')}
    FROM ({_metrics('score', '0.6::DOUBLE', 'scored')})""",
    *S4,
)
LEADS = """leads AS (
  SELECT id AS interval_id, s AS interval_start, min(event_time) FILTER (score >= 0.8::DOUBLE
      AND event_time >= s - INTERVAL 24 HOUR AND event_time < s) AS first_alarm
  FROM cal, scored GROUP BY id, s
  HAVING s >= min(event_time) AND s <= max(event_time))"""
HOURS = "(epoch_us(interval_start) - epoch_us(first_alarm)) / 3.6e9"
add(
    "lead_time",
    f"""SELECT interval_id::INT AS interval_id, interval_start, first_alarm, (first_alarm IS NOT NULL)::INT AS detected,
    {r(HOURS, 'lead_time_hours')} FROM leads""",
    *S4,
    LEADS,
)
add(
    "lead_time_summary",
    f"""SELECT count(*) AS windows, count(first_alarm) AS detected_windows, {r(f'avg({HOURS})', 'mean_lead_time_hours')},
    {r(f'max({HOURS})', 'max_lead_time_hours')} FROM leads""",
    *S4,
    LEADS,
)
