"""Ready-made description of a 15-sensor air compressor."""

from __future__ import annotations

from sensorloom.spec import ANALOG, DIGITAL, Calendar, Delta, Sensor, SensorSpec, StateBands

# Sensor names, units, stations, header spellings, state bands and the
# incident calendar that the results depend on.
_SENSORS = (
    Sensor("tp2", ANALOG, "bar", "air_pressure_path"),
    Sensor("tp3", ANALOG, "bar", "air_pressure_path"),
    Sensor("h1", ANALOG, "bar", "air_pressure_path"),
    Sensor("dv_pressure", ANALOG, "bar", "air_pressure_path"),
    Sensor("reservoirs", ANALOG, "bar", "air_pressure_path"),
    Sensor("oil_temperature", ANALOG, "celsius", "compressor_motor"),
    Sensor("motor_current", ANALOG, "ampere", "compressor_motor"),
    Sensor("comp", DIGITAL, "binary", "electrical_control"),
    Sensor("dv_electric", DIGITAL, "binary", "electrical_control"),
    Sensor("towers", DIGITAL, "binary", "electrical_control"),
    Sensor("mpg", DIGITAL, "binary", "electrical_control"),
    Sensor("lps", DIGITAL, "binary", "electrical_control"),
    Sensor("pressure_switch", DIGITAL, "binary", "electrical_control"),
    Sensor("oil_level", DIGITAL, "binary", "electrical_control"),
    Sensor("caudal_impulses", DIGITAL, "binary", "electrical_control"),
)
HEADER_ALIASES = {
    "timestamp": "event_time_raw",
    "TP2": "tp2",
    "TP3": "tp3",
    "H1": "h1",
    "DV_pressure": "dv_pressure",
    "Reservoirs": "reservoirs",
    "Oil_temperature": "oil_temperature",
    "Motor_current": "motor_current",
    "COMP": "comp",
    "DV_eletric": "dv_electric",
    "DV_electric": "dv_electric",
    "Towers": "towers",
    "MPG": "mpg",
    "LPS": "lps",
    "Pressure_switch": "pressure_switch",
    "Oil_level": "oil_level",
    "Caudal_impulses": "caudal_impulses",
}
COMPRESSOR = SensorSpec(
    sensors=_SENSORS,
    bands=StateBands("motor_current", ((7.0, "loaded"), (1.0, "unloaded")), "stopped"),
    deltas=(
        Delta("delta_tp3_reservoirs", "tp3", "reservoirs"),
        Delta("delta_tp2_tp3", "tp2", "tp3"),
    ),
    key_digital=("comp", "dv_electric", "mpg", "lps", "pressure_switch", "oil_level"),
    aliases=HEADER_ALIASES,
)
INCIDENTS = Calendar.of(
    [
        ("2020-04-18 00:00:00", "2020-04-18 23:59:59", "air_leak_high_stress"),
        ("2020-05-29 23:30:00", "2020-05-30 06:00:00", "air_leak_high_stress"),
        ("2020-06-05 10:00:00", "2020-06-07 14:30:00", "air_leak_high_stress"),
        ("2020-07-15 14:30:00", "2020-07-15 19:00:00", "air_leak_high_stress"),
    ]
)
TRAIN_END = "2020-06-01 00:00:00"
VALID_END = "2020-07-01 00:00:00"
