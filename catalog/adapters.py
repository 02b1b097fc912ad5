"""Given tables seen as sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.compressor import COMPRESSOR
from sensorloom.operators.normalize import with_deltas, with_interval_label, with_state, with_time_columns
from sensorloom.sources.events import encode_events, event_columns
from sensorloom.spec import ANALOG, DIGITAL, Calendar, Delta, Sensor, SensorSpec, StateBands

EVENTS = SensorSpec(
    sensors=(
        Sensor("pressure", ANALOG, "bar", "plant"),
        Sensor("temperature", ANALOG, "celsius", "plant"),
        Sensor("d_error", DIGITAL, "binary", "control"),
        Sensor("d_click", DIGITAL, "binary", "control"),
        Sensor("d_view", DIGITAL, "binary", "control"),
    ),
    bands=StateBands("pressure", ((70.0, "loaded"), (15.0, "unloaded")), "stopped"),
    deltas=(Delta("delta_pt", "pressure", "temperature"),),
    key_digital=("d_error", "d_click", "d_view"),
    bucket="event_bucket",
    bucket_unit="hour",
)
WIDE = SensorSpec(
    sensors=(
        Sensor("l_quantity", ANALOG),
        Sensor("l_extendedprice", ANALOG),
        Sensor("l_discount", ANALOG),
        Sensor("l_tax", ANALOG),
        Sensor("d_returned", DIGITAL),
        Sensor("d_final", DIGITAL),
    ),
    bands=StateBands("l_quantity", ((35.0, "loaded"), (10.0, "unloaded")), "stopped"),
    bucket="event_bucket",
    bucket_unit="day",
)
CALENDAR = Calendar.of(
    [
        ("2024-01-05 00:00:00", "2024-01-05 23:59:59", "leak_a_high"),
        ("2024-01-12 23:30:00", "2024-01-13 06:00:00", "leak_b_high"),
        ("2024-01-18 10:00:00", "2024-01-20 14:30:00", "leak_c"),
        ("2024-01-27 14:30:00", "2024-01-27 19:00:00", "leak_d"),
    ]
)
OVERLAPPING = Calendar.of(
    [
        ("2024-01-05 00:00:00", "2024-01-07 00:00:00", "wide"),
        ("2024-01-06 00:00:00", "2024-01-06 12:00:00", "inner"),
        ("2024-01-06 10:00:00", "2024-01-09 00:00:00", "late"),
    ]
)
ORDER_SPAN_SECONDS = 30 * 86_400
TRAIN_END = "2024-01-16 00:00:00"
VALID_END = "2024-01-23 00:00:00"
INGEST = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is(kind: str) -> Column:
    return (F.col("event_type") == kind).cast("int").cast("double")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def bare_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as readings of two analog and three digital sensors."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("raw_index"),
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("equipment_id"),
        F.col("value").alias("pressure"),
        _k().alias("temperature"),
        _is("error").alias("d_error"),
        _is("click").alias("d_click"),
        _is("view").alias("d_view"),
    )


def readings(spark: SparkSession, sf_dir: str, calendar: Calendar = CALENDAR) -> DataFrame:
    """Readings with time columns, state, incident label and delta."""
    out = with_state(with_time_columns(bare_readings(spark, sf_dir), EVENTS), EVENTS)
    return with_deltas(with_interval_label(out, EVENTS, calendar), EVENTS)


def wide_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as readings of six sensors, by day."""
    out = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("raw_index"),
        F.col("l_shipdate").alias("event_time"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        (F.col("l_returnflag") == "R").cast("int").cast("double").alias("d_returned"),
        (F.col("l_linestatus") == "F").cast("int").cast("double").alias("d_final"),
    )
    failed = (F.col("l_discount") > 0.08).cast("int")
    return with_state(with_time_columns(out, WIDE), WIDE).withColumn("is_failure_window", failed)


def compressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as readings of the 15-sensor compressor, at whole seconds."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        i.alias("raw_index"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("event_time"),
        (F.col("value") / 10.0).alias("tp2"),
        (8.0 + _k() / 50.0).alias("tp3"),
        (8.0 + (i % 7) / 10.0).alias("h1"),
        ((i % 5) / 10.0 - 0.2).alias("dv_pressure"),
        (8.0 + (i * 13 % 200) / 100.0).alias("reservoirs"),
        (50.0 + F.col("value") / 5.0).alias("oil_temperature"),
        (F.col("value") / 10.0).alias("motor_current"),
        _is("click").alias("comp"),
        _is("error").alias("dv_electric"),
        _is("view").alias("towers"),
        (i % 2).cast("double").alias("mpg"),
        (i % 3 == 0).cast("int").cast("double").alias("lps"),
        (F.col("user_id") % 2).cast("double").alias("pressure_switch"),
        (i % 11 == 0).cast("int").cast("double").alias("oil_level"),
        _is("signup").alias("caudal_impulses"),
    )


RAW_HEADERS = {std: raw for raw, std in COMPRESSOR.aliases.items() if raw != "DV_electric"}


def raw_text(spark: SparkSession, sf_dir: str, with_index: bool = True) -> DataFrame:
    """The compressor readings as text under raw headers, with faults by rule:
    every 97th time, every 89th TP2 and every 83rd current is broken."""
    c = compressor(spark, sf_dir)
    i = F.col("raw_index")
    time = F.when(i % 97 == 0, F.lit("not-a-time")).otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    text = {n: F.col(n).cast("string") for n in COMPRESSOR.names}
    text["tp2"] = F.when(i % 89 == 0, F.lit("bad")).otherwise(text["tp2"])
    text["motor_current"] = F.when(i % 83 == 0, F.lit("NaN")).otherwise(text["motor_current"])
    index = [i.cast("string").alias("_c0")] if with_index else []
    return c.select(*index, time.alias("timestamp"), *[text[n].alias(RAW_HEADERS[n]) for n in COMPRESSOR.names])


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event fields of the compressor readings."""
    return event_columns(
        compressor(spark, sf_dir), COMPRESSOR, CALENDAR, "reading", "replay", F.lit(INGEST).cast("timestamp_ntz")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events with faults by rule: every 97th id is null, every 89th state unknown,
    every 83rd text cut off."""
    i = F.col("raw_index")
    faulty = clean_events(spark, sf_dir).withColumns(
        {
            "event_id": F.when(i % 97 == 0, F.lit(None)).otherwise(F.col("event_id")),
            "operating_state": F.when(i % 89 == 0, F.lit("broken")).otherwise(F.col("operating_state")),
        }
    )
    cut = encode_events(faulty).select("value").withColumn("_i", F.get_json_object("value", "$.raw_index").cast("long"))
    return cut.select(F.when(F.col("_i") % 83 == 0, F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores outside incidents and recovery; the label is the 24-hour horizon."""
    from sensorloom.operators.evaluate import model_rows
    from sensorloom.operators.features import horizon_labels

    rows = model_rows(horizon_labels(bare_readings(spark, sf_dir), EVENTS, CALENDAR))
    score = F.col("pressure") / (F.col("pressure") + 50.0)
    return rows.select("raw_index", "event_time", score.alias("score"), F.col("pre_failure_24h").alias("label"))


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an incident of one piece of equipment: up to two hours within the days of the events, many overlap."""
    key = F.col("o_orderkey")
    seconds = lambda n: F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + seconds(key * 7919 % ORDER_SPAN_SECONDS)
    rows = table(spark, sf_dir, "orders").select(
        key.alias("interval_id"), F.expr("o_custkey div 10").alias("equipment_id"), start.alias("start"), F.concat(F.lit("kind_"), (key % 5).cast("string")).alias("interval_type")
    )
    return rows.withColumn("end", F.col("start") + seconds(F.col("interval_id") * 31 % 7200))
