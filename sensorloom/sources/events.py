"""JSON events: encoding readings, decoding payloads, streaming sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import intervals
from sensorloom.functions.gates import contract_errors, field_facts
from sensorloom.functions.scalars import band, finite_or
from sensorloom.spec import Calendar, SensorSpec

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: Fractions of a second are read if they are there.
READ_FORMAT = f"{TIME_FORMAT}[.SSSSSS]"
CORRUPT = "_corrupt"


def event_schema(spec: SensorSpec) -> T.StructType:
    """Identity, two times, source, state, label and one double per sensor."""
    fields = [
        T.StructField("event_id", T.StringType()),
        T.StructField(spec.row_id, T.LongType()),
        T.StructField(spec.time, T.TimestampNTZType()),
        T.StructField("ingest_time", T.TimestampNTZType()),
        T.StructField("source", T.StringType()),
        T.StructField(spec.state, T.StringType()),
        T.StructField(spec.flag, T.IntegerType()),
        T.StructField(spec.label, T.StringType()),
        *[T.StructField(n, T.DoubleType()) for n in spec.names],
    ]
    return T.StructType(fields)


def event_columns(
    readings: DataFrame, spec: SensorSpec, calendar: Calendar, prefix: str, source: str, ingest_time: Column
) -> DataFrame:
    """The fields of an event: finite sensors, state from them, first matching incident."""
    time = F.col(spec.time)
    finite = readings.withColumns({n: finite_or(F.col(n)) for n in spec.names})
    return finite.filter(time.isNotNull()).select(
        F.concat(F.lit(f"{prefix}-"), F.col(spec.row_id).cast("string")).alias("event_id"),
        F.col(spec.row_id),
        F.date_format(time, TIME_FORMAT).alias(spec.time),
        F.date_format(ingest_time, TIME_FORMAT).alias("ingest_time"),
        F.lit(source).alias("source"),
        band(F.col(spec.bands.source), spec.bands).alias(spec.state),
        intervals.flag(intervals.in_any(time, calendar)).alias(spec.flag),
        intervals.interval_type(time, calendar, on_overlap="first").alias(spec.label),
        *spec.names,
    )


def encode_events(events: DataFrame) -> DataFrame:
    """One JSON text per event, keyed by event id (the shape a message broker takes)."""
    return events.select(
        F.col("event_id").alias("key"), F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value")
    )


def decode_events(payloads: DataFrame, spec: SensorSpec, value: str = "value") -> DataFrame:
    """Typed events; an unparsable field is null, an unparsable text is kept in ``_corrupt``."""
    schema = event_schema(spec).add(CORRUPT, T.StringType())
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "timestampNTZFormat": READ_FORMAT,
    }
    extra = [c for c in payloads.columns if c != value]
    text = F.col(value).cast("string")
    # inline() parses each text once: filters on its columns are not pushed into the parser
    parsed = F.array(F.from_json(text, schema, options))
    return payloads.select(*extra, text.alias("payload_text"), F.inline(parsed))


def validate_contract(payloads: DataFrame, spec: SensorSpec, value: str = "value") -> DataFrame:
    """Add the list of contract violations and a valid/invalid status."""
    # each inline() is evaluated once per row: one parse, then one look at every field
    parsed = payloads.select("*", F.inline(F.array(F.struct(F.try_parse_json(F.col(value)).alias("_v")))))
    facts = parsed.select(*payloads.columns, F.inline(F.array(field_facts(F.col("_v"), spec))))
    out = facts.select(*payloads.columns, contract_errors(spec).alias("errors"))
    return out.withColumn("status", F.when(F.size("errors") == 0, "valid").otherwise("invalid"))


def contract_summary(validated: DataFrame) -> DataFrame:
    return validated.agg(
        F.count("*").alias("total"),
        F.count(F.when(F.col("status") == "invalid", 1)).alias("invalid"),
        F.count(F.when(F.col("status") == "valid", 1)).alias("valid"),
    )


# earliest and latest read the whole topic or only new records; "group" resumes from the
# query checkpoint, which is where Structured Streaming keeps consumer positions, and a
# first start without one reads the backlog
_START = {"earliest": "earliest", "latest": "latest", "group": "earliest"}


def kafka_source(
    spark: SparkSession, servers: str, topic: str, start: str = "group", options: dict[str, str] | None = None
) -> DataFrame:
    """Streaming payloads from a topic (needs the Kafka connector on the class path)."""
    if start not in _START:
        raise ValueError(f"start is one of {sorted(_START)}")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", _START[start])
        .option("failOnDataLoss", "true")
    )
    for key, val in (options or {}).items():
        reader = reader.option(key, val)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming payloads from JSON-lines files."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
