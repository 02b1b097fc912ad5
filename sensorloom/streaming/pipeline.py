"""Structured Streaming transformations; each one also runs on a static frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import risk
from sensorloom.functions.gates import Rule, reject_reason
from sensorloom.functions.scalars import bucket_text, day_text
from sensorloom.spec import SensorSpec

KPI_AVERAGES = ("tp2", "tp3", "reservoirs", "oil_temperature", "motor_current")
WATERMARK = "5 seconds"


def gated(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reason``: null for valid events, else the first broken rule."""
    return events.withColumn("reason", reject_reason(rules))


def accepted(gate: DataFrame) -> DataFrame:
    return gate.filter(F.col("reason").isNull()).drop("reason", "_corrupt", "payload_text")


def rejected(gate: DataFrame, spec: SensorSpec, write_time: Column | None = None) -> DataFrame:
    """Dead-letter rows: reason, identity, a short payload and the raw text."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("null"))

    payload = F.concat(
        F.lit("source="), shown("source"), F.lit(",state="), shown(spec.state), F.lit(",failure_type="), shown(spec.label)
    )
    stamp = F.current_timestamp() if write_time is None else write_time
    raw = F.col("payload_text") if "payload_text" in gate.columns else F.lit(None).cast("string")
    return gate.filter(F.col("reason").isNotNull()).select(
        "reason",
        "event_id",
        F.col(spec.row_id).cast("string").alias(spec.row_id),
        payload.alias("payload"),
        raw.alias("raw_text"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("write_time"),
    )


def readings_with_day(valid: DataFrame, spec: SensorSpec) -> DataFrame:
    return valid.withColumn(spec.day, day_text(F.col(spec.time)))


def _kpi_columns(spec: SensorSpec, averages: Sequence[str]) -> list[Column]:
    failed = F.sum(F.when(F.col(spec.flag) == 1, 1).otherwise(0))
    return [
        F.count(F.lit(1)).alias("sample_count"),
        failed.alias("failure_sample_count"),
        (failed.cast("double") / F.count(F.lit(1))).alias("failure_window_rate"),
        *[F.avg(c).alias(f"avg_{c}") for c in averages],
    ]


def _watermarked(rows: DataFrame, time: str, delay: str) -> DataFrame:
    # watermarks are defined on zoned timestamps only
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def minute_kpi(
    valid: DataFrame,
    spec: SensorSpec,
    time: str,
    averages: Sequence[str] = KPI_AVERAGES,
    width: str = "1 minute",
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """Tumbling-window KPI by state on any time column (event or arrival time)."""
    source = _watermarked(valid, time, watermark) if watermark and valid.isStreaming else valid
    state = F.coalesce(F.col(spec.state), F.lit("unknown")).alias(spec.state)
    grouped = source.groupBy(F.window(F.col(time), width).alias("_w"), state)
    start = F.col("_w.start")
    return (
        grouped.agg(*_kpi_columns(spec, averages))
        .withColumns({"minute_bucket": bucket_text(start), spec.day: day_text(start)})
        .drop("_w")
    )


def arrival_kpi(valid: DataFrame, spec: SensorSpec, averages: Sequence[str] = KPI_AVERAGES) -> DataFrame:
    """The KPI by arrival: windows on the time the event is processed."""
    stamped = valid.withColumn("_arrival", F.current_timestamp())
    return minute_kpi(stamped, spec, "_arrival", averages)


def deduplicated(valid: DataFrame, spec: SensorSpec, watermark: str = "1 hour") -> DataFrame:
    """Drop repeats of an event id; state is kept only as long as the watermark needs."""
    if not valid.isStreaming:
        return valid.dropDuplicates(["event_id"])
    marked = _watermarked(valid, spec.time, watermark).dropDuplicatesWithinWatermark(["event_id"])
    return marked.withColumn(spec.time, F.col(spec.time).cast(valid.schema[spec.time].dataType))


def scored(
    valid: DataFrame,
    spec: SensorSpec,
    rules: risk.RiskRules = risk.RiskRules(),
    info: risk.ScorerInfo = risk.ScorerInfo(),
    scoring_time: Column | None = None,
) -> DataFrame:
    """Risk events: score, level, reasons and metadata; scores outside [0, 1] are dropped."""
    keep = ["event_id", spec.row_id, spec.time, "ingest_time", "source", spec.state, spec.flag, spec.label]
    # inline() computes the pair once per row; the filter and the level read the result
    made = F.struct(risk.score(rules).alias("risk_score"), risk.alarm_reasons(rules).alias("risk_reason"))
    base = valid.select(*keep, *spec.analog, F.inline(F.array(made)))
    base = base.filter(F.col("risk_score").between(0.0, 1.0))
    meta = risk.metadata(info, spec.time, scoring_time, rules)
    return base.select(
        *keep,
        *spec.analog,
        "risk_score",
        risk.level(F.col("risk_score"), rules).alias("risk_level"),
        "risk_reason",
        *meta,
    ).withColumn("feature_window_minutes", F.concat_ws(",", F.col("feature_window_minutes").cast("array<string>")))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of every key; partial aggregation first, so a hot key costs one row
    per task."""
    payload = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*order)).alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_v.*")
