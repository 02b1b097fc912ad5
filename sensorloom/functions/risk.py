"""Rule-based risk score, reasons, level and metadata as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom.compressor import COMPRESSOR
from sensorloom.functions.scalars import clip, day_text, finite_or, null_if_not_finite


@dataclass(frozen=True)
class RiskRules:
    """Fixed values of the score: roles, component scales, weights and thresholds."""

    discharge: str = "tp2"
    panel: str = "tp3"
    reservoir: str = "reservoirs"
    oil: str = "oil_temperature"
    current: str = "motor_current"
    digital: tuple[str, ...] = tuple(COMPRESSOR.digital)
    gap_weight: float = 0.05
    pressure_scale: float = 2.0
    oil_floor: float = 55.0
    oil_scale: float = 20.0
    current_floor: float = 6.5
    current_scale: float = 4.0
    base: float = 0.12
    pressure_weight: float = 0.36
    oil_weight: float = 0.28
    current_weight: float = 0.18
    digital_weight: float = 0.06
    high: float = 0.5636003790254064
    medium: float = 0.40
    delta_alarm: float = 0.35
    gap_alarm: float = 2.0
    oil_alarm: float = 60.0
    current_alarm: float = 7.5
    component_alarm: float = 0.25


@dataclass(frozen=True)
class ScorerInfo:
    """Metadata stamped on every scored event."""

    equipment_id: str = "compressor_1"
    score_source: str = "signal_rules"
    model_name: str = "signal_rules"
    model_version: str = "1"
    feature_set_version: str = "raw_event_v1"
    feature_window_minutes: Sequence[int] = field(default=(1, 5, 15, 60))


PRESSURE_REASON = "pressure_balance_shift"
OIL_REASON = "oil_temperature_elevated"
CURRENT_REASON = "motor_current_elevated"
BASELINE_REASON = "baseline_signal_level"


def _balance(rules: RiskRules) -> tuple[Column, Column]:
    panel = finite_or(F.col(rules.panel))
    delta = F.abs(panel - finite_or(F.col(rules.reservoir)))
    gap = F.abs(finite_or(F.col(rules.discharge)) - panel)
    return delta, gap


def components(rules: RiskRules = RiskRules()) -> dict[str, Column]:
    """Pressure, oil, current and digital components, each clipped to [0, 1]."""
    delta, gap = _balance(rules)
    oil = finite_or(F.col(rules.oil))
    current = finite_or(F.col(rules.current))
    active = sum((finite_or(F.col(name)) for name in rules.digital), F.lit(0.0))
    return {
        "pressure_component": clip((delta + gap * rules.gap_weight) / rules.pressure_scale),
        "oil_component": clip((oil - rules.oil_floor) / rules.oil_scale),
        "current_component": clip((current - rules.current_floor) / rules.current_scale),
        "digital_component": clip(active / max(len(rules.digital), 1)),
    }


def raw_score(rules: RiskRules = RiskRules()) -> Column:
    parts = components(rules)
    return clip(
        F.lit(rules.base)
        + rules.pressure_weight * parts["pressure_component"]
        + rules.oil_weight * parts["oil_component"]
        + rules.current_weight * parts["current_component"]
        + rules.digital_weight * parts["digital_component"]
    )


def score(rules: RiskRules = RiskRules()) -> Column:
    """The stream form: rounded to six places."""
    return F.round(raw_score(rules), 6)


def alarm_reasons(rules: RiskRules = RiskRules()) -> Column:
    """Comma-joined reasons by raw thresholds (stream form)."""
    delta, gap = _balance(rules)
    joined = F.concat_ws(
        ",",
        F.when((delta > rules.delta_alarm) | (gap > rules.gap_alarm), PRESSURE_REASON),
        F.when(finite_or(F.col(rules.oil)) > rules.oil_alarm, OIL_REASON),
        F.when(finite_or(F.col(rules.current)) > rules.current_alarm, CURRENT_REASON),
    )
    return F.when(joined == "", F.lit(BASELINE_REASON)).otherwise(joined)


def component_reasons(rules: RiskRules = RiskRules()) -> Column:
    """Array of reasons by component size (contract form)."""
    parts = components(rules)
    found = F.array_compact(
        F.array(
            F.when(parts["pressure_component"] >= rules.component_alarm, PRESSURE_REASON),
            F.when(parts["oil_component"] >= rules.component_alarm, OIL_REASON),
            F.when(parts["current_component"] >= rules.component_alarm, CURRENT_REASON),
        )
    )
    return F.when(F.size(found) == 0, F.array(F.lit(BASELINE_REASON))).otherwise(found)


def level(value: Column, rules: RiskRules = RiskRules()) -> Column:
    return (
        F.when(value >= rules.high, F.lit("high"))
        .when(value >= rules.medium, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


@dataclass(frozen=True)
class SourceTags:
    """What consumers of scores expect to read about where a score is from."""

    given: str = "provided_risk_score"
    model: str = "model_score"
    rules: str = "signal_rules"
    given_reason: str = "passed_through_existing_risk_score"
    model_reason: str = "passed_through_model_score"


def passthrough(
    given: Column | None = None,
    model: Column | None = None,
    rules: RiskRules = RiskRules(),
    tags: SourceTags = SourceTags(),
) -> tuple[Column, Column, Column]:
    """(score, reasons, source): a given score, else a model score, else the rules.

    The score is clipped and not rounded, so a level taken from it uses the exact value.
    """
    none = F.lit(None).cast("double")
    first = none if given is None else null_if_not_finite(given)
    second = none if model is None else null_if_not_finite(model)
    value = clip(F.coalesce(first, second, raw_score(rules)))
    reasons = (
        F.when(first.isNotNull(), F.array(F.lit(tags.given_reason)))
        .when(second.isNotNull(), F.array(F.lit(tags.model_reason)))
        .otherwise(component_reasons(rules))
    )
    source = (
        F.when(first.isNotNull(), F.lit(tags.given))
        .when(second.isNotNull(), F.lit(tags.model))
        .otherwise(F.lit(tags.rules))
    )
    return value, reasons, source


def metadata(
    info: ScorerInfo,
    time: str = "event_time",
    scoring_time: Column | None = None,
    rules: RiskRules = RiskRules(),
) -> list[Column]:
    """Scorer identity, threshold and feature-window columns."""
    stamp = F.current_timestamp() if scoring_time is None else scoring_time
    return [
        F.lit(info.equipment_id).alias("equipment_id"),
        F.lit(info.score_source).alias("risk_score_source"),
        F.lit(info.model_name).alias("risk_model_name"),
        F.lit(info.model_version).alias("risk_model_version"),
        F.lit(info.model_version).alias("model_version"),
        F.lit(rules.high).alias("risk_threshold"),
        F.array(*[F.lit(int(m)) for m in info.feature_window_minutes]).alias("feature_window_minutes"),
        F.col(time).alias("feature_window_end"),
        F.lit(info.feature_set_version).alias("model_feature_set_version"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("scoring_time"),
        day_text(F.col(time)).alias("dt"),
    ]
