"""Bucket feature table: state changes, per-bucket statistics, slopes, rolling frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import intervals
from sensorloom.functions.scalars import bucket_start, epoch_micros, one_hot
from sensorloom.operators import calendars
from sensorloom.operators.normalize import with_deltas, with_state
from sensorloom.operators.ordered import Order, with_previous
from sensorloom.operators.rolling import Stat, with_rolling
from sensorloom.spec import Calendar, SensorSpec

FLAGS = (
    "failure_window",
    "pre_failure_1h",
    "pre_failure_6h",
    "pre_failure_24h",
    "post_maintenance",
    "normal_candidate",
)
SEQUENCE = "row_sequence"
FRAMES = (1, 5, 15, 60)
QUANTILE_FRAMES = (15, 60)
NEVER_FEATURES = frozenset({*FLAGS, "rul_seconds", "window_start", "window_end", "failure_type"})


def horizon_labels(df: DataFrame, spec: SensorSpec, calendar: Calendar | DataFrame, post_hours: int = 24) -> DataFrame:
    """Weak labels by incident calendar: membership, horizons, recovery, remaining time.

    A configured calendar compiles to expressions; a table of incidents, per key of the spec or for all, is merged in.
    """
    if isinstance(calendar, DataFrame):
        return calendars.labels_by_table(df, calendar, row_order(spec), (1, 6, 24), post_hours)
    time = F.col(spec.time)
    out = df.withColumns(
        {
            "failure_window": intervals.flag(intervals.in_any(time, calendar)),
            "pre_failure_1h": intervals.flag(intervals.before_start(time, calendar, 1)),
            "pre_failure_6h": intervals.flag(intervals.before_start(time, calendar, 6)),
            "pre_failure_24h": intervals.flag(intervals.before_start(time, calendar, 24)),
            "post_maintenance": intervals.flag(intervals.after_end(time, calendar, post_hours)),
            "failure_type": intervals.interval_type(time, calendar),
            "rul_seconds": intervals.seconds_to_start(time, calendar),
        }
    )
    at_risk = F.greatest("failure_window", "pre_failure_24h", "post_maintenance")
    return out.withColumn("normal_candidate", F.lit(1) - at_risk)


def label_segment() -> Column:
    """One exclusive segment per row, by priority of the nested labels."""
    return (
        F.when(F.col("failure_window") == 1, "failure_window")
        .when(F.col("pre_failure_1h") == 1, "pre_failure_1h")
        .when(F.col("pre_failure_6h") == 1, "pre_failure_6h_only")
        .when(F.col("pre_failure_24h") == 1, "pre_failure_24h_only")
        .when(F.col("post_maintenance") == 1, "post_maintenance")
        .when(F.col("normal_candidate") == 1, "normal_candidate")
        .otherwise("other")
    )


def row_order(spec: SensorSpec) -> Order:
    return Order(spec.time, spec.row_id, spec.by)


def with_changes(df: DataFrame, spec: SensorSpec) -> DataFrame:
    """State transition flag and absolute digital changes against the previous row.

    The first row counts as a transition and has no toggles; borders of buckets, days and
    slices do not reset either.
    """
    seen = with_previous(df, row_order(spec), [spec.state, *spec.digital], "_prev", SEQUENCE)
    same = F.col(spec.state).eqNullSafe(F.col(f"_prev.{spec.state}"))
    changed = F.when(F.col("_prev").isNull() | ~same, F.lit(1)).otherwise(F.lit(0))
    toggles = {
        f"toggle_{d}": F.coalesce(F.abs(F.col(d) - F.col(f"_prev.{d}")), F.lit(0.0)) for d in spec.digital
    }
    return seen.withColumns({"state_transition_flag": changed, **toggles}).drop("_prev")


def _first_last(name: str) -> list[Column]:
    # a long keeps the buffers fixed-width, so the aggregation stays hash-based
    moment = F.when(F.col(name).isNotNull(), F.col(SEQUENCE))
    return [
        F.min_by(name, moment).alias(f"first_{name}"),
        F.max_by(name, moment).alias(f"last_{name}"),
    ]


def bucket_features(changed: DataFrame, spec: SensorSpec) -> DataFrame:
    """Per-bucket statistics of labelled rows that carry the change columns."""
    time = F.col(spec.time)
    signals: list[Column] = []
    for name in spec.signals:
        signals += [
            F.avg(name).alias(f"mean_{name}"),
            F.stddev_samp(name).alias(f"std_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.max(name).alias(f"max_{name}"),
            *_first_last(name),
        ]
    digital = []
    for name in spec.digital:
        digital += [
            F.coalesce(F.sum(name), F.lit(0.0)).alias(f"active_count_{name}"),
            F.sum(f"toggle_{name}").alias(f"toggle_count_{name}"),
        ]
    states = one_hot(F.col(spec.state), spec.bands.states, "state_")
    prepared = changed.select("*", *states)
    return prepared.groupBy(*spec.by, spec.bucket).agg(
        F.count("*").alias("sample_count"),
        F.min(time).alias("window_start"),
        F.max(time).alias("window_end"),
        *[F.max(f).alias(f) for f in FLAGS],
        F.min("rul_seconds").alias("rul_seconds"),
        F.sum("state_transition_flag").alias("state_transition_count"),
        *[F.sum(f"state_{s}").alias(f"state_{s}_count") for s in spec.bands.states],
        *signals,
        *digital,
    )


def with_slopes(buckets: DataFrame, spec: SensorSpec) -> DataFrame:
    """(last - first) per second of the bucket's span; null for a span of zero."""
    span = (epoch_micros(F.col("window_end")) - epoch_micros(F.col("window_start"))) / F.lit(1e6)
    usable = F.when(span != 0, span)
    return buckets.withColumns(
        {f"slope_{n}": (F.col(f"last_{n}") - F.col(f"first_{n}")) / usable for n in spec.signals}
    )


def prepare_rows(readings: DataFrame, spec: SensorSpec, calendar: Calendar | DataFrame) -> DataFrame:
    """Deltas, labels and bucket on typed readings; state is added when absent."""
    out = readings if spec.state in readings.columns else with_state(readings, spec)
    out = horizon_labels(with_deltas(out, spec), spec, calendar)
    return out.withColumn(spec.bucket, bucket_start(out, spec.time, spec.bucket_unit))


def base_features(readings: DataFrame, spec: SensorSpec, calendar: Calendar | DataFrame) -> DataFrame:
    """One row per bucket: counts, labels, statistics and slopes."""
    needed = [*spec.by, spec.row_id, spec.time, *spec.names]
    state = [spec.state] if spec.state in readings.columns else []
    rows = prepare_rows(readings.select(*needed, *state), spec, calendar)
    return with_slopes(bucket_features(with_changes(rows, spec), spec), spec)


def rolling_stats(spec: SensorSpec) -> list[Stat]:
    """Every rolling statistic of the feature table, in its column order."""
    base = [
        *[f"mean_{n}" for n in spec.analog],
        *[f"std_{n}" for n in spec.analog],
        *[f"mean_{d.name}" for d in spec.deltas],
        "state_transition_count",
        *[f"toggle_count_{n}" for n in spec.key_digital],
        *[f"active_count_{n}" for n in spec.key_digital],
    ]
    quantiled = [f"mean_{n}" for n in spec.signals]
    stats: list[Stat] = []
    for rows in FRAMES:
        kinds = ["mean"] if rows == 1 else ["mean", "std", "min", "max"]
        stats += [(kind, name, rows) for name in base for kind in kinds]
        if rows in QUANTILE_FRAMES:
            stats += [(kind, name, rows) for name in quantiled for kind in ("q25", "q75")]
    return stats


def feature_table(readings: DataFrame, spec: SensorSpec, calendar: Calendar | DataFrame) -> DataFrame:
    """The full table: bucket statistics, slopes and trailing frames."""
    base = base_features(readings, spec, calendar)
    return with_rolling(base, spec.bucket, spec.bucket_unit, rolling_stats(spec), spec.by)


def model_feature_names(spec: SensorSpec, available: Sequence[str]) -> list[str]:
    """Explanatory columns of the feature table; labels and times never qualify."""
    wanted = ["sample_count", "state_transition_count"]
    for name in spec.signals:
        wanted += [f"{kind}_{name}" for kind in ("mean", "std", "min", "max", "slope")]
        wanted += [f"roll{n}_{kind}_mean_{name}" for n in FRAMES[1:] for kind in ("mean", "std", "min", "max")]
    for name in spec.key_digital:
        wanted += [f"active_count_{name}", f"toggle_count_{name}"]
        for n in FRAMES[1:]:
            wanted += [
                f"roll{n}_mean_active_count_{name}",
                f"roll{n}_mean_toggle_count_{name}",
                f"roll{n}_max_toggle_count_{name}",
            ]
    present = set(available) - NEVER_FEATURES - {spec.bucket}
    return [c for c in dict.fromkeys(wanted) if c in present]
