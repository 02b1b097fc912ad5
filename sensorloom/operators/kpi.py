"""Aggregations over readings: overall, window, sensor, state, day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.scalars import bucket_text, safe_ratio
from sensorloom.operators.reshape import DIMENSION, melt_stats, sensor_dimension
from sensorloom.spec import SensorSpec

RATE = "failure_window_rate"


def _counts(spec: SensorSpec) -> list[Column]:
    return [
        F.count("*").alias("sample_count"),
        F.coalesce(F.sum(F.col(spec.flag).cast("long")), F.lit(0)).alias("failure_sample_count"),
    ]


def _with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn(RATE, safe_ratio(F.col("failure_sample_count"), F.col("sample_count")))


def stats_of(name: str, suffix: str | None = None) -> list[Column]:
    tail = name if suffix is None else suffix
    return [
        F.avg(name).alias(f"avg_{tail}"),
        F.stddev_samp(name).alias(f"std_{tail}"),
        F.min(name).alias(f"min_{tail}"),
        F.max(name).alias(f"max_{tail}"),
    ]


def overall_kpi(readings: DataFrame, spec: SensorSpec) -> DataFrame:
    agg = readings.agg(
        *_counts(spec),
        F.min(spec.time).alias("min_event_time"),
        F.max(spec.time).alias("max_event_time"),
        F.countDistinct(spec.day).alias("active_day_count"),
    )
    return _with_rate(agg).withColumn("metric_type", F.lit("overall"))


def window_kpi(readings: DataFrame, spec: SensorSpec) -> DataFrame:
    """Per bucket, day and state.  Partial aggregation runs before the shuffle, so a hot
    bucket reaches its reducer as one row per map task."""
    analog = [c for name in spec.analog for c in stats_of(name)]
    digital = [F.sum(F.col(n).cast("double")).alias(f"active_count_{n}") for n in spec.digital]
    keys = [*spec.by, spec.bucket, spec.day, spec.state]
    agg = readings.groupBy(*keys).agg(*_counts(spec), *analog, *digital)
    return _with_rate(agg).withColumn("minute_bucket", bucket_text(F.col(spec.bucket)))


_SENSOR_STATS = (
    "sample_count",
    "failure_sample_count",
    "avg_sensor_value",
    "std_sensor_value",
    "min_sensor_value",
    "max_sensor_value",
)


def sensor_kpi(readings: DataFrame, spec: SensorSpec) -> DataFrame:
    """Per sensor, straight from wide readings: one pass, one row shuffled per task.

    Equal to ``sensor_kpi_from_long(to_long(readings))`` without multiplying the rows by
    the number of sensors.
    """
    columns: list[Column] = []
    for name in spec.names:
        value = F.col(name)
        columns += [
            F.count("*").alias(f"sample_count__{name}"),
            F.coalesce(F.sum(F.col(spec.flag).cast("long")), F.lit(0)).alias(f"failure_sample_count__{name}"),
            F.avg(value).alias(f"avg_sensor_value__{name}"),
            F.stddev_samp(value).alias(f"std_sensor_value__{name}"),
            F.min(value).alias(f"min_sensor_value__{name}"),
            F.max(value).alias(f"max_sensor_value__{name}"),
        ]
    long = melt_stats(readings.agg(*columns), spec.names, _SENSOR_STATS, "sensor_name")
    dim = sensor_dimension(readings.sparkSession, spec)
    named = dim.join(F.broadcast(long), "sensor_name")
    return _with_rate(named.filter(F.col("sample_count") > 0))


def sensor_kpi_from_long(long: DataFrame, spec: SensorSpec) -> DataFrame:
    """Per sensor dimension columns, over an existing long table."""
    agg = long.groupBy(*DIMENSION).agg(*_counts(spec), *stats_of("sensor_value"))
    return _with_rate(agg)


def state_kpi(readings: DataFrame, spec: SensorSpec, averages: Sequence[str]) -> DataFrame:
    columns = [F.avg(c).alias(f"avg_{c}") for c in averages]
    return _with_rate(readings.groupBy(spec.state).agg(*_counts(spec), *columns))


def daily_counts(readings: DataFrame, spec: SensorSpec) -> DataFrame:
    return readings.groupBy(spec.day).agg(*_counts(spec))


def rows_per_sensor(readings: DataFrame, spec: SensorSpec) -> DataFrame:
    """Rows each sensor has in the long table, without building it."""
    total = readings.agg(F.count("*").alias("rows_in_long_table"))
    dim = sensor_dimension(readings.sparkSession, spec).select("sensor_name", "sensor_type")
    named = F.explode(F.array(*[F.lit(n) for n in spec.names])).alias("sensor_name")
    counted = total.select(named, "rows_in_long_table")
    return dim.join(F.broadcast(counted), "sensor_name")


def long_counts(long: DataFrame) -> DataFrame:
    return long.groupBy("sensor_name", "sensor_type").agg(F.count("*").alias("rows_in_long_table"))


def weighted_rollup(
    kpi: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: str = "sample_count",
    sums: Sequence[str] = ("sample_count", "failure_sample_count"),
    skip_null_weight: bool = False,
) -> DataFrame:
    """Re-aggregate averages by their counts; null when the weights add up to 0.

    A null average still counts its weight unless ``skip_null_weight``.
    """

    def weighted(name: str) -> Column:
        used = F.when(F.col(name).isNotNull(), F.col(weight)) if skip_null_weight else F.col(weight)
        total = F.sum(used)
        return (F.sum(F.col(name) * F.col(weight)) / F.when(total > 0, total)).alias(name)

    return kpi.groupBy(*keys).agg(
        *[F.sum(F.col(c)).cast("long").alias(c) for c in sums], *[weighted(v) for v in values]
    )


def window_consistency(kpi: DataFrame) -> DataFrame:
    return kpi.agg(
        F.count("*").alias("window_rows"),
        F.sum("sample_count").alias("sample_count"),
        F.sum("failure_sample_count").alias("failure_sample_count"),
    )


def window_state_kpi(kpi: DataFrame, spec: SensorSpec, averages: Sequence[str]) -> DataFrame:
    """Window KPIs by day and state; averages of averages are not weighted."""
    return kpi.groupBy(spec.day, spec.state).agg(
        F.count("*").alias("minute_count"),
        F.sum("sample_count").alias("sample_count"),
        F.sum("failure_sample_count").alias("failure_sample_count"),
        F.avg(RATE).alias(f"avg_{RATE}"),
        *[F.avg(f"avg_{name}").alias(f"avg_{name}") for name in averages],
    )
