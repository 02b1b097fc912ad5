"""Exploration over labelled readings: contrasts, segments, volatility, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.scalars import bucket_start, safe_ratio
from sensorloom.operators.features import FLAGS, label_segment, with_changes
from sensorloom.operators.reshape import melt_stats
from sensorloom.spec import SensorSpec


def label_summary(labelled: DataFrame, labels: Sequence[str] = FLAGS) -> DataFrame:
    """Positive and negative rows per label."""
    sums = [F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(f"positive_rows__{c}") for c in labels]
    row = labelled.agg(F.count("*").alias("total_rows"), *sums)
    long = melt_stats(row, labels, ["positive_rows"], "label")
    return long.select(
        "label",
        "positive_rows",
        (F.col("total_rows") - F.col("positive_rows")).alias("negative_rows"),
        safe_ratio(F.col("positive_rows"), F.col("total_rows")).alias("positive_rate"),
    )


def remaining_time_summary(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count("rul_seconds").alias("rul_non_null_rows"),
        F.min("rul_seconds").alias("rul_min_seconds"),
        F.max("rul_seconds").alias("rul_max_seconds"),
    )


def label_populated(summary: DataFrame, required: Sequence[str]) -> DataFrame:
    """PASS when every required label has positive rows; a label that is absent fails."""
    rows = [(name,) for name in required]
    wanted = summary.sparkSession.createDataFrame(rows, "label string")
    joined = F.broadcast(wanted).join(summary.select("label", "positive_rows"), "label", "left")
    count = F.coalesce(F.col("positive_rows"), F.lit(0))
    return joined.select(
        "label", count.alias("positive_rows"), F.when(count > 0, "PASS").otherwise("FAIL").alias("status")
    )


def segment_means(labelled: DataFrame, spec: SensorSpec) -> DataFrame:
    """Mean of every signal per exclusive segment."""
    return labelled.groupBy(label_segment().alias("segment")).agg(
        F.count("*").alias("segment_rows"), *[F.avg(n).alias(n) for n in spec.signals]
    )


def segment_contrast(means: DataFrame, spec: SensorSpec, normal: str = "normal_candidate") -> DataFrame:
    """Per segment and sensor: mean minus the mean of the normal segment.

    Without a normal segment the delta is null.  There are at most seven segments.
    """
    long = means.select("segment", *spec.analog).unpivot(["segment"], spec.analog, "sensor_name", "mean")
    base = long.filter(F.col("segment") == normal).select("sensor_name", F.col("mean").alias("_normal"))
    joined = long.filter(F.col("segment") != normal).join(F.broadcast(base), "sensor_name", "left")
    return joined.select(
        "segment", "sensor_name", "mean", (F.col("mean") - F.col("_normal")).alias("delta_vs_normal")
    )


def volatility_rank(df: DataFrame, spec: SensorSpec) -> DataFrame:
    """Mean and standard deviation per signal, most volatile first."""
    columns = [c for n in spec.signals for c in (F.avg(n).alias(f"mean__{n}"), F.stddev_samp(n).alias(f"std__{n}"))]
    long = melt_stats(df.agg(*columns), spec.signals, ["mean", "std"], "sensor_name")
    # the window covers one row per signal
    order = Window.orderBy(F.desc(F.abs(F.col("std"))), "sensor_name")
    return long.withColumn("volatility_rank", F.row_number().over(order))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair from one aggregate over all rows."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in ((a, b), (b, a)):
            cells.append(
                F.struct(F.lit(left).alias("left"), F.lit(right).alias("right"), F.col(f"_{i}").alias("correlation"))
            )
    cells += [
        F.struct(F.lit(c).alias("left"), F.lit(c).alias("right"), F.lit(1.0).alias("correlation")) for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def top_correlations(matrix: DataFrame, columns: Sequence[str], limit: int = 10) -> DataFrame:
    """Upper triangle by absolute correlation; undefined ones are left out."""
    place = F.array(*[F.lit(c) for c in columns])
    upper = F.array_position(place, F.col("left")) < F.array_position(place, F.col("right"))
    value = F.col("correlation")
    return (
        matrix.filter(upper & value.isNotNull() & ~F.isnan(value))
        .withColumn("abs_correlation", F.abs(value))
        .orderBy(F.desc("abs_correlation"), "left", "right")
        .limit(limit)
    )


def resample_mean(df: DataFrame, spec: SensorSpec, columns: Sequence[str], unit: str = "hour") -> DataFrame:
    """Mean per hour (or other unit); hours where every mean is null drop."""
    bucket = bucket_start(df, spec.time, unit).alias("bucket_start")
    means = df.groupBy(*spec.by, bucket).agg(*[F.avg(c).alias(c) for c in columns])
    return means.dropna("all", subset=list(columns))


def daily_transitions(df: DataFrame, spec: SensorSpec) -> DataFrame:
    return with_changes(df, spec).groupBy(spec.day).agg(
        F.sum("state_transition_flag").alias("state_transition_count")
    )


def failure_contrast(readings: DataFrame, spec: SensorSpec) -> DataFrame:
    """Failure and normal averages side by side, ranked by absolute difference."""
    columns: list[Column] = []
    for name in spec.names:
        failed = F.when(F.col(spec.flag) == 1, F.col(name))
        normal = F.when(F.col(spec.flag) == 0, F.col(name))
        columns += [
            F.avg(normal).alias(f"normal_avg__{name}"),
            F.avg(failed).alias(f"failure_avg__{name}"),
            F.sum((F.col(spec.flag) == 0).cast("long")).alias(f"normal_count__{name}"),
            F.sum((F.col(spec.flag) == 1).cast("long")).alias(f"failure_count__{name}"),
        ]
    stats = ["normal_avg", "failure_avg", "normal_count", "failure_count"]
    long = melt_stats(readings.agg(*columns), spec.names, stats, "sensor_name")
    delta = F.col("failure_avg") - F.col("normal_avg")
    out = long.withColumn("avg_delta_failure_minus_normal", delta)
    # one row per sensor
    order = Window.orderBy(
        F.desc(F.abs(F.coalesce(F.col("avg_delta_failure_minus_normal"), F.lit(0.0)))), "sensor_name"
    )
    return out.withColumn("contrast_rank", F.row_number().over(order))


def attention_sensors(contrast: DataFrame, kpi: DataFrame, limit: int = 3) -> DataFrame:
    """Top sensors by failure contrast, filled up by standard deviation, with the reason.

    Both inputs have one row per sensor.
    """
    std = kpi.select("sensor_name", F.col("std_sensor_value").alias("_std"))
    by_std = Window.orderBy(F.desc(F.abs(F.coalesce(F.col("_std"), F.lit(0.0)))), "sensor_name")
    ranked = std.withColumn("_std_rank", F.row_number().over(by_std))
    joined = ranked.join(
        F.broadcast(contrast.select("sensor_name", "contrast_rank", "avg_delta_failure_minus_normal")),
        "sensor_name",
        "full_outer",
    )
    order = Window.orderBy(F.asc_nulls_last("contrast_rank"), F.asc_nulls_last("_std_rank"))
    chosen = joined.withColumn("attention_rank", F.row_number().over(order)).filter(
        F.col("attention_rank") <= limit
    )
    # decimal text, so the reason does not depend on locale or exponent form
    shift = F.col("avg_delta_failure_minus_normal").cast("decimal(38,6)").cast("string")
    spread = F.coalesce(F.col("_std"), F.lit(0.0)).cast("decimal(38,6)").cast("string")
    reason = F.concat_ws(
        "; ",
        F.when(shift.isNotNull(), F.concat(F.lit("failure-window mean shift "), shift)),
        F.when(F.col("_std_rank").isNotNull(), F.concat(F.lit("std "), spread)),
    )
    text = F.when(reason == "", F.lit("ranked by available KPI signal")).otherwise(reason)
    return chosen.select("attention_rank", "sensor_name", text.alias("reason"))
