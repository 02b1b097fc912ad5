"""Splits, weights, thresholds and metrics for early-warning scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.operators.ordered import Order, with_running_totals
from sensorloom.operators.quantiles import exact_quantiles
from sensorloom.spec import Calendar

# The candidate thresholds are this many evenly spaced score quantiles.
SWEEP_POINTS = 80
SWEEP_LOW = 0.50
SWEEP_HIGH = 0.995
SINGLE_CLASS_SHARE = 0.95
WEIGHT_CAP = 30.0


def chrono_split(df: DataFrame, time: str, train_end: str, valid_end: str) -> DataFrame:
    """Add ``split``: train before the first cutoff, validation before the second, then test."""
    name = (
        F.when(F.col(time) < F.lit(train_end), "train")
        .when(F.col(time) < F.lit(valid_end), "validation")
        .otherwise("test")
    )
    return df.withColumn("split", name)


def split_check(split: DataFrame, time: str) -> DataFrame:
    """Range of each split and whether the ranges are strictly increasing."""

    def edge(pick, name: str) -> Column:
        return pick(F.when(F.col("split") == name, F.col(time)))

    row = split.agg(
        *[edge(F.min, s).alias(f"{s}_min") for s in ("train", "validation", "test")],
        *[edge(F.max, s).alias(f"{s}_max") for s in ("train", "validation", "test")],
    )
    ordered = (F.col("train_max") < F.col("validation_min")) & (F.col("validation_max") < F.col("test_min"))
    return row.withColumn("status", F.when(F.coalesce(ordered, F.lit(False)), "PASS").otherwise("FAIL"))


def model_rows(features: DataFrame) -> DataFrame:
    """Rows a model may learn from: outside incidents and recovery."""
    return features.filter((F.col("failure_window") == 0) & (F.col("post_maintenance") == 0))


def binary_target(kpi: DataFrame) -> Column:
    failed = F.coalesce(F.col("failure_sample_count"), F.lit(0)) > 0
    rated = F.coalesce(F.col("failure_window_rate"), F.lit(0.0)) > 0
    return (failed | rated).cast("int")


def class_weights(df: DataFrame, label: str, cap: float | None = WEIGHT_CAP) -> DataFrame:
    """``n / (2 n_class)`` per class, capped."""
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("p"))
    classes = F.array(
        F.struct(F.lit(0).alias("label"), (F.col("n") - F.col("p")).alias("class_rows")),
        F.struct(F.lit(1).alias("label"), F.col("p").alias("class_rows")),
    )
    weight = F.col("n") / (2.0 * F.greatest(F.col("class_rows"), F.lit(1)))
    weight = F.least(weight, F.lit(cap)) if cap is not None else weight
    return row.select("n", F.inline(classes)).select("label", "class_rows", weight.alias("class_weight"))


def with_class_weight(df: DataFrame, label: str, cap: float | None = WEIGHT_CAP) -> DataFrame:
    weights = class_weights(df, label, cap).select(F.col("label").alias(label), "class_weight")
    return df.join(F.broadcast(weights), label, "left")  # two rows


def score_order(score: str, time: str, tie: str | None = None) -> Order:
    return Order(score, time, descending=True, text_tie=tie)


def average_precision(df: DataFrame, score: str, label: str, time: str) -> DataFrame:
    """Area under precision-recall steps, highest score first, ties by time."""
    narrow = df.select(score, time, F.col(label).cast("long").alias("_y"))
    ranked = with_running_totals(
        narrow, score_order(score, time), {"_rank": F.lit(1).cast("long"), "_tp": F.col("_y")}
    )
    return _area(ranked, F.col("_y"))


def average_precision_grouped(df: DataFrame, score: str, label: str) -> DataFrame:
    """The same area with equal scores entering together; independent of row order."""
    groups = df.groupBy(score).agg(F.count("*").alias("_n"), F.sum(F.col(label).cast("long")).alias("_y"))
    ranked = with_running_totals(
        groups, Order(score, descending=True), {"_rank": F.col("_n"), "_tp": F.col("_y")}
    )
    return _area(ranked, F.col("_y"))


def _area(ranked: DataFrame, gain: Column) -> DataFrame:
    positives = F.sum(gain)
    steps = F.sum(gain * F.col("_tp") / F.col("_rank"))
    return ranked.agg(
        F.coalesce(positives, F.lit(0)).alias("positive_rows"),
        F.when(positives > 0, steps / positives).alias("average_precision"),
    )


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    total = precision + recall
    return precision, recall, F.when(total > 0, 2 * precision * recall / total).otherwise(F.lit(0.0))


def sweep_shares() -> list[float]:
    step = (SWEEP_HIGH - SWEEP_LOW) / (SWEEP_POINTS - 1)
    return [SWEEP_LOW + step * i for i in range(SWEEP_POINTS - 1)] + [SWEEP_HIGH]


def threshold_sweep(df: DataFrame, score: str, label: str) -> DataFrame:
    """Confusion counts and F1 at each distinct candidate threshold, best one marked.

    Rows are binned by the sorted thresholds and counted once; the counts above each
    threshold are sums over at most ``SWEEP_POINTS + 1`` bins.
    """
    narrow = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("long").alias("_y"))
    classes = narrow.agg(F.min("_y").alias("lo"), F.max("_y").alias("hi")).first()
    shares = sweep_shares() if classes["lo"] != classes["hi"] else [SINGLE_CLASS_SHARE]
    thresholds = sorted({t for t in exact_quantiles(narrow, ["_s"], shares)["_s"] if t is not None})
    if not thresholds:  # no score at all: no threshold to try
        counts = ", ".join(f"{c} long" for c in ("tp", "fp", "fn", "tn"))
        schema = f"threshold double, {counts}, precision double, recall double, f1 double, is_best int"
        return df.sparkSession.createDataFrame([], schema)
    narrow = narrow.filter(F.col("_s").isNotNull() & ~F.isnan("_s"))
    splits = [-float("inf"), *thresholds, float("inf")]
    binned = Bucketizer(splits=splits, inputCol="_s", outputCol="_bin").transform(narrow)
    bins = binned.groupBy("_bin").agg(F.sum("_y").alias("_p"), F.count("*").alias("_n"))
    spark = df.sparkSession
    edges = spark.createDataFrame(
        [(float(i + 1), t) for i, t in enumerate(thresholds)], "_bin double, threshold double"
    )
    joined = edges.join(bins, "_bin", "full_outer").na.fill(0, ["_p", "_n"])
    above = Window.orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tp, predicted = F.sum("_p").over(above), F.sum("_n").over(above)
    counted = joined.select(
        "threshold",
        tp.alias("tp"),
        (predicted - tp).alias("fp"),
        (F.sum("_p").over(whole) - tp).alias("fn"),
        (F.sum("_n").over(whole) - predicted - (F.sum("_p").over(whole) - tp)).alias("tn"),
    ).filter(F.col("threshold").isNotNull())
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    swept = counted.withColumns({"precision": precision, "recall": recall}).withColumn("f1", f1)
    best = Window.orderBy(F.desc("f1"), F.desc("recall"), F.asc("threshold"))
    return swept.withColumn("is_best", (F.row_number().over(best) == 1).cast("int"))


def best_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    return threshold_sweep(df, score, label).filter(F.col("is_best") == 1).drop("is_best")


def classification_metrics(
    df: DataFrame, score: str, label: str, time: str, threshold: float | Column
) -> DataFrame:
    """Confusion, precision, recall, F1, accuracy, PR area and false alarms per day."""
    hit = F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    truth = F.col(label) == 1

    def count(test: Column) -> Column:
        return F.count(F.when(test, 1))

    row = df.agg(
        F.count("*").alias("rows"),
        count(hit & truth).alias("tp"),
        count(hit & ~truth).alias("fp"),
        count(~hit & ~truth).alias("tn"),
        count(~hit & truth).alias("fn"),
        F.countDistinct(F.to_date(F.col(time))).alias("_days"),
    )
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    area = average_precision(df, score, label, time).select("average_precision")
    return (
        row.withColumns({"precision": precision, "recall": recall})
        .withColumns(
            {
                "f1": f1,
                "accuracy": (F.col("tp") + F.col("tn")) / F.greatest(F.col("rows"), F.lit(1)),
                "false_alarms_per_day": F.col("fp") / F.greatest(F.col("_days"), F.lit(1)),
                "pr_auc": area.scalar(),
            }
        )
        .drop("_days")
    )


def lead_time(
    predictions: DataFrame, calendar: Calendar, time: str, prediction: str, hours: int = 24
) -> DataFrame:
    """Earliest alarm before each incident start that lies in the scored range.

    One pass: the calendar is literal, so each start contributes one conditional minimum.
    """
    t = F.col(time)
    text = "%Y-%m-%d %H:%M:%S.%f"
    aggs = [F.min(t).alias("_lo"), F.max(t).alias("_hi")]
    for i in calendar.intervals:
        begin = F.lit((i.start - timedelta(hours=hours)).strftime(text))
        early = (F.col(prediction) == 1) & (t >= begin) & (t < F.lit(i.start.strftime(text)))
        aggs.append(F.min(F.when(early, t)).alias(f"_a{i.id}"))
    kind = predictions.schema[time].dataType
    rows = F.array(
        *[
            F.struct(
                F.lit(i.id).alias("interval_id"),
                F.lit(i.start.strftime(text)).cast(kind).alias("interval_start"),
                F.col(f"_a{i.id}").alias("first_alarm"),
            )
            for i in calendar.intervals
        ]
    )
    out = predictions.agg(*aggs).select("_lo", "_hi", F.inline(rows))
    in_range = (F.col("interval_start") >= F.col("_lo")) & (F.col("interval_start") <= F.col("_hi"))
    start, alarm = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("interval_start", "first_alarm"))
    return out.filter(in_range).select(
        "interval_id",
        "interval_start",
        "first_alarm",
        F.col("first_alarm").isNotNull().cast("int").alias("detected"),
        ((start - alarm) / F.lit(3.6e9)).alias("lead_time_hours"),
    )


def lead_time_summary(leads: DataFrame) -> DataFrame:
    return leads.agg(
        F.count("*").alias("windows"),
        F.count("lead_time_hours").alias("detected_windows"),
        F.avg("lead_time_hours").alias("mean_lead_time_hours"),
        F.max("lead_time_hours").alias("max_lead_time_hours"),
    )


def top_weights(df: DataFrame, names: Sequence[str], weights: Sequence[float], limit: int = 30) -> DataFrame:
    """Model weights in long form by absolute size; one row per feature."""
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "feature string, weight double")
    return table.withColumn("abs_weight", F.abs("weight")).orderBy(F.desc("abs_weight"), "feature").limit(limit)
