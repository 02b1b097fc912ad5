"""Pairwise comparison of two stores, profiles, or metric tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def store_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], name: str) -> DataFrame:
    """Row count, number of groups and sum of each measure as (check, value) rows."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.sum(m).alias(m) for m in measures])
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("double").alias("row_count"),
        F.count("*").cast("double").alias("group_count"),
        *[F.sum(m).cast("double").alias(f"sum_{m}") for m in measures],
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("check"), F.col(c).alias(name)) for c in totals.columns]
    )
    return totals.select(F.inline(pairs))


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """PASS/FAIL per total of two copies of a table."""
    a = store_totals(left, keys, measures, "expected")
    b = store_totals(right, keys, measures, "actual")
    status = F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL")
    return a.join(F.broadcast(b), "check", "full_outer").select("check", status.alias("status"), "expected", "actual")


def feature_profile(df: DataFrame, bucket: str, labels: Sequence[str], key_columns: Sequence[str]) -> DataFrame:
    """Shape, range, label distribution and key statistics as (section, name, value) rows."""
    labels = [c for c in labels if c in df.columns]
    key_columns = [c for c in key_columns if c in df.columns]
    aggs: list[tuple[str, str, Column]] = [
        ("shape", "row_count", F.count("*")),
        ("shape", "column_count", F.max(F.lit(len(df.columns)))),
        ("range", "min_bucket_epoch", F.unix_timestamp(F.min(bucket))),
        ("range", "max_bucket_epoch", F.unix_timestamp(F.max(bucket))),
    ]
    for c in labels:
        aggs.append(("positive_rows", c, F.coalesce(F.sum(c), F.lit(0))))
        aggs.append(("positive_rate", c, F.sum(c) / F.count("*")))
    for c in key_columns:
        aggs += [
            ("mean", c, F.avg(c)),
            ("std", c, F.stddev_samp(c)),
            ("min", c, F.min(c)),
            ("max", c, F.max(c)),
            ("null_rows", c, F.count("*") - F.count(c)),
        ]
    row = df.agg(*[a.cast("double").alias(f"_{i}") for i, (_, _, a) in enumerate(aggs)])
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), F.col(f"_{i}").alias("value"))
            for i, (s, n, _) in enumerate(aggs)
        ]
    )
    return row.select(F.inline(pairs))


def profile_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two profiles side by side, full outer, with deltas; a profile has one row per entry."""
    a = left.withColumnRenamed("value", "left_value")
    b = right.withColumnRenamed("value", "right_value")
    joined = a.join(b, ["section", "name"], "full_outer")
    return joined.withColumn("delta", F.col("right_value") - F.col("left_value"))


SEVERITY = ("PASS", "WARN", "FAIL")


def parity_verdicts(
    parity: DataFrame, bucket_count: DataFrame, sample_sum: DataFrame, row_count: DataFrame
) -> DataFrame:
    """Verdict rows over ``profile_parity`` plus an ``overall`` row with the worst of them.

    The last three arguments are one-row, one-column frames of the source layers.
    """

    def same(section: str, name: str | None = None) -> Column:
        chosen = F.col("section") == section
        if name:
            chosen = chosen & (F.col("name") == name)
        equal = F.col("left_value").eqNullSafe(F.col("right_value"))
        return F.coalesce(F.min(F.when(chosen, equal.cast("int"))), F.lit(0)) == 1

    rows_right = F.max(
        F.when((F.col("section") == "shape") & (F.col("name") == "row_count"), F.col("right_value"))
    )
    facts = parity.agg(
        same("shape").alias("shape_parity"),
        same("range").alias("time_range_parity"),
        same("positive_rows").alias("label_distribution_parity"),
        rows_right.alias("_rows"),
    ).select(
        "*",
        (F.col("_rows") == bucket_count.scalar()).alias("bucket_alignment"),
        (sample_sum.scalar() == row_count.scalar()).alias("sample_count_alignment"),
    )
    checks = [
        ("shape_parity", "WARN"),
        ("time_range_parity", "WARN"),
        ("label_distribution_parity", "WARN"),
        ("bucket_alignment", "FAIL"),
        ("sample_count_alignment", "WARN"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("item"),
                F.when(F.coalesce(F.col(n), F.lit(False)), "PASS").otherwise(bad).alias("status"),
            )
            for n, bad in checks
        ]
    )
    return with_overall(facts.select(F.inline(rows)), "item")


def with_overall(verdicts: DataFrame, name: str) -> DataFrame:
    """Append an ``overall`` row: FAIL beats WARN beats PASS."""
    rank = F.max(F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col("status")))
    worst = (
        F.when(rank == 3, F.lit("FAIL")).when(rank == 2, F.lit("PASS_WITH_WARNINGS")).otherwise(F.lit("PASS"))
    )
    overall = verdicts.agg(worst.alias("status")).select(F.lit("overall").alias(name), "status")
    return verdicts.unionByName(overall)


def metric_delta(
    metrics: DataFrame, left: str, right: str, measures: Sequence[str], source: str = "source_type", key: str = "model_name"
) -> DataFrame:
    """Metric rows plus a ``right_minus_left`` row per model trained in both sources."""
    trained = metrics.filter(F.col("status") == "trained")
    a = trained.filter(F.col(source) == left).select(key, *[F.col(m).alias(f"_a_{m}") for m in measures])
    b = trained.filter(F.col(source) == right).select(key, *[F.col(m).alias(f"_b_{m}") for m in measures])
    deltas = a.join(b, key).select(
        F.lit(f"{right}_minus_{left}").alias(source),
        key,
        F.lit("delta").alias("status"),
        *[(F.col(f"_b_{m}") - F.col(f"_a_{m}")).alias(m) for m in measures],
    )
    return metrics.select(source, key, "status", *measures).unionByName(deltas)


def comparison_status(checks: Sequence[DataFrame]) -> DataFrame:
    """PASS when every check frame (with a ``status`` column) passes everywhere."""
    merged = reduce(DataFrame.unionByName, [c.select("status") for c in checks])
    failed = F.coalesce(F.sum((F.col("status") != "PASS").cast("int")), F.lit(0))
    return merged.agg(F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"))
