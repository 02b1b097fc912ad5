"""Dashboard statements over the published views; each has a total order under its limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def window_dashboard(spark: SparkSession, view: str, averages: Sequence[str], limit: int = 100) -> DataFrame:
    means = ", ".join(f"AVG(avg_{a}) AS avg_{a}" for a in averages)
    return spark.sql(
        f"""
        SELECT dt, operating_state, COUNT(*) AS minute_count, SUM(sample_count) AS sample_count,
               SUM(failure_sample_count) AS failure_sample_count,
               AVG(failure_window_rate) AS avg_failure_window_rate, {means}
        FROM {view} GROUP BY dt, operating_state ORDER BY dt, operating_state LIMIT {limit}
        """
    )


def sensor_dashboard(spark: SparkSession, view: str, limit: int = 15) -> DataFrame:
    return spark.sql(
        f"""
        SELECT sensor_name, sensor_type, unit, sample_count, failure_sample_count, failure_window_rate,
               avg_sensor_value, std_sensor_value
        FROM {view} ORDER BY failure_window_rate DESC, sensor_name LIMIT {limit}
        """
    )


def window_state_dashboard(spark: SparkSession, view: str, averages: Sequence[str], limit: int = 100) -> DataFrame:
    means = ", ".join(f"avg_{a}" for a in averages)
    return spark.sql(
        f"""
        SELECT dt, operating_state, minute_count, sample_count, failure_sample_count,
               avg_failure_window_rate, {means}
        FROM {view} ORDER BY dt, operating_state LIMIT {limit}
        """
    )


def latest_risk(spark: SparkSession, view: str, limit: int = 20) -> DataFrame:
    return spark.sql(
        f"""
        SELECT event_id, event_time, operating_state, risk_score, risk_level, risk_reason, model_version
        FROM {view} ORDER BY event_time DESC, event_id LIMIT {limit}
        """
    )


def model_page(spark: SparkSession, view: str, sources: Sequence[str], measures: Sequence[str]) -> DataFrame:
    wanted = ", ".join(f"'{s}'" for s in sources)
    listed = ", ".join(measures)
    return spark.sql(
        f"""
        SELECT source_type, model_name, status, {listed}
        FROM {view} WHERE source_type IN ({wanted}) ORDER BY source_type, model_name
        """
    )


def label_page(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(
        f"SELECT label, positive_rows, negative_rows, positive_rate FROM {view} ORDER BY positive_rate DESC, label"
    )


def readings_count(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(f"SELECT COUNT(*) AS ods_rows FROM {view}")


def rows_per_sensor(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(
        f"""
        SELECT sensor_name, sensor_type, COUNT(*) AS rows_in_long_table
        FROM {view} GROUP BY sensor_name, sensor_type ORDER BY sensor_name
        """
    )


def window_totals(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(
        f"""
        SELECT COUNT(*) AS window_rows, SUM(sample_count) AS sample_count,
               SUM(failure_sample_count) AS failure_sample_count
        FROM {view}
        """
    )


def consistency_metrics(spark: SparkSession, views: Mapping[str, str]) -> DataFrame:
    """Row counts and sums of the sensor and window-state tables as (metric, value).

    One scan per table: the measures of a table come from one aggregate and are stacked.
    """
    return spark.sql(
        f"""
        SELECT stack(2, 'sensor_rows', n, 'sensor_sample_sum', s) AS (metric, value)
        FROM (SELECT COUNT(*) AS n, SUM(sample_count) AS s FROM {views['sensor']})
        UNION ALL
        SELECT stack(3, 'window_state_rows', n, 'window_sample_sum', s, 'window_failure_sample_sum', f)
               AS (metric, value)
        FROM (SELECT COUNT(*) AS n, SUM(sample_count) AS s, SUM(failure_sample_count) AS f
              FROM {views['window_state']})
        """
    )
