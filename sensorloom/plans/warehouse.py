"""The layered warehouse: readings, sensor-long, KPIs; published tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from sensorloom.operators import kpi
from sensorloom.operators.normalize import normalize, with_lineage
from sensorloom.operators.quality import table_gate
from sensorloom.operators.reshape import to_long, with_dimension
from sensorloom.sources.readings import layer_path, read_layer, read_readings_csv
from sensorloom.sources.sinks import verified_write
from sensorloom.spec import Calendar, SensorSpec

PARTITIONS = {
    "readings": ("dt",),
    "sensor_long": ("dt", "sensor_type"),
    "overall_kpi": (),
    "window_kpi": ("dt",),
    "sensor_kpi": (),
}


def build_readings(spark: SparkSession, csv: str, base: str, spec: SensorSpec, calendar: Calendar) -> DataFrame:
    """Raw text to the typed layer; returns the row-conservation report."""
    raw = read_readings_csv(spark, csv)
    rows = with_lineage(normalize(raw, spec, calendar), "csv", raw["_source_file"]).drop("_source_file")
    return verified_write(rows, layer_path(base, "readings"), PARTITIONS["readings"], label="readings")


def build_layers(spark: SparkSession, base: str, spec: SensorSpec) -> DataFrame:
    """Every layer above the readings; returns one report row per layer.

    The long layer is checked against rows x sensors.  The sensor KPI reads the wide
    layer, so the long layer is written once and not read back for it.
    """
    readings = read_layer(spark, base, "readings")
    keep = [spec.row_id, spec.time, spec.bucket, spec.day, spec.state, spec.flag, spec.label]
    long = with_dimension(to_long(readings, spec, keep), spec)
    outputs: list[tuple[str, DataFrame, int | None]] = [
        ("sensor_long", long, readings.count() * len(spec.names)),
        ("overall_kpi", kpi.overall_kpi(readings, spec), None),
        ("window_kpi", kpi.window_kpi(readings, spec), None),
        ("sensor_kpi", kpi.sensor_kpi(readings, spec), None),
    ]
    reports = [
        verified_write(df, layer_path(base, name), PARTITIONS[name], expected, name, conserve=False)
        for name, df, expected in outputs
    ]
    return reduce(DataFrame.unionByName, reports)


def publish_tables(
    spark: SparkSession,
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    database: str,
    location: str | None = None,
    fmt: str = "parquet",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Managed tables from frames, then the row gate over what was published.

    A catalog table format that supports it (``fmt`` other than parquet) is created or
    replaced with its table properties; parquet tables are overwritten.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    for name, (df, partitions) in tables.items():
        full = f"`{database}`.`{name}`"
        if fmt == "parquet":
            even = df.hint("rebalance", *partitions) if partitions else df
            writer = even.write.mode("overwrite").format(fmt)
            if partitions:
                writer = writer.partitionBy(*partitions)
            writer.saveAsTable(full)
        else:
            target = df.writeTo(full).using(fmt)
            for key, value in (properties or {}).items():
                target = target.tableProperty(key, value)
            if partitions:
                target = target.partitionedBy(*[df[c] for c in partitions])
            target.createOrReplace()
    return table_gate({name: spark.table(f"`{database}`.`{name}`") for name in tables})


def realtime_placeholder(spark: SparkSession, database: str, table: str, averages: Sequence[str]) -> None:
    """An empty realtime KPI table, so that views exist before the stream first runs."""
    doubles = ", ".join(f"avg_{a} DOUBLE" for a in averages)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` (minute_bucket STRING, operating_state STRING, "
        f"sample_count BIGINT, failure_sample_count BIGINT, failure_window_rate DOUBLE, {doubles}, dt STRING) "
        "USING parquet PARTITIONED BY (dt)"
    )


def _cast_view(spark: SparkSession, name: str, source: str, columns: Mapping[str, str], temporary: bool) -> None:
    listed = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in columns.items())
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS SELECT {listed} FROM {source}")


def create_views(
    spark: SparkSession,
    sources: Mapping[str, str],
    averages: Sequence[str],
    names: Mapping[str, str],
    bucket: str = "event_minute",
    bucket_type: str = "TIMESTAMP",
    temporary: bool = True,
) -> None:
    """Window, sensor and realtime BI views with explicit types.

    ``sources`` and ``names`` are keyed by window, sensor and realtime; a view is made for
    every source given.
    """
    counts = {"sample_count": "BIGINT", "failure_sample_count": "BIGINT", "failure_window_rate": "DOUBLE"}
    means = {f"avg_{a}": "DOUBLE" for a in averages}
    stats = {f"{s}_sensor_value": "DOUBLE" for s in ("avg", "std", "min", "max")}
    shapes = {
        "window": {
            "minute_bucket": "STRING",
            bucket: bucket_type,
            "operating_state": "STRING",
            **counts,
            **means,
            "dt": "STRING",
        },
        "sensor": {c: "STRING" for c in ("sensor_name", "sensor_type", "station_id", "unit")} | counts | stats,
        "realtime": {"minute_bucket": "STRING", "operating_state": "STRING", **counts, **means, "dt": "STRING"},
    }
    for kind, source in sources.items():
        _cast_view(spark, names[kind], source, shapes[kind], temporary)
