"""Reading sources: raw CSV, projected CSV, Parquet layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators.normalize import standardise_columns
from sensorloom.spec import SensorSpec


def read_readings_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Raw readings with a header; every column is text, nothing is inferred."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", mode)
        .csv(path)
        .withColumn("_source_file", F.col("_metadata.file_path"))
    )


def read_projected_csv(
    spark: SparkSession,
    path: str,
    spec: SensorSpec,
    columns: Sequence[str],
    single_precision: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Only the named standard columns, typed; the CSV reader parses nothing else.

    ``single_precision`` reproduces readers that keep sensors as 32-bit floats.
    """
    raw = standardise_columns(spark.read.option("header", True).csv(path), spec)
    kind = "float" if single_precision else "double"
    picked = []
    for name in columns:
        if name == spec.time:
            stamp = F.try_to_timestamp(F.col(f"{spec.time}_raw"), F.lit(spec.time_format))
            picked.append(stamp.cast("timestamp_ntz").alias(name))
        elif name == spec.row_id:
            picked.append(F.col(name).try_cast("long").alias(name))
        else:
            picked.append(F.col(name).try_cast(kind).alias(name))
    out = raw.select(*picked)
    return out.orderBy(spec.time) if ordered and spec.time in columns else out


LAYERS = ("readings", "sensor_long", "overall_kpi", "window_kpi", "sensor_kpi")


def layer_path(base: str, layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; one of {LAYERS}")
    return f"{base.rstrip('/')}/{layer}"


def read_layer(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """A stored layer by name; a missing path fails here, not in a later action."""
    return spark.read.parquet(layer_path(base, layer))
