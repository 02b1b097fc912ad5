"""Wide and long forms, and the sensor dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.spec import SensorSpec

DIMENSION = ("sensor_name", "sensor_type", "station_id", "unit")


def sensor_dimension(spark: SparkSession, spec: SensorSpec) -> DataFrame:
    """One row per configured sensor."""
    rows = [(s.name, s.kind, s.station, s.unit) for s in spec.sensors]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in DIMENSION))


def to_long(df: DataFrame, spec: SensorSpec, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per reading and sensor; a narrow step without shuffle."""
    ids = [c for c in df.columns if c not in spec.names] if keep is None else list(keep)
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in spec.names])
    return cast.unpivot(ids, spec.names, "sensor_name", "sensor_value")


def with_dimension(long: DataFrame, spec: SensorSpec) -> DataFrame:
    """Attach type, station and unit; the dimension has one row per configured sensor."""
    dim = sensor_dimension(long.sparkSession, spec)
    return long.join(F.broadcast(dim), "sensor_name", "left")


def melt_stats(row: DataFrame, keys: Sequence[str], stats: Sequence[str], key_name: str) -> DataFrame:
    """Turn columns named ``stat__key`` of a small aggregate into one row per key."""
    others = [c for c in row.columns if "__" not in c]
    packed = F.array(
        *[
            F.struct(F.lit(k).alias(key_name), *[F.col(f"{s}__{k}").alias(s) for s in stats])
            for k in keys
        ]
    )
    return row.select(*others, F.explode(packed).alias("_m")).select(*others, "_m.*")
