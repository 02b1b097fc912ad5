"""Model input: impute and standardise with statistics of the training split only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.scalars import null_if_not_finite
from sensorloom.operators.features import NEVER_FEATURES
from sensorloom.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Scaler:
    columns: tuple[str, ...]
    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill and standardise in place."""
        return df.withColumns({c: self._scaled(c) for c in self.columns})

    def _scaled(self, name: str) -> Column:
        filled = F.coalesce(_clean(name), F.lit(self.medians[name]))
        return (filled - F.lit(self.means[name])) / F.lit(self.stds[name])


def _clean(name: str) -> Column:
    return null_if_not_finite(F.col(name).cast("double"))


def guard_features(columns: Sequence[str]) -> None:
    leaked = sorted(set(columns) & NEVER_FEATURES)
    if leaked:
        raise ValueError(f"label or time columns among the features: {leaked}")


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Exact medians, then mean and sample deviation of the filled columns.

    A constant or empty column gets deviation 1, an all-null column median 0.
    """
    guard_features(columns)
    cleaned = train.select(*[_clean(c).alias(c) for c in columns])
    medians = {c: (q[0] if q[0] is not None else 0.0) for c, q in exact_quantiles(cleaned, columns, [0.5]).items()}
    filled = {c: F.coalesce(F.col(c), F.lit(medians[c])) for c in columns}
    row = cleaned.agg(
        *[F.avg(filled[c]).alias(f"m_{c}") for c in columns],
        *[F.stddev_samp(filled[c]).alias(f"s_{c}") for c in columns],
    ).first()
    means = {c: row[f"m_{c}"] or 0.0 for c in columns}
    stds = {c: row[f"s_{c}"] or 1.0 for c in columns}
    return Scaler(tuple(columns), medians, means, stds)


def with_vector(df: DataFrame, columns: Sequence[str], into: str = "features") -> DataFrame:
    """Features as one array column for numpy-side models."""
    guard_features(columns)
    return df.withColumn(into, F.array(*[F.col(c).cast("double") for c in columns]))
