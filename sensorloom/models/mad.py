"""Robust anomaly score: clipped distance from the median in median deviations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.scalars import clip
from sensorloom.operators.quantiles import exact_quantiles

# Fixed values
MIN_NORMAL_ROWS = 100
SMALLEST_DEVIATION = 1e-6
CLIP = 25.0


@dataclass(frozen=True)
class MadModel:
    center: dict[str, float]
    deviation: dict[str, float]

    def score(self) -> Column:
        """Mean of the clipped distances over the non-null features."""
        distances = [
            clip(F.abs((F.col(c) - F.lit(m)) / F.lit(self.deviation[c])), 0.0, CLIP)
            for c, m in self.center.items()
        ]
        total = sum((F.coalesce(d, F.lit(0.0)) for d in distances), F.lit(0.0))
        known = sum((F.when(d.isNotNull(), 1).otherwise(0) for d in distances), F.lit(0))
        return F.when(known > 0, total / known)


def fit_mad(train: DataFrame, columns: Sequence[str], normal: str = "normal_candidate") -> MadModel:
    """Learn from normal training rows; from all of them when fewer than 100 are normal."""
    rows = train.filter(F.col(normal) == 1)
    if rows.agg(F.count("*")).first()[0] < MIN_NORMAL_ROWS:
        rows = train
    medians = exact_quantiles(rows, columns, [0.5])
    center = {c: q[0] for c, q in medians.items() if q[0] is not None}
    away = rows.select(*[F.abs(F.col(c) - F.lit(m)).alias(c) for c, m in center.items()])
    spread = exact_quantiles(away, list(center), [0.5])
    deviation = {c: (1.0 if q[0] < SMALLEST_DEVIATION else q[0]) for c, q in spread.items()}
    return MadModel(center, deviation)
