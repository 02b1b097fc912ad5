"""Small numeric and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.spec import StateBands


def null_if_not_finite(value: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def finite_or(value: Column, default: float = 0.0) -> Column:
    """A finite double from any type; null, unparsable, NaN or infinite gives the default."""
    return F.coalesce(null_if_not_finite(value.try_cast("double")), F.lit(float(default)))


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def safe_ratio(part: Column, total: Column) -> Column:
    """``part / total``, 0.0 for an empty total."""
    return F.when(total > 0, part.cast("double") / total).otherwise(F.lit(0.0))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(z, -35.0, 35.0)))


def epoch_micros(moment: Column) -> Column:
    """Microseconds since the epoch (the session zone is UTC)."""
    return F.unix_micros(moment.cast("timestamp"))


def day_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def bucket_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:00")


def bucket_start(df: DataFrame, time: str, unit: str) -> Column:
    """Start of the minute/hour/day, of the same timestamp type as the time column."""
    kind = df.schema[time].dataType
    return F.date_trunc(unit, F.col(time)).cast(kind)


def band(value: Column, bands: StateBands) -> Column:
    """State name by descending lower bounds; null and NaN fall to the default state."""
    known = F.nanvl(value, F.lit(None).cast("double"))
    chain = None
    for bound, name in bands.bands:
        test = known >= F.lit(bound)
        chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
    return chain.otherwise(F.lit(bands.default))


def one_hot(value: Column, categories: Sequence[str], prefix: str, missing: str | None = None) -> list[Column]:
    """0/1 columns, one per category; ``missing`` names the category null belongs to."""
    known = value if missing is None else F.coalesce(value, F.lit(missing))
    return [
        F.coalesce((known == F.lit(c)).cast("int"), F.lit(0)).alias(f"{prefix}{c}")
        for c in categories
    ]
