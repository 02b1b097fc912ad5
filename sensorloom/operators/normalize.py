"""Raw text readings to typed, labelled readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import intervals
from sensorloom.functions.scalars import band, bucket_start, day_text
from sensorloom.spec import Calendar, SensorSpec


def _is_unnamed(name: str) -> bool:
    return not name.strip() or name.startswith("_c") or name.lower().startswith("unnamed")


def standardise_columns(df: DataFrame, spec: SensorSpec) -> DataFrame:
    """Rename header spellings to standard names; the unnamed index becomes the row id."""
    renames = {raw: std for raw, std in spec.aliases.items() if raw in df.columns and raw != std}
    unnamed = [c for c in df.columns if _is_unnamed(c)]
    if unnamed and spec.row_id not in df.columns:
        renames[unnamed[0]] = spec.row_id
    doubled = {s for s in renames.values() if list(renames.values()).count(s) > 1}
    if doubled:
        raise ValueError(f"several raw columns map to one name: {sorted(doubled)}")
    out = df.withColumnsRenamed(renames)
    missing = [c for c in [f"{spec.time}_raw", *spec.names] if c not in out.columns]
    if missing:
        raise ValueError(f"missing raw columns: {missing}")
    return out


def typed(df: DataFrame, spec: SensorSpec, zone: str = "ntz") -> DataFrame:
    """Cast text columns; a value that does not parse becomes null.

    Without an index column the row id is a hash of the row, which a rerun or a lost
    executor reproduces (a running number by partition would not).
    """
    row_id = (
        F.col(spec.row_id).try_cast("long")
        if spec.row_id in df.columns
        else F.xxhash64(*[F.col(c) for c in df.columns])
    )
    stamp = F.try_to_timestamp(F.col(f"{spec.time}_raw"), F.lit(spec.time_format))
    kind = "timestamp_ntz" if zone == "ntz" else "timestamp"
    return df.select(
        row_id.alias(spec.row_id),
        stamp.cast(kind).alias(spec.time),
        *[F.col(c).try_cast("double").alias(c) for c in spec.names],
        *[F.col(c) for c in df.columns if c.startswith("_source_")],
    )


def with_time_columns(df: DataFrame, spec: SensorSpec) -> DataFrame:
    """Date, bucket start and day text."""
    return df.withColumns(
        {
            "event_date": F.to_date(F.col(spec.time)),
            spec.bucket: bucket_start(df, spec.time, spec.bucket_unit),
            spec.day: day_text(F.col(spec.time)),
        }
    )


def with_state(df: DataFrame, spec: SensorSpec) -> DataFrame:
    return df.withColumn(spec.state, band(F.col(spec.bands.source), spec.bands))


def with_interval_label(
    df: DataFrame, spec: SensorSpec, calendar: Calendar, on_overlap: str = "last"
) -> DataFrame:
    """0/1 membership in any incident interval and the type of the covering one."""
    time = F.col(spec.time)
    return df.withColumns(
        {
            spec.flag: intervals.flag(intervals.in_any(time, calendar)),
            spec.label: intervals.interval_type(time, calendar, on_overlap),
        }
    )


def with_deltas(df: DataFrame, spec: SensorSpec) -> DataFrame:
    return df.withColumns({d.name: F.col(d.left) - F.col(d.right) for d in spec.deltas})


def with_lineage(
    df: DataFrame, system: str, file: Column | None = None, loaded_at: Column | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "source_system": F.lit(system),
            "source_file": F.lit(None).cast("string") if file is None else file,
            "ods_loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
        }
    )


def normalize(
    raw: DataFrame, spec: SensorSpec, calendar: Calendar, keep_rejects: bool = False
) -> DataFrame:
    """Raw text to typed, bucketed, labelled and banded readings.

    Rows whose time does not parse are dropped unless ``keep_rejects``, which keeps them
    with a null time so that ``quarantine`` can report them.
    """
    out = typed(standardise_columns(raw, spec), spec)
    if not keep_rejects:
        out = out.filter(F.col(spec.time).isNotNull())
    return with_state(with_interval_label(with_time_columns(out, spec), spec, calendar), spec)


def quarantine(raw: DataFrame, spec: SensorSpec) -> DataFrame:
    """Raw rows whose time is missing or does not parse, with the reason."""
    named = standardise_columns(raw, spec)
    text = F.col(f"{spec.time}_raw")
    stamp = F.try_to_timestamp(text, F.lit(spec.time_format))
    reason = F.when(text.isNull(), F.lit("missing_time")).otherwise(F.lit("unparsable_time"))
    return named.filter(stamp.isNull()).withColumn("reason", reason)
