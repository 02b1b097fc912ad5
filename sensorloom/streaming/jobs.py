"""Streaming jobs: sources to sinks with checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions.gates import Rule
from sensorloom.sources.events import decode_events
from sensorloom.spec import SensorSpec
from sensorloom.streaming import pipeline as p
from sensorloom.streaming.commits import Change, Commits
from sensorloom.streaming.stores import KeyValueStore, write_degraded


@dataclass(frozen=True)
class Trigger:
    """``available_now`` drains the source and stops; else a batch every ``interval``."""

    available_now: bool = False
    interval: str = "30 seconds"

    def kwargs(self) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": self.interval}


def append_parquet(
    rows: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = (), trigger: Trigger = Trigger()
) -> StreamingQuery:
    """File sink; its commit log makes each batch visible exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.trigger(**trigger.kwargs()).start(path)


def each_batch(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger.kwargs()).start()


def first_seen(rows: DataFrame, log: Commits, output: str, day: str, batch_id: int, key: str = "event_id") -> DataFrame:
    """Rows of a batch whose id is neither repeated in it nor in an earlier batch of ``output``.

    Ids are looked up in the days the batch touches, however late they are, and only the folders of those days are
    listed and read; there is no watermark, so no event is lost.  A null id is never a repeat.  Whole rows are shuffled
    once, by id and day, which serves the repeats within the batch and the look-up.
    """
    spark = rows.sparkSession
    marked = rows.withColumn("_nth", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    once = marked.repartition(key, day).dropDuplicates([key, day, "_nth"]).drop("_nth")
    touched = days_of(rows, day)
    schema = T.StructType([rows.schema[key], T.StructField(day, T.StringType())])
    known = log.read(spark, output, schema, touched, batch_id)
    return once.join(known, [key, day], "left_anti") if known.inputFiles() else once


def days_of(rows: DataFrame, day: str) -> list[str]:
    return [r[0] for r in rows.select(day).distinct().collect()]  # at most the days of the history


@dataclass(frozen=True)
class FirstSeen:
    """Deduplication as a sink: each id is stored once, by day."""

    spec: SensorSpec
    path: str
    compact_every: int = 50

    @property
    def log(self) -> Commits:
        return Commits(self.path)

    def handle(self, valid: DataFrame, batch_id: int) -> None:
        spark, log, day = valid.sparkSession, self.log, self.spec.day
        _tidy(spark, log, batch_id, self.compact_every)
        rows = p.readings_with_day(valid, self.spec).persist()
        try:
            found = log.write(first_seen(rows, log, "rows", day, batch_id).hint("rebalance", day), "rows", batch_id, day)
        finally:
            rows.unpersist()
        log.commit(spark, batch_id, [Change("rows", found)])

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return self.log.read(spark, "rows", T.StructType([*schema.fields, T.StructField(self.spec.day, T.StringType())]))


def _tidy(spark: SparkSession, log: Commits, batch_id: int, every: int) -> None:
    """Now and then, before a batch: those before it are done with and cannot come again."""
    if every and batch_id and batch_id % every == 0:
        log.compact(spark, batch_id)
        log.clean(spark)


def _merged_partials(new: DataFrame, log: Commits, output: str, spec: SensorSpec, batch_id: int) -> tuple[DataFrame, list[str]]:
    """KPI partials of the days a batch touches, with those of earlier batches added, and the days."""
    touched = days_of(new, spec.day)
    before = log.read(new.sparkSession, output, new.schema, touched, batch_id)
    return add_partials(before.unionByName(new), spec).hint("rebalance", spec.day), touched


@dataclass(frozen=True)
class MinuteKpi:
    """Event-time KPI of a stream from additive partials: an event counts however late it comes.

    A batch adds its partials to those of the days it touches and puts each such day in place of the one before, so a
    day has one folder and reading costs the same after any number of batches.  A repeated batch starts from the days as they
    were before it.  ``late`` tells per batch how many rows were older than the newest event of the batches before it
    less ``delay``.
    """

    spec: SensorSpec
    base: str
    delay: str = p.WATERMARK
    compact_every: int = 50

    @property
    def log(self) -> Commits:
        return Commits(self.base)

    def _progress(self) -> T.StructType:
        counts = [T.StructField(c, T.LongType()) for c in ("batch", "event_rows", "late_rows")]
        return T.StructType([T.StructField("newest", T.TimestampNTZType()), *counts])

    def handle(self, valid: DataFrame, batch_id: int) -> None:
        spark, log, time = valid.sparkSession, self.log, F.col(self.spec.time)
        _tidy(spark, log, batch_id, self.compact_every)
        kept = valid.persist()
        try:
            merged, _ = _merged_partials(kpi_partials(kept, self.spec), log, "partials", self.spec, batch_id)
            days = log.write(merged, "partials", batch_id, self.spec.day)
            newest = log.read(spark, "progress", self._progress(), before=batch_id).agg(F.max("newest")).first()[0]
            old = F.lit(False) if newest is None else time < F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")
            progress = kept.agg(
                F.max(time).alias("newest"), F.lit(batch_id).cast("long").alias("batch"), F.count(F.lit(1)).alias("event_rows"), F.count(F.when(old, 1)).alias("late_rows")
            )
            log.commit(spark, batch_id, [Change("partials", days, replace=True), Change("progress", log.write(progress, "progress", batch_id))])
        finally:
            kept.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        found = self.log.folders(spark, "partials")
        return merge_kpi(spark.read.parquet(*found).drop(self.spec.day), self.spec)

    def late(self, spark: SparkSession) -> DataFrame:
        return self.log.read(spark, "progress", self._progress())


@dataclass(frozen=True)
class FanOut:
    """Dead letters, readings, KPI partials, risk events and latest state from one source.

    All outputs of a batch appear at once, by one commit.  Repeats of an event id are dropped however far apart they come
    (``unique``).  KPI partials are kept added up per day.  The KPI cache gets the minutes a batch touches as they are over
    all batches.
    """

    spec: SensorSpec
    rules: Sequence[Rule]
    base: str
    kpi_state: KeyValueStore | None = None
    risk_state: KeyValueStore | None = None
    unique: bool = True
    compact_every: int = 50

    @property
    def log(self) -> Commits:
        return Commits(self.base)

    def _outputs(self, gate: DataFrame, valid: DataFrame) -> dict[str, DataFrame]:
        return {
            "dead_letters": p.rejected(gate, self.spec),
            "readings": p.readings_with_day(valid, self.spec),
            "kpi_partials": kpi_partials(valid, self.spec),
            "risk_events": p.scored(valid, self.spec),
        }

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        spark, log, day = batch.sparkSession, self.log, self.spec.day
        _tidy(spark, log, batch_id, self.compact_every)
        gate = p.gated(decode_events(batch, self.spec), self.rules).persist()
        valid = p.readings_with_day(p.accepted(gate), self.spec)
        if self.unique:
            valid = first_seen(valid, log, "readings", day, batch_id)
        valid = valid.hint("rebalance", day).select(p.accepted(gate).columns).persist()
        partials = kpi_partials(valid, self.spec).persist()
        try:
            outputs = self._outputs(gate, valid) | {"kpi_partials": partials}
            outputs["kpi_partials"], touched = _merged_partials(partials, log, "kpi_partials", self.spec, batch_id)
            changes = [
                Change(name, log.write(rows, name, batch_id, day if day in rows.columns else None), replace=name == "kpi_partials")
                for name, rows in outputs.items()
            ]
            log.commit(spark, batch_id, changes)
            if self.kpi_state:
                minutes = partials.select(day, "window_start", self.spec.state)
                over_all = self.read(spark, "kpi_partials", touched).join(minutes, minutes.columns, "left_semi")
                write_degraded(self.kpi_state, merge_kpi(over_all, self.spec), batch_id)
            if self.risk_state:
                newest = p.latest_per_key(outputs["risk_events"], ["equipment_id"], [self.spec.time, self.spec.row_id])
                write_degraded(self.risk_state, newest, batch_id)
        finally:
            partials.unpersist()
            valid.unpersist()
            gate.unpersist()

    def start(self, payloads: DataFrame, checkpoint: str, trigger: Trigger = Trigger()) -> StreamingQuery:
        return each_batch(payloads, self.handle, checkpoint, trigger=trigger)

    def read(self, spark: SparkSession, output: str, days: Sequence[str] | None = None) -> DataFrame:
        """An output over all committed batches; the schema is declared, as there may be no row yet."""
        nothing = p.gated(decode_events(spark.createDataFrame([], "value string"), self.spec), self.rules)
        return self.log.read(spark, output, self._outputs(nothing, p.accepted(nothing))[output].schema, days)


def kpi_partials(valid: DataFrame, spec: SensorSpec, averages: Sequence[str] = p.KPI_AVERAGES) -> DataFrame:
    """Sums and counts per event minute and state of one batch, with the day; batches add up."""
    minute = F.window(F.col(spec.time), "1 minute")["start"].alias("window_start")
    state = F.coalesce(F.col(spec.state), F.lit("unknown")).alias(spec.state)
    return valid.groupBy(minute, state).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.sum(F.when(F.col(spec.flag) == 1, 1).otherwise(0)).alias("failure_sample_count"),
        *[F.sum(c).alias(f"sum_{c}") for c in averages],
        *[F.count(c).alias(f"count_{c}") for c in averages],
    ).withColumn(spec.day, F.date_format("window_start", "yyyy-MM-dd"))


def add_partials(partials: DataFrame, spec: SensorSpec) -> DataFrame:
    """Partials of one row per minute and state, the sums of all."""
    keys = ["window_start", spec.state, spec.day]
    sums = [F.sum(c).alias(c) for c in partials.columns if c not in keys]
    return partials.groupBy(*keys).agg(*sums).select(partials.columns)


def merge_kpi(partials: DataFrame, spec: SensorSpec, averages: Sequence[str] = p.KPI_AVERAGES) -> DataFrame:
    """Minute KPI from the partials of any number of batches."""
    counts = ["sample_count", "failure_sample_count"]
    sums = partials.groupBy("window_start", spec.state).agg(
        *[F.sum(c).alias(c) for c in counts],
        *[(F.sum(f"sum_{c}") / F.sum(f"count_{c}")).alias(f"avg_{c}") for c in averages],
    )
    return sums.withColumns(
        {
            "failure_window_rate": F.col("failure_sample_count") / F.col("sample_count"),
            "minute_bucket": F.date_format("window_start", "yyyy-MM-dd HH:mm:00"),
            spec.day: F.date_format("window_start", "yyyy-MM-dd"),
        }
    )
