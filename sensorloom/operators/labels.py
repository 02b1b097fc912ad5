"""Incident calendars as tables: cleaning, overlaps, and membership for any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.scalars import epoch_micros
from sensorloom.operators.ordered import Order, drop_helpers, in_order, with_running_totals

_FORMAT = "yyyy-MM-dd HH:mm:ss"


def interval_calendar(rows: DataFrame, line: str, order: str) -> DataFrame:
    """Text rows ``start|end|type`` to typed intervals with a list of issues per row.

    An interval without issues is usable; a broken row keeps what could be read.
    """
    parts = F.transform(F.split(F.col(line), r"\|"), lambda p: F.trim(p))
    out = rows.withColumn("_p", parts)
    three = F.size("_p") == 3
    start = F.try_to_timestamp(F.get("_p", 0), F.lit(_FORMAT)).cast("timestamp_ntz")
    end = F.try_to_timestamp(F.get("_p", 1), F.lit(_FORMAT)).cast("timestamp_ntz")
    out = out.withColumns(
        {
            "start": F.when(three, start),
            "end": F.when(three, end),
            "interval_type": F.when(three & (F.get("_p", 2) != ""), F.get("_p", 2)),
        }
    )
    issues = F.array_compact(
        F.array(
            F.when(~three, F.lit("not_three_parts")),
            F.when(three & F.col("start").isNull(), F.lit("bad_start")),
            F.when(three & F.col("end").isNull(), F.lit("bad_end")),
            F.when(three & F.col("interval_type").isNull(), F.lit("empty_type")),
            F.when(F.col("start") > F.col("end"), F.lit("end_before_start")),
        )
    )
    severity = F.when(F.col("interval_type").contains("high"), "high_stress").when(
        F.col("interval_type").isNotNull(), "unknown"
    )
    return out.withColumns({"issues": issues, "severity": severity}).drop("_p")


def with_overlap_flag(
    calendar: DataFrame, by: Sequence[str] = (), start: str = "start", end: str = "end", tie: str = "interval_id"
) -> DataFrame:
    """Mark intervals that start before (or when) an earlier one ends.

    The latest earlier end is a running maximum; it is kept per slice like any running
    total, so a key with very many intervals is not one task.
    """
    order = Order(start, tie, tuple(by))
    seen = with_running_max(calendar.withColumn("_end_us", epoch_micros(F.col(end))), order, "_end_us", "_latest")
    overlaps = F.coalesce((epoch_micros(F.col(start)) <= F.col("_latest")).cast("int"), F.lit(0))
    return seen.withColumn("overlaps_earlier", overlaps).drop("_end_us", "_latest")


def with_running_max(df: DataFrame, order: Order, value: str, into: str) -> DataFrame:
    """Maximum over all earlier rows, null for the first."""
    found = in_order(df, order)
    before = found.window().rowsBetween(Window.unboundedPreceding, -1)
    inner = found.rows.withColumn(into, F.max(value).over(before))
    tops = found.rows.groupBy(*found.columns).agg(F.max(value).alias("_top"))
    earlier = found.across().rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*found.columns, F.max("_top").over(earlier).alias("_carry"))
    inner = found.join(inner, carried).withColumn(into, F.greatest(into, "_carry")).drop("_carry")
    return drop_helpers(inner)


def flags_by_table(
    df: DataFrame,
    calendar: DataFrame,
    order: Order,
    pre_hours: int,
    post_hours: int,
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """Membership, pre-horizon and recovery flags against a table of intervals of any size.

    Each interval becomes +1/-1 steps at the borders of its three spans; merged into the
    order of the readings, the running sums say how many spans of each kind are open at a
    reading.  No row is paired with an interval, so overlaps and hot keys cost nothing.
    """
    keys = list(order.by)
    spans = ("failure_window", "pre_failure", "post_maintenance")
    begin, finish = epoch_micros(F.col(start)), epoch_micros(F.col(end))
    hour = 3_600_000_000
    steps = F.array(
        _step("failure_window", begin, 1),
        _step("failure_window", finish + 1, -1),
        _step("pre_failure", begin - pre_hours * hour, 1),
        _step("pre_failure", begin, -1),
        _step("post_maintenance", finish + 1, 1),
        _step("post_maintenance", finish + post_hours * hour + 1, -1),
    )
    moved = calendar.select(*keys, F.explode(steps).alias("_s")).groupBy(*keys, F.col("_s.at").alias("_at"))
    marks = moved.agg(*[F.sum(F.when(F.col("_s.span") == s, F.col("_s.move"))).alias(f"_d_{s}") for s in spans])
    rows = df.select(F.struct(*df.columns).alias("_row"), *keys, epoch_micros(F.col(order.key)).alias("_at"))
    merged = rows.unionByName(marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True)
    # at one instant the step comes first; readings are spread by hash so they can be cut
    spread = F.pmod(F.xxhash64("_row"), F.lit(1 << 31))
    merged = merged.withColumn("_rank", F.when(F.col("_mark"), F.lit(-1)).otherwise(spread))
    sums = {f"_open_{s}": F.coalesce(F.col(f"_d_{s}"), F.lit(0)) for s in spans}
    ranked = with_running_totals(merged, Order("_at", "_rank", order.by), sums)
    flags = [(F.col(f"_open_{s}") > 0).cast("int").alias(s) for s in spans]
    return ranked.filter(F.col("_mark").isNull()).select("_row.*", *flags)


def _step(span: str, at, move: int):
    return F.struct(F.lit(span).alias("span"), at.alias("at"), F.lit(move).alias("move"))
