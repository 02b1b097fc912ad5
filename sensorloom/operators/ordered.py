"""Row order without a natural partition key: previous row, running totals, rank.

A window with only ORDER BY runs in one task.  Here one range exchange puts rows into slices that follow each other in the
order, each with all its sort columns, and the slices are written once: the input is evaluated for the exchange's sample
and for the exchange, and never again.  Each slice is one window group, and what has to cross a border (the last row, a
subtotal) travels through a table with one row per slice.  A key, day or single instant that holds a third of all rows is
cut like any other stretch, because the exchange cuts by key, time and tie breaker together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.scalars import epoch_micros
from sensorloom.session import stored

#: Slices asked for; None leaves it to the session's shuffle partitions, of which adaptive execution merges small ones.
PARTITIONS: int | None = None


@dataclass(frozen=True)
class Order:
    """Sort order: ``key`` (a time or a number), then ``tie`` (a number or a time).

    ``by`` restarts the order per key.  ``descending`` turns the key, never the tie.
    ``text_tie`` is a last resort for keys whose ties only a text column separates; text
    orders rows but does not cut hot instants.
    """

    key: str
    tie: str | None = None
    by: tuple[str, ...] = ()
    descending: bool = False
    text_tie: str | None = None


def _position(df: DataFrame, name: str, descending: bool = False) -> Column:
    """A double that sorts like the column; epoch micros are exact below 2**53."""
    kind = df.schema[name].dataType
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
    value = (epoch_micros(F.col(name)) if timed else F.col(name)).cast("double")
    value = -value if descending else value
    # null sorts first and NaN last, as in Spark's own ascending order
    return F.coalesce(F.nanvl(value, F.lit(math.inf)), F.lit(-math.inf))


def _exact(df: DataFrame, name: str, descending: bool = False) -> Column:
    """A value that sorts like the column without loss where ``_position`` rounds: longs and times.

    A bitwise complement turns the order of longs around exactly.  Nulls are told apart by the
    position, and other types are exact in it.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = epoch_micros(F.col(name)).cast("long")
    elif isinstance(kind, T.LongType):
        value = F.col(name)
    elif isinstance(kind, T.DecimalType):
        return -F.col(name) if descending else F.col(name)
    else:
        return F.lit(0)
    return F.bitwise_not(value) if descending else value


@dataclass(frozen=True)
class InOrder:
    """Stored rows with their sort columns ``_pos``, ``_key``, ``_tie``, ``_last`` and ``_slice``, the number of their stretch."""

    order: Order
    rows: DataFrame

    @property
    def columns(self) -> list[str]:
        return [*self.order.by, "_slice"]

    @property
    def sort(self) -> list[Column]:
        return _sort(self.order)

    def window(self):
        return Window.partitionBy(*self.columns).orderBy(*self.sort)

    def across(self):
        """Window over the table of slices, in order."""
        ordered = Window.partitionBy(*self.order.by) if self.order.by else Window.partitionBy()
        return ordered.orderBy("_slice")

    def join(self, df: DataFrame, table: DataFrame) -> DataFrame:
        """Join a table of what crosses borders back, by slice and key.

        Of the keys in a slice only the first goes on from an earlier slice and only the last into a later one: rows in
        which nothing crosses are left out, and the number of the others is bounded by that of slices.
        """
        names = [c for c in table.columns if c not in self.columns]
        some = table.where(reduce(Column.__or__, [F.col(c).isNotNull() for c in names]))
        same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in self.columns]
        return df.alias("_l").join(F.broadcast(some).alias("_r"), same, "left").select("_l.*", *[f"_r.{c}" for c in names])


def _sort(order: Order) -> list[Column]:
    last = [F.col(order.text_tie)] if order.text_tie else []
    return [F.col("_pos"), F.col("_key"), F.col("_tie"), F.col("_last"), *last]


def in_order(df: DataFrame, order: Order, slices: int | None = None) -> InOrder:
    """``df`` in slices of the order, written once.  Where borders fall never changes a result."""
    keyed = df.withColumns(
        {
            "_pos": _position(df, order.key, order.descending),
            "_key": _exact(df, order.key, order.descending),
            "_tie": _position(df, order.tie) if order.tie else F.lit(0.0),
            "_last": _exact(df, order.tie) if order.tie else F.lit(0),
        }
    )
    by = [*[F.col(c) for c in order.by], *_sort(order)]
    number = PARTITIONS or slices
    ranged = keyed.repartitionByRange(number, *by) if number else keyed.repartitionByRange(*by)
    return InOrder(order, stored(ranged.withColumn("_slice", F.spark_partition_id()), "ordered"))


def before_and_after(found: InOrder):
    """Windows over the table of slices: the slices before each one and those after it."""
    turned = (Window.partitionBy(*found.order.by) if found.order.by else Window.partitionBy()).orderBy(F.desc("_slice"))
    return tuple(w.rowsBetween(Window.unboundedPreceding, -1) for w in (found.across(), turned))


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop("_pos", "_key", "_tie", "_last", "_slice")


def with_previous(
    df: DataFrame,
    order: Order,
    columns: Sequence[str],
    into: str = "_prev",
    sequence: str | None = None,
) -> DataFrame:
    """Add a struct of ``columns`` of the previous row, null for the first row.

    ``sequence`` names a long that sorts rows like the order does (per key); it has gaps
    between slices.
    """
    found = in_order(df, order)
    payload = F.struct(*[F.col(c) for c in columns])
    inner = found.rows.withColumn(into, F.lag(payload).over(found.window()))
    if sequence:
        # rows of a slice stay below 2**32
        inner = inner.withColumn(sequence, F.col("_slice").cast("long") * (1 << 32) + F.row_number().over(found.window()))
    last = F.max_by(payload, F.struct(*found.sort)).alias("_tail")
    # structs alone would make this a sort of all rows; a list aggregate beside them (always
    # empty) lets Spark hash the rows of the few slices a task sees
    hashed = F.collect_list(F.lit(None).cast("int")).alias("_none")
    tails = found.rows.groupBy(*found.columns).agg(last, hashed)
    before = F.lag("_tail").over(found.across())
    carried = tails.filter(F.size("_none") == 0).select(*found.columns, before.alias("_carry"))
    joined = found.join(inner, carried)
    return drop_helpers(joined.withColumn(into, F.coalesce(into, "_carry")).drop("_carry"))


def _running_totals(found: InOrder, totals: Mapping[str, Column]) -> DataFrame:
    upto = found.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = found.rows.withColumns({name: F.sum(value).over(upto) for name, value in totals.items()})
    sums = found.rows.groupBy(*found.columns).agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    before = found.across().rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*found.columns, *[F.sum(n).over(before).alias(f"_before_{n}") for n in totals])
    joined = found.join(inner, offsets)
    summed = joined.withColumns({n: F.col(n) + F.coalesce(f"_before_{n}", F.lit(0)) for n in totals})
    return drop_helpers(summed.drop(*[f"_before_{n}" for n in totals]))


def with_running_totals(df: DataFrame, order: Order, totals: Mapping[str, Column]) -> DataFrame:
    """Add inclusive running sums in order."""
    return _running_totals(in_order(df, order), totals)


def with_index(df: DataFrame, order: Order, into: str = "_index") -> DataFrame:
    """Add the dense 1-based position in order."""
    return with_running_totals(df, order, {into: F.lit(1).cast("long")})


def downsample(df: DataFrame, order: Order, max_rows: int) -> DataFrame:
    """Every k-th row, ``k = max(1, n // max_rows)``, starting at row k.

    Unchanged when there are at most ``max_rows`` rows; more than ``max_rows`` rows remain
    when k is 1.
    """
    found = in_order(df, order)
    total = found.rows.count()
    step = max(1, total // max_rows)
    if total <= max_rows or step == 1:
        return drop_helpers(found.rows)
    return _running_totals(found, {"_index": F.lit(1).cast("long")}).filter(F.col("_index") % step == 0).drop("_index")


def ordered_split(df: DataFrame, order: Order, share: float = 0.7) -> DataFrame:
    """Add ``split``: 'train' for the first ``int(share * n)`` rows in order, else 'test'.

    Both sides keep at least one row.  Only the slice that holds the cut is ranked; the
    rest is decided by the place of its slice.
    """
    found = in_order(df, order)
    total = found.rows.count()
    cut = max(1, min(int(total * share), total - 1))
    sizes = found.rows.groupBy("_slice").count()
    upto = Window.partitionBy().orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holder = (
        sizes.withColumn("_upto", F.sum("count").over(upto))
        .filter((F.col("_upto") >= cut) & (F.col("_upto") - F.col("count") < cut))
        .select("_slice", (F.lit(cut) - F.col("_upto") + F.col("count")).alias("_nth"))
        .first()
    )
    if holder is None:  # no rows
        return df.withColumn("split", F.lit("train"))
    side = lambda first: F.when(first, "train").otherwise("test")
    at = F.lit(holder["_slice"])
    others = found.rows.filter(F.col("_slice") != at).withColumn("split", side(F.col("_slice") < at))
    ranked = found.rows.filter(F.col("_slice") == at).withColumn("_rank", F.row_number().over(Window.partitionBy("_slice").orderBy(*found.sort)))
    inside = ranked.withColumn("split", side(F.col("_rank") <= holder["_nth"])).drop("_rank")
    return drop_helpers(others.unionByName(inside))


def seconds_to_next(
    df: DataFrame, events: DataFrame, order: Order, event_time: str, into: str = "seconds_to_next"
) -> DataFrame:
    """Seconds to the next row of ``events`` strictly after each row, null after the last.

    For event tables of any size: both sides are merged into one order and the nearest
    later event is carried back across slices, so nothing is broadcast and no pair of
    rows is formed.
    """
    keys = list(order.by)
    reading = df.select(F.struct(*df.columns).alias("_row"), *keys, epoch_micros(F.col(order.key)).alias("_at"))
    marks = events.select(
        *keys, epoch_micros(F.col(event_time)).alias("_at"), F.lit(True).alias("_mark")
    ).distinct()
    merged = reading.unionByName(marks, allowMissingColumns=True)
    # later rows first; at one instant every reading goes before the mark, so it only sees
    # later marks, and a hash among readings lets a hot instant be cut
    spread = F.pmod(F.xxhash64("_row"), F.lit(1 << 31))
    ranked = merged.withColumns(
        {"_order": -F.col("_at"), "_rank": F.when(F.col("_mark"), F.lit(1 << 31)).otherwise(spread)}
    )
    found = in_order(ranked, Order("_order", "_rank", order.by))
    mark_at = F.when(F.col("_mark"), F.col("_at"))
    upto = found.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = found.rows.withColumn("_next", F.last(mark_at, ignorenulls=True).over(upto))
    tails = found.rows.groupBy(*found.columns).agg(F.min(mark_at).alias("_tail"))
    before = found.across().rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*found.columns, F.min("_tail").over(before).alias("_carry"))
    inner = found.join(inner, carried).withColumn("_next", F.coalesce("_next", "_carry"))
    kept = inner.filter(F.col("_mark").isNull())
    wait = (F.col("_next") - F.col("_at")) / F.lit(1e6)
    return kept.select("_row.*", wait.alias(into))
