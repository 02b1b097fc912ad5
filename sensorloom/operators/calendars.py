"""Incident calendars as tables of any size, per key: type, horizons, recovery, remaining time, lead time.

Readings and the starts and ends of incidents are merged once in the order of time, and every label follows from three
neighbours of a reading: the next start, the last end, and the incident that wins among those open.  In a slice of the order
the open incidents are a stabbing query over positions, settled by numpy in rows times the logarithm of rows; an incident
that covers whole slices is dealt to dyadic blocks of slices, of which each keeps its winner.  No reading is paired with an
incident, and what is shuffled, once, is one row per reading and two per incident.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.scalars import epoch_micros
from sensorloom.operators.ordered import InOrder, Order, before_and_after, seconds_to_next
from sensorloom.session import stored

HORIZONS = (1, 6, 24)
POST_HOURS = 24
_HOUR = 3_600_000_000
_START, _END = 1, 2  # sides of an incident; readings have none
_WHO = ("_listed", "_s", "_kind")
_SETTLED = ("_slice", "_side", "_at", "_row", "_ended", "_next", *_WHO, "_e")
#: Levels of blocks of slices, enough for 2**24 slices.
_LEVELS = 24
#: Rows of a slice that one task holds.
SLICE_ROWS = 1_000_000


def _instant(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def _who() -> Column:
    """The incident as a struct that sorts by listing, start and type, null without one."""
    return F.when(F.col("_s").isNotNull(), F.struct(*_WHO))


def _merged(df: DataFrame, spans: DataFrame, order: Order, keys: list[str], schema: T.StructType, last_wins: bool) -> InOrder:
    """Readings, settled slice by slice, and both ends of every incident in one order; at one instant the ends go first.

    What orders the rows is evaluated by the exchange and does not travel with them, and a slice is settled where the
    exchange delivers it: rows are shuffled once and written once.
    """
    reading = df.select(F.struct(*df.columns).alias("_row"), *keys, epoch_micros(F.col(order.key)).alias("_at"))
    side = lambda n, c: F.struct(F.lit(n).cast("byte").alias("_side"), F.col(c).alias("_at"))
    ends = spans.select(*keys, "_listed", "_kind", (F.col("_e") - F.col("_s")).alias("_long"), F.explode(F.array(side(_START, "_s"), side(_END, "_e"))).alias("_x"))
    merged = reading.unionByName(ends.select("*", "_x.*").drop("_x"), allowMissingColumns=True)
    # a hash among the rows of one instant lets a hot instant be cut, among readings and among ends
    spread = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 31))
    rank = F.when(F.col("_side").isNotNull(), -1 - spread("_listed", "_long", "_kind")).otherwise(spread("_row"))
    wanted = (df.count() + 2 * spans.count()) // SLICE_ROWS + 1
    by = [*keys, "_at", rank]
    number = max(wanted, df.sparkSession.sparkContext.defaultParallelism)
    ranged = merged.repartitionByRange(number, *by) if wanted > 1 else merged.repartitionByRange(*by)
    return InOrder(Order("_at", None, tuple(keys)), stored(ranged.mapInArrow(_settled(keys, last_wins), schema), "ordered"))


def _best(lo: np.ndarray, hi: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """Largest rank of the ranges ``lo .. hi - 1`` over each of n positions, else -1.

    A range is two stretches of the same power of two; stretches are halved level by level.
    """
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    best = np.full(n, -1, dtype=np.int64)
    for k in range(int(level.max(initial=0)), -1, -1):
        here = level == k
        np.maximum.at(best, lo[here], rank[here])
        np.maximum.at(best, hi[here] - (1 << k), rank[here])
        if k:
            half = 1 << (k - 1)
            whole, best = best, best.copy()
            best[half:] = np.maximum(whole[half:], whole[:-half])
    return best


def _changes(rows: pa.Table) -> np.ndarray:
    """Whether a row differs from the one before it; nulls are equal."""
    n = rows.num_rows
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for column in rows.columns:
        one, two = column.slice(0, max(n - 1, 0)), column.slice(1)
        same = pc.or_kleene(pc.equal(one, two).fill_null(False), pc.and_(one.is_null(), two.is_null()))
        new[1:] |= ~same.to_numpy().astype(bool)
    return new


def _sorted(rows: pa.Table) -> np.ndarray:
    return pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in rows.column_names], null_placement="at_start").to_numpy().astype(np.int64)


def _settled(keys: list[str], last_wins: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One slice: its readings with the last end, the next start and the winner among the incidents with an end in it, and
    its ends; those whose other end is in another slice keep what the incident is.
    """

    def settle(rows: pa.Table, number: int) -> Iterator[pa.Table]:
        side = rows["_side"].fill_null(0).to_numpy()
        order = _sorted(rows.select([*keys, "_at"]).append_column("_reading", pa.array(side == 0)))
        near, side = rows.select([*keys, "_at"]).take(pa.array(order)), side[order]
        n = len(side)
        place = np.arange(n)
        fresh = _changes(near.select(keys)) if keys else place == 0
        starts = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        first, after = starts[group], np.append(starts[1:], n)[group]
        reading = side == 0
        asked = np.flatnonzero(reading)
        ended = np.maximum.accumulate(np.where(side == _END, place, -1))
        coming = np.minimum.accumulate(np.where(side == _START, place, n)[::-1])[::-1]
        at = near["_at"].fill_null(0).to_numpy()
        pick = lambda found, ok: pa.array(at[np.where(ok, found, 0)], mask=~ok)
        ended, coming = ended[asked], coming[asked]

        # the ends of an incident next to each other, and incidents in the order in which they win
        ends = np.flatnonzero(~reading)
        who = rows.select(["_listed", "_kind"]).take(pa.array(order[ends]))
        long = rows["_long"].take(pa.array(order[ends])).to_numpy()
        opening = side[ends] == _START
        s, e = np.where(opening, at[ends], at[ends] - long), np.where(opening, at[ends] + long, at[ends])
        who = pa.table([who["_listed"], pa.array(s), who["_kind"], pa.array(e), pa.array(group[ends])], names=[*_WHO, "_e", "_group"])
        by = _sorted(who.append_column("_side", pa.array(side[ends])))
        lead = np.flatnonzero(_changes(who.take(pa.array(by))))
        sizes = np.diff(np.append(lead, len(by)))
        one, last = ends[by[lead]], ends[by[lead + sizes - 1]]
        opens, closes = side[one] == _START, side[last] == _END
        lone = np.zeros(len(ends), dtype=bool)
        lone[by] = np.repeat(~(opens & closes), sizes)
        upto = np.append(0, np.cumsum(reading))
        lo, hi = upto[np.where(opens, one, first[one])], upto[np.where(closes, last, after[last])]
        rank = np.arange(len(lead)) if last_wins else np.arange(len(lead))[::-1]
        over = hi > lo
        best = _best(lo[over], hi[over], rank[over], len(asked))
        # a null place takes nulls
        won = who.take(pa.array(by[lead[(best if last_wins else -1 - best) % len(lead)]], mask=best < 0)) if len(lead) else None

        def told(places: np.ndarray, columns: dict[str, pa.Array]) -> pa.Table:
            key = near.select(keys).take(pa.array(places))
            known = {**{c: key[c] for c in keys}, "_slice": pa.array(np.full(len(places), number, dtype=np.int32)), **columns}
            kinds = {**{c: rows.schema.field(c).type for c in ("_side", "_row", "_listed", "_kind")}, "_ended": pa.int64(), "_next": pa.int64(), "_s": pa.int64(), "_e": pa.int64()}
            names = [*keys, *_SETTLED]
            return pa.table([known[c] if c in known else pa.nulls(len(places), kinds[c]) for c in names], names=names)

        yield told(
            asked,
            {
                "_at": near["_at"].take(pa.array(asked)),
                "_row": rows["_row"].take(pa.array(order[asked])),
                "_ended": pick(ended, ended >= first[asked]),
                "_next": pick(coming, coming < after[asked]),
                **({c: won[c] for c in _WHO} if won is not None else {}),
            },
        )
        kept = who.take(pa.array(np.arange(len(ends)), mask=~lone))
        yield told(ends, {"_side": pa.array(side[ends]), "_at": pa.array(at[ends]), **{c: kept[c] for c in (*_WHO, "_e")}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            for table in settle(pa.Table.from_batches(parts).combine_chunks(), TaskContext.get().partitionId()):
                yield from table.combine_chunks().to_batches(max_chunksize=50_000)

    return run


def _over_slices(found: InOrder, on_overlap: str) -> DataFrame:
    """keys, ``_slice`` and the winner ``_over`` among the incidents that open in an earlier slice and end in a later one."""
    keys = list(found.order.by)
    pick = F.max if on_overlap == "last" else F.min
    bounds = found.rows.groupBy(*found.columns).agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    # slices of keys that have three or more: their number is bounded by that of slices
    stretch = bounds.groupBy(*keys).agg(F.min("_slice").alias("_a"), F.max("_slice").alias("_b")).where("_b - _a > 1")
    same = lambda left, right, names: [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names]
    wide = bounds.alias("x").join(F.broadcast(stretch).alias("y"), same("x", "y", keys) or F.lit(True), "left_semi")
    # an incident that covers a whole slice reaches the far side of the slice next to that of each of its ends
    wide = wide.select(*found.columns, F.lag("_lo").over(found.across()).alias("_before"), F.lead("_hi").over(found.across()).alias("_beyond"))
    wide = stored(wide, "calendar-slices")
    ends = found.rows.where("_side is not null and _s is not null").select(*found.columns, "_side", "_e", *_WHO)
    held = ends.alias("x").join(F.broadcast(wide).alias("y"), same("x", "y", found.columns)).select("x.*", "_before", "_beyond")
    leaving = held.where(((F.col("_side") == _START) & (F.col("_e") >= F.col("_beyond"))) | ((F.col("_side") == _END) & (F.col("_s") <= F.col("_before"))))
    crossing = leaving.groupBy(*keys, "_e", *_WHO).agg(F.min("_slice").alias("_a"), F.max("_slice").alias("_b")).where("_b - _a > 1")
    # slices _a + 1 .. _b - 1; at each level the odd block at either end is one of its own
    levels = F.sequence(F.lit(0), F.lit(_LEVELS))
    right, left = (lambda c, j: F.call_function("shiftright", c, j)), (lambda c, j: F.call_function("shiftleft", c, j))
    blocks = F.transform(
        levels,
        lambda j: F.struct(j.alias("level"), right(F.col("_a") + left(F.lit(1), j), j).alias("lo"), right(F.col("_b"), j).alias("hi")),
    )
    taken = F.flatten(
        F.transform(
            F.filter(blocks, lambda b: b.lo < b.hi),
            lambda b: F.array_compact(
                F.array(
                    F.when(b.lo % 2 == 1, F.struct(b.level.alias("level"), b.lo.alias("block"))),
                    F.when(b.hi % 2 == 1, F.struct(b.level.alias("level"), (b.hi - 1).alias("block"))),
                )
            ),
        )
    )
    won = crossing.select(*keys, _who().alias("_over"), F.explode(taken).alias("b")).groupBy(*keys, "b.level", "b.block").agg(pick("_over").alias("_over"))
    asked = wide.select(*found.columns, F.explode(levels).alias("level")).withColumn("block", F.call_function("shiftright", F.col("_slice"), F.col("level")))
    both = asked.alias("x").join(won.alias("y"), same("x", "y", [*keys, "level", "block"])).select(*[f"x.{c}" for c in found.columns], "y._over")
    return both.groupBy(*found.columns).agg(pick("_over").alias("_over"))


def labels_by_table(
    df: DataFrame,
    calendar: DataFrame,
    order: Order,
    horizons: Sequence[int] = HORIZONS,
    post_hours: int = POST_HOURS,
    on_overlap: str = "last",
    default: str = "normal",
    start: str = "start",
    end: str = "end",
    kind: str = "interval_type",
    listed: str = "interval_id",
) -> DataFrame:
    """``df`` with every label of ``features.horizon_labels`` against a table of incidents of any size.

    ``order.by`` names the keys that a calendar has to itself, if it has them; without, one calendar holds for all rows.
    Incidents are closed on both ends; those without a start, end or key, or that end before they start, are left out.  Of
    incidents that overlap the one listed last (or first) gives the type, by ``listed``, then by start and type.  Rows
    without a time are in no incident.
    """
    if on_overlap not in ("first", "last"):
        raise ValueError("on_overlap is 'first' or 'last'")
    keys = [k for k in order.by if k in calendar.columns]
    s, e = epoch_micros(F.col(start)), epoch_micros(F.col(end)) + 1
    spans = calendar.select(*keys, F.col(listed).alias("_listed"), s.alias("_s"), F.col(kind).alias("_kind"), e.alias("_e")).where("_s < _e")
    spans = spans.dropna(subset=keys) if keys else spans
    spans = stored(spans, "calendar")
    kinds = {c: frame.schema[c].dataType for frame in (df, spans) for c in frame.columns if c in (*keys, "_listed", "_kind")}
    kinds |= {"_slice": T.IntegerType(), "_side": T.ByteType(), "_row": T.StructType(df.schema.fields)}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in (*keys, *_SETTLED)])
    found = _merged(df, spans, order, keys, schema, on_overlap == "last")
    settled = found.rows.where("_side is null")
    tails = found.rows.groupBy(*found.columns).agg(
        F.max(F.when(F.col("_side") == _END, F.col("_at"))).alias("_ended"), F.min(F.when(F.col("_side") == _START, F.col("_at"))).alias("_next")
    )
    earlier, later = before_and_after(found)
    around = tails.select(*found.columns, F.max("_ended").over(earlier).alias("_ended_before"), F.min("_next").over(later).alias("_next_after"))
    carried = around.join(_over_slices(found, on_overlap), found.columns, "left") if keys else around.join(F.broadcast(_over_slices(found, on_overlap)), "_slice", "left")
    joined = found.join(settled, carried)
    at = F.col("_at")
    ended, coming = F.coalesce("_ended", "_ended_before"), F.coalesce("_next", "_next_after")
    who = (F.greatest if on_overlap == "last" else F.least)(_who(), F.col("_over"))
    near = joined.select("_row", "_at", ended.alias("_ended"), coming.alias("_next"), who.alias("_who"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    inside = F.col("_who").isNotNull()
    out = near.select(
        "_row.*",
        flag(inside).alias("failure_window"),
        *[flag(F.col("_next") - at <= h * _HOUR).alias(f"pre_failure_{h}h") for h in horizons],
        flag(at - F.col("_ended") < post_hours * _HOUR).alias("post_maintenance"),
        F.coalesce(F.col("_who._kind"), F.lit(default)).alias("failure_type"),
        F.when(inside, F.lit(0.0)).otherwise((F.col("_next") - at) / F.lit(1e6)).alias("rul_seconds"),
    )
    at_risk = F.greatest("failure_window", f"pre_failure_{max(horizons)}h", "post_maintenance")
    return out.withColumn("normal_candidate", F.lit(1) - at_risk)


def lead_time_by_table(
    predictions: DataFrame,
    calendar: DataFrame,
    time: str,
    prediction: str,
    keys: Sequence[str] = (),
    hours: int = 24,
    start: str = "start",
    listed: str = "interval_id",
) -> DataFrame:
    """Earliest alarm in ``[start - hours, start)`` of each incident that starts within the scored range (of its key).

    Alarms and starts are merged once in the order of time; no incident is paired with an alarm but its first.
    """
    keys = list(keys)
    span = predictions.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    starts = calendar.select(*keys, F.col(listed).alias("interval_id"), F.col(start).alias("interval_start")).where(F.col("interval_start").isNotNull())
    ranged = starts.join(span, keys) if keys else starts.crossJoin(F.broadcast(span))  # one row
    scored = ranged.where("interval_start between _lo and _hi").drop("_lo", "_hi")
    # the next alarm strictly after the last instant that is too early
    asked = scored.withColumn("_from", _instant(epoch_micros(F.col("interval_start")) - hours * _HOUR - 1))
    alarms = predictions.where(F.col(prediction) == 1).select(*keys, F.col(time).alias("_alarm"))
    found = seconds_to_next(asked, alarms, Order("_from", None, tuple(keys)), "_alarm", "_wait")
    alarm = epoch_micros(F.col("_from")) + F.round(F.col("_wait") * 1e6).cast("long")
    begin = epoch_micros(F.col("interval_start"))
    first = F.when(alarm < begin, alarm)
    return found.select(
        *keys,
        "interval_id",
        "interval_start",
        _instant(first).alias("first_alarm"),
        first.isNotNull().cast("int").alias("detected"),
        ((begin - first) / F.lit(3.6e9)).alias("lead_time_hours"),
    )
