"""Exact quantiles of many columns by radix selection.

Doubles become unsigned numbers that sort alike.  The wanted ranks of all columns are found together, 16 bits at a time:
a pass counts, for every prefix that still holds a wanted rank, how many values go on with each of the 2^16 next digits,
and the digit where the running count passes the rank is taken.  Four passes over one stored table of the columns settle
every bit, so the result is exact; no sample, no column and no group of values is ever in one task, only counts are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.session import stored

SMALL_CELLS = 2_000_000
DIGIT = 16
PASSES = 64 // DIGIT
_HELD = 1 << 20
_SIGN = np.uint64(1 << 63)


@dataclass(frozen=True)
class _Target:
    """A rank (from 0) of a column, within the values that begin with ``prefix``."""

    column: int
    rank: int
    inner: int
    prefix: int = 0


def sortable(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers that sort like the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _double(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], small_cells: int = SMALL_CELLS
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column of the values that are neither null nor NaN, None if there are none.

    Up to ``small_cells`` cells the built-in ``percentile`` finds the same values in one pass.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    narrow = stored(df.select(*[F.when(~F.isnan(v), v).alias(f"c{k}") for k, v in enumerate(values.values())]), "quantiles")
    if narrow.count() * len(columns) <= small_cells:
        row = narrow.agg(*[F.percentile(f"c{k}", list(shares)).alias(f"c{k}") for k in range(len(columns))]).first()
        return {c: list(row[k]) if row[k] is not None else [None] * len(shares) for k, c in enumerate(columns)}
    digits = _count_digits(narrow, len(columns), {}, 0)
    sizes = {r["c"]: r["n"] for r in digits.groupBy("c").agg(F.sum("n").alias("n")).collect()}  # one row per column
    places = {(k, p): p * (n - 1) for k, n in sizes.items() for p in shares}
    ranks = {(k, r) for (k, _), place in places.items() for r in (math.floor(place), math.ceil(place))}
    targets = _chosen(digits, [_Target(k, r, r) for k, r in sorted(ranks)])
    for done in range(1, PASSES):
        prefixes: dict[int, list[int]] = {}
        for t in targets:
            prefixes.setdefault(t.column, []).append(t.prefix)
        active = {k: np.array(sorted(set(found)), np.uint64) for k, found in prefixes.items()}
        targets = _chosen(_count_digits(narrow, len(columns), active, done), targets)
    found = {(t.column, t.rank): _double(t.prefix) for t in targets}

    def between(k: int, share: float) -> float | None:
        if k not in sizes:
            return None
        place = places[k, share]
        low, high = found[k, math.floor(place)], found[k, math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {c: [between(k, p) for p in shares] for k, c in enumerate(columns)}


def _count_digits(narrow: DataFrame, width: int, active: dict[int, np.ndarray], done: int) -> DataFrame:
    """Stored counts ``c, prefix, digit, n`` of the digit after ``done`` digits; before the first every value counts."""
    shift = np.uint64(64 - DIGIT * (done + 1))
    mask = np.uint64((1 << DIGIT) - 1)

    def rows(c: int, cells: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        prefix = active[c][cells >> DIGIT] if done else np.zeros(len(cells), np.uint64)
        arrays = [pa.array(np.full(len(cells), c, np.int32)), pa.array(prefix.view(np.int64)), pa.array((cells & int(mask)).astype(np.int32)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, ["c", "prefix", "digit", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = {} if done else {c: np.zeros(1 << DIGIT, np.int64) for c in range(width)}
        held: dict[int, list[np.ndarray]] = {c: [] for c in active}
        size = 0
        for batch in batches:
            for c in whole if not done else active:
                column = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                key = sortable(column)
                digit = ((key >> shift) & mask).astype(np.int64)
                if not done:
                    whole[c] += np.bincount(digit, minlength=1 << DIGIT)
                    continue
                prefix = key >> (shift + np.uint64(DIGIT))
                at = np.minimum(np.searchsorted(active[c], prefix), len(active[c]) - 1)
                same = active[c][at] == prefix
                held[c].append((at[same].astype(np.int64) << DIGIT) | digit[same])
                size += len(held[c][-1])
            if size > _HELD:
                yield from packed(held)
                held, size = {c: [] for c in active}, 0
        for c, counts in whole.items():
            some = np.flatnonzero(counts)
            yield rows(c, some, counts[some])
        yield from packed(held)

    def packed(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for c, parts in held.items():
            if parts:
                yield rows(c, *np.unique(np.concatenate(parts), return_counts=True))

    made = narrow.mapInArrow(counted, "c int, prefix long, digit int, n long")
    return stored(made.groupBy("c", "prefix", "digit").agg(F.sum("n").alias("n")), "quantile-digits")


def _chosen(digits: DataFrame, targets: list[_Target]) -> list[_Target]:
    """Each target one digit further.  A prefix has at most 2^16 digits, so running counts are over bounded groups."""
    if not targets:
        return []
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    asked = digits.sparkSession.createDataFrame([(k, t.column, signed(t.prefix), t.inner) for k, t in enumerate(targets)], "t int, c int, prefix long, inner long")
    upto = Window.partitionBy("c", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = digits.withColumn("upto", F.sum("n").over(upto))
    hit = running.join(F.broadcast(asked), ["c", "prefix"]).where("inner < upto and inner >= upto - n")
    out = []
    for row in hit.select("t", "digit", (F.col("inner") - F.col("upto") + F.col("n")).alias("inner")).collect():  # one row per wanted rank
        target = targets[row["t"]]
        out.append(replace(target, prefix=(target.prefix << DIGIT) | row["digit"], inner=row["inner"]))
    return sorted(out, key=lambda t: (t.column, t.rank))
