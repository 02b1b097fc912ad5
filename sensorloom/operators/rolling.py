"""Trailing ROWS frames over bucket rows, split into blocks with a halo.

Bucket rows are unique per (key, bucket), so a stretch of bucket time holds a bounded
number of them: a cell of ``CELL`` buckets never has more than ``CELL`` rows per key.  The
dense position comes from cell counts plus the row number inside the cell; blocks of that
position are the groups, and the last ``n - 1`` rows of a block are repeated at the head of
the next one.  Spark shuffles and sorts the blocks; stretches of whole blocks, so many of them where keys have few
rows, are evaluated together with numpy on Arrow columns, because the built-in sliding frame re-aggregates every frame
from scratch for each of hundreds of statistics.  Means, deviations and extremes come from stretches of doubled length,
quantiles from a wavelet matrix, so a block takes memory for its rows and not for rows times frame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.scalars import epoch_micros
from sensorloom.spec import unit_seconds

CELL = 4096
BLOCK_ROWS = 1024
PACK_ROWS = 16_384  # rows that are evaluated together, up to the end of their last block


def with_bucket_index(
    df: DataFrame, bucket: str, unit: str, by: Sequence[str] = (), into: str = "_index"
) -> DataFrame:
    """Dense 0-based position of each bucket row per key."""
    width = CELL * unit_seconds(unit) * 1_000_000
    cell = F.floor(epoch_micros(F.col(bucket)) / F.lit(width)).alias("_cell")
    keyed = df.select("*", cell)
    inside = Window.partitionBy(*by, "_cell").orderBy(bucket)
    earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*by, "_cell")
        .agg(F.count("*").alias("_rows"))
        .select(*by, "_cell", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    numbered = keyed.withColumn("_nth", F.row_number().over(inside))
    # without a key there is one row per stretch of CELL buckets, which bounds the table
    side = offsets if by else F.broadcast(offsets)
    joined = numbered.join(side, [*by, "_cell"], "left")
    return joined.withColumn(into, F.col("_offset") + F.col("_nth") - 1).drop("_cell", "_nth", "_offset")


def _with_halo(df: DataFrame, reach: int, block_rows: int) -> DataFrame:
    block = F.floor(F.col("_index") / block_rows)
    in_tail = F.col("_index") % block_rows >= block_rows - reach
    homes = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    return df.withColumn("_home", block).withColumn("_block", F.explode(homes))


Stat = tuple[str, str, int]  # (statistic, column, frame rows)
_QUANTILES = {"q25": 0.25, "q75": 0.75}
STATISTICS = ("mean", "std", "min", "max", *_QUANTILES)


@dataclass
class _Moments:
    """Of a stretch of rows that ends at each place: known values, their sum, squared deviations, extremes."""

    count: np.ndarray
    total: np.ndarray
    away: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def before(self, rows: int, start: np.ndarray) -> _Moments:
        """The stretch that ends ``rows`` places earlier; none before the first place of its block."""
        there = np.arange(len(start)) - rows >= start
        shift = lambda x, nothing: np.where(there, np.concatenate([np.full(min(rows, len(x)), nothing), x[: max(len(x) - rows, 0)]]), nothing)
        return _Moments(shift(self.count, 0), shift(self.total, 0.0), shift(self.away, 0.0), shift(self.low, np.inf), shift(self.high, -np.inf))

    def joined(self, other: _Moments) -> _Moments:
        """Both stretches together; deviations are merged about the two means, so nothing is subtracted away."""
        count = self.count + other.count
        both = (self.count > 0) & (other.count > 0)
        gap = np.where(both, self.total / np.maximum(self.count, 1) - other.total / np.maximum(other.count, 1), 0.0)
        between = gap * gap * (self.count * other.count / np.maximum(count, 1))
        return _Moments(count, self.total + other.total, self.away + other.away + between, np.minimum(self.low, other.low), np.maximum(self.high, other.high))


def _trailing_moments(values: np.ndarray, rows: int, start: np.ndarray) -> _Moments:
    """Moments of every trailing frame by doubling: stretches of 1, 2, 4 ... rows, those of the frame's binary digits joined.

    Memory is a few arrays as long as ``values`` and time grows with the logarithm of the frame.
    """
    known = np.isfinite(values)
    filled = np.where(known, values, 0.0)
    step = _Moments(known.astype(np.int64), filled, np.zeros(len(values)), np.where(known, values, np.inf), np.where(known, values, -np.inf))
    out, done, length = None, 0, 1
    while True:
        if rows & length:
            out = step if out is None else out.joined(step.before(done, start))
            done += length
        length *= 2
        if length > rows:
            return out
        step = step.joined(step.before(length // 2, start))


class _Ranks:
    """Order statistics of any stretch of a sequence: a wavelet matrix over the ranks of its values.

    Per bit of the ranks, highest first, it has the number of zeros before each place, so the k-th smallest value of all
    stretches is found together in one step per bit.
    """

    def __init__(self, values: np.ndarray):
        self.ordered, rank = np.unique(values, return_inverse=True)
        self.levels = []
        for bit in range(max(int(len(self.ordered) - 1).bit_length(), 1) - 1, -1, -1):
            ones = (rank >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32)
            self.levels.append((bit, zeros))
            rank = np.concatenate([rank[~ones], rank[ones]])

    def kth(self, first: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of each stretch ``first .. end - 1``."""
        first, end, k = first.astype(np.int64), end.astype(np.int64), k.astype(np.int64)
        rank = np.zeros(len(k), np.int64)
        for bit, zeros in self.levels:
            low, high = zeros[first], zeros[end]
            right = k >= high - low
            rank |= right.astype(np.int64) << bit
            k = np.where(right, k - (high - low), k)
            first = np.where(right, zeros[-1] + first - low, low)
            end = np.where(right, zeros[-1] + end - high, high)
        return self.ordered[rank]


def _trailing_quantiles(values: np.ndarray, rows: int, shares: Sequence[float], start: np.ndarray) -> list[np.ndarray]:
    """Linear-interpolated quantiles of the known values of every trailing frame, NaN where there are none."""
    known = np.isfinite(values)
    upto = np.concatenate([[0], np.cumsum(known)])
    end, first = upto[1:], upto[np.maximum(np.arange(len(values)) - rows + 1, start)]
    count = end - first
    some = np.flatnonzero(count)
    out = [np.full(len(values), np.nan) for _ in shares]
    if not len(some):
        return out
    ranks = _Ranks(values[known])
    for found, share in zip(out, shares):
        place = share * (count[some] - 1)
        low, high = np.floor(place).astype(np.int64), np.ceil(place).astype(np.int64)
        below, above = (ranks.kth(first[some], end[some], k) for k in (low, high))
        found[some] = below + (above - below) * (place - low)
    return out


def trailing(values: np.ndarray, rows: int, stats: Iterable[str], start: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Statistics of every trailing frame; a frame without known values gives NaN.

    ``start`` is, per place, the first place its frame may reach back to; without, that is the first of all.  The deviation of fewer than two known values is 0.  Memory grows with the number of values, not with the frame.
    """
    wanted = set(stats)
    start = np.zeros(len(values), np.int64) if start is None else start
    out: dict[str, np.ndarray] = {}
    if wanted - set(_QUANTILES):
        found = _trailing_moments(values, rows, start)
        empty = found.count == 0
        made = {
            "mean": lambda: np.where(empty, np.nan, found.total / np.maximum(found.count, 1)),
            "std": lambda: np.where(found.count > 1, np.sqrt(found.away / np.maximum(found.count - 1, 1)), 0.0),
            "min": lambda: np.where(empty, np.nan, found.low),
            "max": lambda: np.where(empty, np.nan, found.high),
        }
        out |= {kind: make() for kind, make in made.items() if kind in wanted}
    asked = [q for q in _QUANTILES if q in wanted]
    if asked:
        out |= dict(zip(asked, _trailing_quantiles(values, rows, [_QUANTILES[q] for q in asked], start)))
    return out


def _first_places(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Places of rows that differ from the row before in a key; nulls are alike."""
    fresh = np.zeros(rows.num_rows, dtype=bool)
    fresh[:1] = True
    for c in keys:
        one, two = rows[c].slice(0, max(rows.num_rows - 1, 0)), rows[c].slice(1)
        same = pc.or_(pc.equal(one, two).fill_null(False), pc.and_(one.is_null(), two.is_null()))
        fresh[1:] |= ~same.to_numpy().astype(bool)
    return np.flatnonzero(fresh)


def _whole_blocks(keys: Sequence[str], evaluate: Callable[[pa.Table, np.ndarray], pa.Table]):
    """Sorted rows to stretches of whole blocks of about ``PACK_ROWS`` rows, each evaluated with the first places of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < PACK_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            first = _first_places(rows, keys)
            if first[-1]:
                yield from evaluate(rows.slice(0, first[-1]), first[:-1]).to_batches()
                held = rows.slice(first[-1]).to_batches()
        rows = pa.Table.from_batches(held) if held else None
        if rows is not None and rows.num_rows:
            yield from evaluate(rows, _first_places(rows, keys)).to_batches()

    return run


def with_rolling(
    df: DataFrame,
    bucket: str,
    unit: str,
    stats: Sequence[Stat],
    by: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``roll{n}_{stat}_{column}`` (double) for every requested statistic.

    Frames count existing rows, not clock time, and end at the current row.
    """
    unknown = {s[0] for s in stats} - set(STATISTICS)
    if unknown:
        raise ValueError(f"unknown rolling statistics: {sorted(unknown)}")
    reach = max((rows for _, _, rows in stats), default=1) - 1
    block_rows = max(block_rows, reach + 1)  # a frame reaches into the block before its own at most
    blocks = _with_halo(with_bucket_index(df, bucket, unit, by), reach, block_rows)
    names = [f"roll{n}_{stat}_{column}" for stat, column, n in stats]
    kept = df.columns
    wanted: dict[tuple[str, int], list[str]] = {}
    for stat, column, n in stats:
        wanted.setdefault((column, n), []).append(stat)

    def roll(rows: pa.Table, first: np.ndarray) -> pa.Table:
        start = np.repeat(first, np.diff(np.append(first, rows.num_rows)))
        home = rows["_home"].to_numpy() == rows["_block"].to_numpy()
        made: dict[str, np.ndarray] = {}
        for (column, n), kinds in wanted.items():
            values = rows[column].cast(pa.float64()).to_numpy(zero_copy_only=False)
            for kind, found in trailing(values, n, kinds, start).items():
                made[f"roll{n}_{kind}_{column}"] = found[home]
        own = rows.select(kept).filter(pa.array(home))
        columns = [own[c] for c in kept] + [pa.array(made[c], from_pandas=True) for c in names]
        return pa.table(columns, names=kept + names).combine_chunks()

    schema = T.StructType(df.schema.fields + [T.StructField(n, T.DoubleType()) for n in names])
    groups = [*by, "_block"]
    in_blocks = blocks.repartition(*groups).sortWithinPartitions(*groups, "_index")
    return in_blocks.mapInArrow(_whole_blocks(groups, roll), schema)
